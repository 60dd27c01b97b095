"""Registered mart queries (G1-G4, G3b) over the derived star views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import materialize
from . import marts
from .derived import (FULL_TEAM, SQL_ARENA, SQL_ORDER_STAR, SQL_ROSTER_SUPPLIERS, arena, line_players, order_matches,
                      player_names, roster_supplier_keys, roster_suppliers, roster_users,
                      round_player_stats)
from .registry import Tables, register


def _r(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(18,9)), {n}) AS DOUBLE)"


@register("mart_rate_by_group", f"""
WITH {SQL_ROSTER_SUPPLIERS},
rps AS (
  SELECT l.l_suppkey AS player_puuid, s.s_name AS player_display_name, l.l_returnflag AS economy_weapon_name,
         CASE WHEN l.l_linestatus = 'F' THEN CAST(l.l_quantity AS BIGINT) ELSE 0 END AS headshots,
         CASE WHEN l.l_linestatus = 'O' THEN CAST(l.l_quantity AS BIGINT) ELSE 0 END AS bodyshots,
         CAST(l.l_linenumber AS BIGINT) AS legshots
  FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey),
g AS (
  SELECT player_puuid, player_display_name, economy_weapon_name,
         CAST(SUM(headshots) AS BIGINT) AS headshots, CAST(SUM(bodyshots) AS BIGINT) AS bodyshots,
         CAST(SUM(legshots) AS BIGINT) AS legshots
  FROM rps WHERE player_puuid IN (SELECT puuid FROM roster) GROUP BY 1, 2, 3)
SELECT player_puuid, player_display_name, economy_weapon_name, headshots,
       headshots + bodyshots + legshots AS allshots,
       {_r("headshots / NULLIF(headshots + bodyshots + legshots, 0) * 100", 2)} AS percentage_headshots
FROM g""")
def mart_rate_by_group(spark, d):
    T = Tables(spark, d)
    return marts.rate_by_group(round_player_stats(T), roster_supplier_keys(T), names=player_names(T))


@register("mart_first_event_ratio", f"""
WITH {SQL_ARENA},
roles AS (
  SELECT unnest([killer_puuid, victim_puuid]) AS puuid, unnest([TRUE, FALSE]) AS made FROM first_kills),
tally AS (
  SELECT puuid, NULLIF(COUNT(*) FILTER (WHERE made), 0) AS first_blood, NULLIF(COUNT(*) FILTER (WHERE NOT made), 0) AS first_death
  FROM roles GROUP BY puuid),
totals AS (
  SELECT p.puuid, p.name, p.tag, CAST(SUM(m.rounds_played) AS BIGINT) AS rounds_played
  FROM roster JOIN player p USING (puuid) LEFT JOIN metadata m USING (matchid) GROUP BY ALL),
rates AS (
  SELECT name, rounds_played, first_blood, first_death,
         {_r("first_blood / NULLIF(rounds_played, 0)", 3)} AS ratio_first_blood,
         {_r("first_death / NULLIF(rounds_played, 0)", 3)} AS ratio_first_death
  FROM totals LEFT JOIN tally USING (puuid))
SELECT *, ratio_first_blood / NULLIF(ratio_first_death, 0) AS ratio FROM rates""")
def mart_first_event_ratio(spark, d):
    T = Tables(spark, d)
    a = arena(T)
    return marts.first_event_ratio(a["player"], a["metadata"], a["kills"], roster_users(T))


# A round, as seen from each side that roster players were on.
SQL_SEEN = """
sides AS (SELECT DISTINCT matchid, team FROM player SEMI JOIN roster USING (puuid)),
seen AS (
  SELECT map, (matchid, round) AS one, sides.team = winning_team AS we_won_round, sides.team = killer_team AS ours_first
  FROM metadata LEFT JOIN sides USING (matchid) LEFT JOIN rounds USING (matchid)
  LEFT JOIN first_kills USING (matchid, round))"""


@register("mart_first_event_impact", f"""
WITH {SQL_ARENA}, {SQL_SEEN},
counted AS (
  SELECT map, we_won_round, COUNT(DISTINCT one) FILTER (WHERE ours_first) AS fb_true,
         COUNT(DISTINCT one) FILTER (WHERE NOT ours_first) AS fb_false, COUNT(DISTINCT one) AS n
  FROM seen GROUP BY map, we_won_round)
SELECT map, we_won_round, fb_true, fb_false, {_r("fb_true / NULLIF(n, 0)", 2)} AS ratio FROM counted""")
def mart_first_event_impact(spark, d):
    T = Tables(spark, d)
    a = arena(T)
    return marts.first_event_impact(marts.first_event_rounds(a["metadata"], a["player"], a["round"], a["kills"], roster_users(T)))


@register("outcome_split", f"""
WITH {SQL_ARENA}, {SQL_SEEN}
SELECT map, we_won_round, COUNT(DISTINCT one) FILTER (WHERE ours_first) AS fb_true,
       COUNT(DISTINCT one) FILTER (WHERE NOT ours_first) AS fb_false,
       list_extract(['DEFEAT', 'VICTORY'], 1 + CAST(we_won_round AS INTEGER)) AS outcome
FROM seen WHERE we_won_round IS NOT NULL GROUP BY map, we_won_round""")
def outcome_split(spark, d):
    T = Tables(spark, d)
    a = arena(T)
    return marts.outcome_split(marts.first_event_rounds(a["metadata"], a["player"], a["round"], a["kills"], roster_users(T)))


@register("mart_consolidated", f"""
WITH {SQL_ROSTER_SUPPLIERS}, {SQL_ORDER_STAR},
ranked AS (
  SELECT *, puuid = arg_min(puuid, (-score, puuid)) OVER (PARTITION BY matchid) AS match_mvp,
         COUNT(*) FILTER (WHERE puuid IN (SELECT puuid FROM roster)) OVER (PARTITION BY matchid) = {FULL_TEAM} AS full_team
  FROM line_players),
sheet AS (
  SELECT r.*, roster.name, map, to_timestamp(game_start)::TIMESTAMP AS game_start, rounds_played,
         red_has_won, red_rounds_won, red_rounds_lost, blue_has_won, blue_rounds_won, blue_rounds_lost,
         bodyshots + headshots + legshots AS total_shots,
         COALESCE(CASE team WHEN 'Red' THEN red_has_won WHEN 'Blue' THEN blue_has_won END, FALSE) AS has_won_the_match,
         matchid = arg_max(matchid, (game_start, matchid)) OVER (PARTITION BY puuid) AS last_game
  FROM ranked r JOIN roster USING (puuid) JOIN metadata USING (matchid) LEFT JOIN teams USING (matchid))
SELECT DISTINCT * EXCLUDE (puuid) FROM sheet""")
def mart_consolidated(spark, d):
    T = Tables(spark, d)
    # stored once, as a load would store the star: what the sheet reads more than once
    players = materialize(line_players(T), "line_players")
    roster = roster_suppliers(T).select(F.col("s_suppkey").alias("puuid"), F.col("s_name").alias("name"))
    ours = materialize(marts.kept_players(players, roster=roster), "kept_players")
    return marts.consolidated_sheet(materialize(order_matches(T), "matches"), players, ours, full_team=FULL_TEAM)
