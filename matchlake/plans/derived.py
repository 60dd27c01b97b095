"""Star-shaped views of the driver tables, used to run the marts at scale.

Two bindings, both computed by Spark from the given tables:

* **order star** -- a match is an order, a player is a supplier within an
  order (lines aggregated per ``(l_orderkey, l_suppkey)``), a round is a
  line.  Outcome: status F = red won, O = blue won, P = neither.
* **arena** -- from ``events``: a match is a calendar day, a round is an
  hour, a kill is an event (killer = ``user_id``, victim = the user named
  by ``props.k``), a player's name/segment/team come from ``customer``
  (``c_custkey = user_id``; segments AUTOMOBILE, BUILDING, FURNITURE play
  Red, the others Blue).

Rosters are data-driven: suppliers of region AMERICA (order star) and
customers of segment AUTOMOBILE (arena).  Each ``SQL_*`` constant is the
DuckDB form of the same view, used by the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import ts_to_epoch
from ..session import materialize
from .registry import Tables

# Fixed values of the bindings.
ROSTER_REGION = "AMERICA"
ROSTER_SEGMENT = "AUTOMOBILE"
RED_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE")
FULL_TEAM = 2


def qty() -> F.Column:
    return F.col("l_quantity").cast("bigint")


def roster_suppliers(T: Tables) -> DataFrame:
    region = T.region.filter(F.col("r_name") == ROSTER_REGION)
    nations = T.nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")
    return T.supplier.join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")


def roster_supplier_keys(T: Tables) -> DataFrame:
    return roster_suppliers(T).select(F.col("s_suppkey").alias("puuid"))


def roster_supplier_names(T: Tables) -> DataFrame:
    return roster_suppliers(T).select(F.col("s_name").alias("name"))


def roster_users(T: Tables) -> DataFrame:
    return T.customer.filter(F.col("c_mktsegment") == ROSTER_SEGMENT).select(F.col("c_custkey").alias("puuid"))


# ---------------------------------------------------------------- order star

def order_lines(T: Tables) -> DataFrame:
    """Per order: number of lines and F / O line counts."""
    return T.lineitem.groupBy(F.col("l_orderkey").alias("matchid")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("l_linestatus") == "F").alias("f_lines"),
        F.count_if(F.col("l_linestatus") == "O").alias("o_lines"))


def line_players(T: Tables) -> DataFrame:
    """One aggregate per (order, supplier) feeding all per-player tables."""
    def flag_qty(flag):
        return F.sum(F.when(F.col("l_returnflag") == flag, qty()).otherwise(0))
    return T.lineitem.groupBy(F.col("l_orderkey").alias("matchid"), F.col("l_suppkey").alias("puuid")).agg(
        # count_if tests instead of min(string): string buffers would turn
        # the whole aggregate into a sort-based one.
        F.when(F.count_if(F.col("l_linestatus") == "F") > 0, "Red").otherwise("Blue").alias("team"),
        F.count(F.lit(1)).alias("level"),
        F.sum(qty()).alias("damage_made"),
        F.sum(F.col("l_linenumber").cast("bigint")).alias("damage_received"),
        F.min("l_linenumber").cast("bigint").alias("currenttier"),
        F.when(F.count_if(F.col("l_returnflag") == "R") > 0, "striker")
         .when(F.count_if(F.col("l_returnflag") == "A") > 0, "support").otherwise("scout").alias("character"),
        F.sum(qty()).alias("score"),
        flag_qty("A").alias("headshots"), flag_qty("N").alias("bodyshots"), flag_qty("R").alias("legshots"),
        F.max("l_discount").alias("max_discount"), F.min("l_tax").alias("min_tax"),
        F.count_if(F.col("l_linestatus") == "O").alias("c_cast"),
        F.max("l_linenumber").cast("bigint").alias("x_cast"),
        F.concat(F.lit("P"), F.min("l_partkey").cast("string")).alias("agent_small"),
        F.concat(F.lit("P"), F.max("l_partkey").cast("string")).alias("agent_killfeed"))


def order_matches(T: Tables) -> DataFrame:
    """One row per order: its facts and its sides' outcomes."""
    o = T.orders.select(F.col("o_orderkey").alias("matchid"), "o_orderpriority", "o_orderdate", "o_orderstatus")
    return o.join(order_lines(T), "matchid", "left").select(
        "matchid", F.col("o_orderpriority").alias("map"), ts_to_epoch("o_orderdate").alias("game_start"),
        F.coalesce(F.col("n_lines"), F.lit(0)).cast("bigint").alias("rounds_played"),
        (F.col("o_orderstatus") == "F").alias("red_has_won"),
        F.col("f_lines").alias("red_rounds_won"), F.col("o_lines").alias("red_rounds_lost"),
        (F.col("o_orderstatus") == "O").alias("blue_has_won"),
        F.col("o_lines").alias("blue_rounds_won"), F.col("f_lines").alias("blue_rounds_lost"))


def player_tags(T: Tables) -> DataFrame:
    return T.supplier.select(F.col("s_suppkey").alias("puuid"), F.col("s_name").alias("name"),
                             F.col("s_nationkey").cast("string").alias("tag"))


def round_player_stats(T: Tables) -> DataFrame:
    """Line level: player = supplier, weapon = return flag; head shots =
    quantity on F lines, body shots = quantity on O lines, leg shots = the
    line number.  Display names come separately (:func:`player_names`)."""
    return T.lineitem.select(
        F.col("l_suppkey").alias("player_puuid"), F.col("l_returnflag").alias("economy_weapon_name"),
        F.when(F.col("l_linestatus") == "F", qty()).otherwise(0).alias("headshots"),
        F.when(F.col("l_linestatus") == "O", qty()).otherwise(0).alias("bodyshots"),
        F.col("l_linenumber").cast("bigint").alias("legshots"))


def player_names(T: Tables) -> DataFrame:
    return T.supplier.select(F.col("s_suppkey").alias("player_puuid"), F.col("s_name").alias("player_display_name"))


SQL_ROSTER_SUPPLIERS = f"""
roster AS (
  SELECT s.s_suppkey AS puuid, s.s_name AS name FROM supplier s
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE r.r_name = '{ROSTER_REGION}')"""

SQL_ORDER_STAR = """
order_lines AS (
  SELECT l_orderkey AS matchid, COUNT(*) AS n_lines,
         CAST(COUNT_IF(l_linestatus = 'F') AS BIGINT) AS f_lines, CAST(COUNT_IF(l_linestatus = 'O') AS BIGINT) AS o_lines
  FROM lineitem GROUP BY l_orderkey),
line_players AS (
  SELECT l_orderkey AS matchid, l_suppkey AS puuid,
         CASE WHEN COUNT_IF(l_linestatus = 'F') > 0 THEN 'Red' ELSE 'Blue' END AS team,
         COUNT(*) AS level,
         CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS damage_made,
         CAST(SUM(CAST(l_linenumber AS BIGINT)) AS BIGINT) AS damage_received,
         CAST(MIN(l_linenumber) AS BIGINT) AS currenttier,
         CASE WHEN COUNT_IF(l_returnflag = 'R') > 0 THEN 'striker'
              WHEN COUNT_IF(l_returnflag = 'A') > 0 THEN 'support' ELSE 'scout' END AS "character",
         CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS score,
         CAST(SUM(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS headshots,
         CAST(SUM(CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS bodyshots,
         CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS legshots,
         MAX(l_discount) AS max_discount, MIN(l_tax) AS min_tax,
         CAST(COUNT_IF(l_linestatus = 'O') AS BIGINT) AS c_cast, CAST(MAX(l_linenumber) AS BIGINT) AS x_cast,
         'P' || CAST(MIN(l_partkey) AS VARCHAR) AS agent_small,
         'P' || CAST(MAX(l_partkey) AS VARCHAR) AS agent_killfeed
  FROM lineitem GROUP BY l_orderkey, l_suppkey),
metadata AS (
  SELECT o.o_orderkey AS matchid, o.o_orderpriority AS map,
         CAST(epoch(o.o_orderdate) AS BIGINT) AS game_start,
         CAST(COALESCE(ol.n_lines, 0) AS BIGINT) AS rounds_played
  FROM orders o LEFT JOIN order_lines ol ON o.o_orderkey = ol.matchid),
teams AS (
  SELECT o.o_orderkey AS matchid, o.o_orderstatus = 'F' AS red_has_won,
         ol.f_lines AS red_rounds_won, ol.o_lines AS red_rounds_lost,
         o.o_orderstatus = 'O' AS blue_has_won, ol.o_lines AS blue_rounds_won, ol.f_lines AS blue_rounds_lost
  FROM orders o LEFT JOIN order_lines ol ON o.o_orderkey = ol.matchid),
player AS (
  SELECT lp.matchid, lp.puuid, lp.team, lp.level, lp.damage_made, lp.damage_received, lp.currenttier,
         lp."character", s.s_name AS name, CAST(s.s_nationkey AS VARCHAR) AS tag
  FROM line_players lp LEFT JOIN supplier s ON lp.puuid = s.s_suppkey)"""


# ---------------------------------------------------------------- arena

def arena_kills(T: Tables) -> DataFrame:
    return T.events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("matchid"), F.hour("ts").cast("bigint").alias("round"),
        F.col("ts").alias("kill_time_in_round"), F.col("user_id").alias("killer_puuid"),
        F.get_json_object("props", "$.k").cast("bigint").alias("victim_puuid"),
        F.col("event_id").alias("kill_index"), "event_type")


def arena_users(T: Tables) -> DataFrame:
    c = T.customer
    return c.select(F.col("c_custkey").alias("puuid"), F.col("c_name").alias("name"),
                    F.col("c_mktsegment").alias("tag"),
                    F.when(F.col("c_mktsegment").isin(*RED_SEGMENTS), "Red")
                     .when(F.col("c_mktsegment").isNotNull(), "Blue").alias("team"))


def arena(T: Tables) -> dict[str, DataFrame]:
    """The arena star.  Kills (events with the killer's team) are stored
    once, as a load would store the kills table, so the events-to-customer
    join runs once for the tables below.  A match is a whole day, so the
    shuffled plans reduce map-side first (partial aggregates, partial group
    limits)."""
    users = arena_users(T)
    kt = materialize(arena_kills(T).join(
        users.select(F.col("puuid").alias("killer_puuid"), F.col("team").alias("killer_team")),
        "killer_puuid", "left"), "arena_kills")
    k = kt
    player = k.select("matchid", F.col("killer_puuid").alias("puuid")).distinct().join(users, "puuid", "left")
    metadata = k.groupBy("matchid").agg(F.count_distinct("round").alias("rounds_played")) \
        .withColumn("map", F.date_format(F.to_date("matchid"), "EEEE"))
    rounds = kt.groupBy("matchid", "round").agg(
        F.count_if(F.col("killer_team") == "Red").alias("red_n"),
        F.count_if(F.col("killer_team") == "Blue").alias("blue_n"),
        F.count_if(F.col("event_type") == "error").alias("errors")) \
        .select("matchid", F.concat_ws("-", "matchid", F.col("round").cast("string")).alias("round_id"), "round",
                F.when(F.col("red_n") > F.col("blue_n"), "Red").when(F.col("blue_n") > F.col("red_n"), "Blue")
                 .alias("winning_team"),
                F.when(F.col("errors") > 0, "error").otherwise("clean").alias("end_type"))
    return {"kills": kt, "player": player, "metadata": metadata, "round": rounds}


SQL_ARENA = f"""
users AS (
  SELECT c_custkey AS puuid, c_name AS name, c_mktsegment AS tag,
         CASE WHEN c_mktsegment IN {RED_SEGMENTS} THEN 'Red'
              WHEN c_mktsegment IS NOT NULL THEN 'Blue' END AS team
  FROM customer),
roster AS (SELECT c_custkey AS puuid FROM customer WHERE c_mktsegment = '{ROSTER_SEGMENT}'),
kills AS (
  SELECT strftime(e.ts, '%Y-%m-%d') AS matchid, CAST(hour(e.ts) AS BIGINT) AS round,
         e.ts AS kill_time_in_round, e.user_id AS killer_puuid,
         CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS victim_puuid,
         e.event_id AS kill_index, e.event_type, u.team AS killer_team
  FROM events e LEFT JOIN users u ON e.user_id = u.puuid),
player AS (
  SELECT DISTINCT k.matchid, k.killer_puuid AS puuid, u.name, u.tag, u.team
  FROM kills k LEFT JOIN users u ON k.killer_puuid = u.puuid),
metadata AS (
  SELECT matchid, COUNT(DISTINCT round) AS rounds_played,
         dayname(CAST(matchid AS DATE)) AS map
  FROM kills GROUP BY matchid),
rounds AS (
  SELECT matchid, round,
         CASE WHEN COUNT_IF(killer_team = 'Red') > COUNT_IF(killer_team = 'Blue') THEN 'Red'
              WHEN COUNT_IF(killer_team = 'Blue') > COUNT_IF(killer_team = 'Red') THEN 'Blue' END AS winning_team
  FROM kills GROUP BY matchid, round),
first_kills AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY matchid, round
                                 ORDER BY kill_time_in_round ASC NULLS FIRST, kill_index ASC NULLS FIRST) AS rn
    FROM kills) WHERE rn = 1)"""
