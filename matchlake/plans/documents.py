"""Nested documents made from the driver's flat tables.

The reference's input is one JSON document per match; the driver's tables
are flat, so the nested operators are exercised on documents nested here
and flattened back (the oracle is then the flat table itself).

Children are first numbered within their parent (``placed``); a document
holds the children of one run of places, so a parent with a huge child list
becomes several bounded documents (parts) instead of one unbounded group in
one task.  Each part says at which place it starts, so positions go on from
part to part, and what belongs to the parent as a whole is in its first part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .registry import Tables

# Fixed value: children per part; results do not depend on it.
PART = 64

# Fixed value: lines for which match documents are made at a time; results do not depend on it.
SLICE = 8_000_000


def _numbered(df: DataFrame, parent: list[str]) -> DataFrame:
    """``df``, whose partitions are sorted by ``parent``, plus ``_nth``: the 0-based position of each row in the run of
    its parent's rows in its partition.  Nothing but the last row is kept between batches."""
    at = [df.columns.index(p) for p in parent]
    schema = T.StructType([*df.schema.fields, T.StructField("_nth", T.LongType())])

    def run(batches):
        last, n_last = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            new = np.zeros(n, dtype=bool)
            for col in (batch.column(i) for i in at):
                here, before = col.slice(1), col.slice(0, n - 1)
                both_null = pc.and_(pc.is_null(here), pc.is_null(before))
                other = pc.and_(pc.fill_null(pc.not_equal(here, before), True), pc.invert(both_null))
                new[1:] |= other.to_numpy(zero_copy_only=False)
            new[0] = last != [batch.column(i)[0].as_py() for i in at]
            row = np.arange(n, dtype=np.int64)
            start = np.maximum.accumulate(np.where(new, row, -n_last))
            nth = row - start
            last, n_last = [batch.column(i)[n - 1].as_py() for i in at], int(nth[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nth)], names=[*batch.schema.names, "_nth"])

    return df.mapInArrow(run, schema)


def placed(df: DataFrame, parent: list[str], order: list[str], name: str, place: str = "place") -> DataFrame:
    """``df`` plus the 0-based position of each row within its parent, under ``order``.

    Rows are dealt by range of (parent, order), numbered as they lie sorted in
    their deal, and stored once, so a huge parent spans many deals and all
    readings agree on them.  Only the last parent of a deal can go on in the
    next one, so what its rows there are moved by is one row for each deal,
    and the rows are shuffled no second time.  Rows that tie on all of
    ``order`` take any of their places.
    """
    dealt = df.repartitionByRange(*parent, *order).sortWithinPartitions(*parent, *order)
    dealt = materialize(_numbered(dealt, parent).withColumn("_deal", F.spark_partition_id()), name)
    ends = dealt.groupBy("_deal").agg(F.max(F.struct(*parent, "_nth")).alias("end"))    # a row for each deal
    so_far = F.sum(F.col("end._nth") + 1).over(Window.partitionBy(*[f"end.{p}" for p in parent]).orderBy("_deal"))
    offsets = materialize(ends.select(*[F.col(f"end.{p}").alias(p) for p in parent], so_far.alias("_skip"),
                                      F.lead("_deal").over(Window.orderBy("_deal")).alias("_deal")), f"{name}_offsets")
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}")) for k in [*parent, "_deal"]]
    return dealt.alias("r").join(F.broadcast(offsets.alias("o")), same, "left").select(
        *[F.col(f"r.{c}") for c in df.columns], (F.coalesce("o._skip", F.lit(0)) + F.col("r._nth")).alias(place))


def part(place: str) -> Column:
    return F.floor(F.col(place) / PART).cast("bigint")


def conversation_docs(T: Tables) -> DataFrame:
    """``{conv_id, first, turns: [{turn, role, text}]}``: a run of a conversation's turns, in order; ``first`` is the
    place of the run's first turn."""
    turns = placed(T.conversations.select("conv_id", "turn", "role", "text"), ["conv_id"], ["turn", "role", "text"], "turns")
    return turns.groupBy("conv_id", part("place").alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("place", F.struct("turn", "role", "text").alias("t")))).alias("turns")) \
        .select("conv_id", (F.col("part") * PART).alias("first"), F.transform("turns", lambda x: x["t"]).alias("turns"))


def customer_docs(T: Tables) -> DataFrame:
    """``{o_custkey, first, orders: [{o_orderkey, ..., lines: [{..., charges}]}]}``.

    An order with very many lines stands in the list once for every part of
    its lines, each time with its own place among the customer's orders.
    Orders without lines carry ``lines = NULL``.
    """
    charges = F.array(F.struct(F.lit("tax").alias("kind"), F.col("l_tax").alias("amount")),
                      F.struct(F.lit("discount").alias("kind"), F.col("l_discount").alias("amount")))
    lines = placed(T.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax", "l_discount"),
                   ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], "lines", "line_place")
    lines = lines.groupBy("l_orderkey", part("line_place").alias("line_part")).agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                             charges.alias("charges")))).alias("lines"))
    orders = placed(T.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus"), ["o_custkey"], ["o_orderkey"],
                    "orders", "order_place")
    line_part = F.coalesce("line_part", F.lit(0))
    joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_custkey", line_part.alias("line_part"),
        # a further part of an order's lines is a document of its own
        F.when(line_part > 0, F.col("order_place")).otherwise(part("order_place") * PART).alias("first"),
        F.struct("order_place", F.struct("o_orderkey", "o_orderdate", "o_orderstatus", "lines").alias("o")).alias("o"))
    return joined.groupBy("o_custkey", "first", "line_part").agg(F.array_sort(F.collect_list("o")).alias("orders")) \
        .select("o_custkey", "first", F.transform("orders", lambda x: x["o"]).alias("orders"))


def envelope_docs(T: Tables) -> DataFrame:
    """API-response-shaped documents: one per customer and run of its orders."""
    orders = placed(T.orders.select("o_custkey", "o_orderkey", "o_orderpriority"), ["o_custkey"], ["o_orderkey"], "orders")
    o = orders.join(T.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_custkey", "c_name", "c_mktsegment", part("place").alias("part"),
        F.struct(F.col("o_orderkey").alias("matchid"), F.col("o_orderpriority").alias("map")).alias("m"))
    return o.groupBy("c_custkey", "part", "c_name", "c_mktsegment").agg(
        F.array_sort(F.collect_list("m")).alias("data")).select(
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("tag"), F.lit("matches").alias("endpoint"),
        F.lit(200).alias("status"), "data")


def maps_docs(T: Tables) -> DataFrame:
    """Map-asset-shaped documents: region = map, supplier = call-out
    (``regionName`` = nation, location x = balance, y = balance / 7)."""
    s = (T.supplier.join(T.nation, F.col("s_nationkey") == F.col("n_nationkey"))
         .join(T.region, F.col("n_regionkey") == F.col("r_regionkey")))
    callout = F.struct(F.col("n_name").alias("regionName"), F.col("r_name").alias("superRegionName"),
                       F.struct(F.col("s_acctbal").alias("x"), (F.col("s_acctbal") / 7).alias("y")).alias("location"))
    s = placed(s.select("r_regionkey", "r_name", "n_name", "s_acctbal", "s_suppkey"), ["r_regionkey"], ["s_suppkey"], "callouts")
    g = s.groupBy("r_regionkey", "r_name", part("place").alias("part")).agg(
        F.collect_list(callout).alias("callouts"))
    return g.select(F.array(F.struct(F.col("r_regionkey").cast("string").alias("uuid"),
                                     F.col("r_name").alias("displayName"), "callouts")).alias("data"))


def _ts_epoch_sql(ts: str) -> str:
    return (f"(CAST(unix_date(to_date({ts})) AS BIGINT) * 86400 + hour({ts}) * 3600 "
            f"+ minute({ts}) * 60 + second({ts}))")


def match_id_sql(order_key: str) -> str:
    """Fixed-width (UUID) match id of an order, as real match ids are.

    Fixed width matters: the round key concatenates ``matchid || round``
    without a separator, which is only collision-free for fixed-width ids.
    """
    from ..functions.keys import uuid5_sql
    return uuid5_sql(f"concat('order-', CAST({order_key} AS STRING))")


def _empty(t: str) -> str:
    return f"CAST(array() AS array<{t}>)"


# Written as one SQL statement over DataFrame parameters: the nested
# construction is parsed once on the JVM side instead of being assembled
# from thousands of Column calls.
# Lists are grouped, and joined with the orders, as narrow rows; documents are made of them last, so that no nested
# document is shuffled.  A player is in the part of its first line.
_MATCH_DOCS_SQL = """
WITH lines AS (
  SELECT l.*, CAST(FLOOR(l.line_place / {part}) AS BIGINT) AS part, s.s_name, s.s_nationkey
  FROM {lineitem} l LEFT JOIN {supplier} s ON l.l_suppkey = s.s_suppkey),
slices AS (
  SELECT l_orderkey, part, array_sort(collect_list(named_struct(
    'place', line_place, 'ln', l_linenumber, 'pk', l_partkey, 'sk', l_suppkey, 'qty', l_quantity, 'rf', l_returnflag,
    'ls', l_linestatus, 's_name', s_name))) AS lines
  FROM lines GROUP BY l_orderkey, part),
player_rows AS (
  SELECT l_orderkey, MIN(part) AS part, l_suppkey, s_name, s_nationkey,
    CASE WHEN count_if(l_linestatus = 'F') > 0 THEN 'Red' ELSE 'Blue' END AS team,
    count(1) AS level, sum(CAST(l_quantity AS BIGINT)) AS damage_made,
    sum(CAST(l_linenumber AS BIGINT)) AS damage_received, CAST(min(l_linenumber) AS BIGINT) AS currenttier,
    CASE WHEN count_if(l_returnflag = 'R') > 0 THEN 'striker'
         WHEN count_if(l_returnflag = 'A') > 0 THEN 'support' ELSE 'scout' END AS character,
    sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) ELSE 0L END) AS headshots,
    sum(CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS BIGINT) ELSE 0L END) AS bodyshots,
    sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0L END) AS legshots,
    max(l_discount) AS max_discount, min(l_tax) AS min_tax,
    count_if(l_linestatus = 'O') AS c_cast, CAST(max(l_linenumber) AS BIGINT) AS x_cast,
    min(l_partkey) AS min_part, max(l_partkey) AS max_part
  FROM lines GROUP BY l_orderkey, l_suppkey, s_name, s_nationkey),
players AS (
  SELECT l_orderkey, part, array_sort(collect_list(named_struct(
    'puuid', CAST(l_suppkey AS STRING), 'name', s_name, 'nation', s_nationkey, 'team', team, 'level', level,
    'currenttier', currenttier, 'character', character, 'damage_made', damage_made, 'damage_received', damage_received,
    'max_discount', max_discount, 'min_tax', min_tax, 'c_cast', c_cast, 'x_cast', x_cast, 'min_part', min_part,
    'max_part', max_part, 'bodyshots', bodyshots, 'headshots', headshots, 'legshots', legshots))) AS players
  FROM player_rows GROUP BY l_orderkey, part),
order_lines AS (
  SELECT l_orderkey AS ol_order, count(1) AS n_lines, count_if(l_linestatus = 'F') AS f_lines,
         count_if(l_linestatus = 'O') AS o_lines
  FROM {all_lines} GROUP BY l_orderkey),
parts AS (
  SELECT o_orderkey, o_orderpriority, o_orderstatus, o_orderdate, n_lines, f_lines, o_lines,
         explode(sequence(0L, (coalesce(n_lines, 1L) - 1) DIV {part})) AS part
  FROM {orders} o LEFT JOIN order_lines ol ON o.o_orderkey = ol.ol_order)
SELECT
  named_struct('matchid', {match_id}, 'map', o.o_orderpriority, 'game_start', {game_start},
               'rounds_played', CAST(coalesce(o.n_lines, 0) AS BIGINT)) AS metadata,
  named_struct('all_players', coalesce(transform(p.players, x -> named_struct(
    'puuid', x.puuid, 'name', x.name, 'tag', CAST(x.nation AS STRING), 'team', x.team,
    'level', x.level, 'currenttier', x.currenttier, 'character', x.character, 'damage_made', x.damage_made,
    'damage_received', x.damage_received,
    'session_playtime', named_struct('milliseconds', x.damage_received * 1000),
    'behavior', named_struct('b1', x.max_discount, 'b2', x.min_tax, 'b3', CAST(x.level AS DOUBLE),
                             'b4', CAST(x.damage_made AS DOUBLE)),
    'platform', named_struct('type', 'PC', 'os', named_struct('name', x.team)),
    'ability_casts', named_struct('c_cast', x.c_cast, 'x_cast', x.x_cast),
    'assets', named_struct('agent', named_struct('small', concat('P', CAST(x.min_part AS STRING)),
                                                 'killfeed', concat('P', CAST(x.max_part AS STRING)))),
    'stats', named_struct('score', x.damage_made, 'bodyshots', x.bodyshots, 'headshots', x.headshots,
                          'legshots', x.legshots),
    'economy', named_struct('spent', named_struct('overall', x.damage_made)))), {empty_players})) AS players,
  named_struct('red', named_struct('has_won', o.o_orderstatus = 'F', 'rounds_won', o.f_lines,
                                   'rounds_lost', o.o_lines),
               'blue', named_struct('has_won', o.o_orderstatus = 'O', 'rounds_won', o.o_lines,
                                    'rounds_lost', o.f_lines)) AS teams,
  coalesce(transform(s.lines, x -> named_struct(
    'winning_team', CASE WHEN x.ls = 'F' THEN 'Red' ELSE 'Blue' END, 'end_type', x.rf,
    'plant_events', named_struct(
      'plant_time_in_round', CASE WHEN x.rf = 'R' THEN CAST(x.ln * 1000 AS BIGINT) END,
      'plant_location', CASE WHEN x.rf = 'R' THEN {loc} END,
      'planted_by', CASE WHEN x.rf = 'R' THEN named_struct('puuid', CAST(x.sk AS STRING)) END,
      'player_locations_on_plant', CASE WHEN x.rf = 'R' THEN {both_locs} END),
    'defuse_events', named_struct(
      'defuse_time_in_round', CASE WHEN x.rf = 'A' THEN CAST(x.ln * 2000 AS BIGINT) END,
      'defuse_location', CASE WHEN x.rf = 'A' THEN {loc} END,
      'defused_by', CASE WHEN x.rf = 'A' THEN named_struct('puuid', CAST(x.sk AS STRING)) END,
      'player_locations_on_defuse', CASE WHEN x.rf = 'A' THEN {both_locs} END),
    'player_stats', array(named_struct(
      'player_puuid', CAST(x.sk AS STRING), 'player_display_name', x.s_name,
      'headshots', CASE WHEN x.ls = 'F' THEN CAST(x.qty AS BIGINT) ELSE 0L END,
      'bodyshots', CASE WHEN x.ls = 'O' THEN CAST(x.qty AS BIGINT) ELSE 0L END,
      'legshots', CAST(x.ln AS BIGINT),
      'economy', named_struct('weapon', named_struct('name', x.rf)),
      'ability_casts', named_struct('c_casts', 1L, 'e_cast', CAST(NULL AS BIGINT),
                                    'q_casts', CAST(x.ln AS BIGINT), 'x_cast', 0L),
      'damage_events', CASE WHEN x.qty >= 10
                            THEN array(named_struct('receiver_puuid', CAST(x.pk AS STRING), 'damage', CAST(x.qty AS BIGINT)),
                                       named_struct('receiver_puuid', CAST(x.sk AS STRING), 'damage', CAST(x.ln AS BIGINT)))
                            ELSE {empty_damage} END,
      'kill_events', {empty_kill_events})))), {empty_rounds}) AS rounds,
  coalesce(transform(s.lines, x -> named_struct('round', x.place,
    'kill_time_in_round', CAST(x.ln * 100 AS BIGINT), 'killer_puuid', CAST(x.sk AS STRING),
    'killer_display_name', x.s_name, 'killer_team', CASE WHEN x.ls = 'F' THEN 'Red' ELSE 'Blue' END,
    'victim_puuid', CAST(x.pk AS STRING), 'victim_display_name', concat('Part#', CAST(x.pk AS STRING)),
    'assistants', CASE WHEN x.ls = 'O' THEN array(named_struct('assistant_puuid', CAST(x.sk AS STRING)))
                       ELSE {empty_assistants} END,
    'player_locations_on_kill', array(named_struct('player_puuid', CAST(x.sk AS STRING),
                                                   'location', named_struct('x', 0L, 'y', 0L))))), {empty_kills}) AS kills,
  o.part, o.part * {part} AS first_round, o.part * {part} AS first_kill
FROM parts o
LEFT JOIN slices s ON o.o_orderkey = s.l_orderkey AND o.part = s.part
LEFT JOIN players p ON o.o_orderkey = p.l_orderkey AND o.part = p.part
"""

_LOC = "named_struct('x', x.pk, 'y', x.sk)"
_BOTH_LOCS = (f"array(named_struct('player_puuid', CAST(x.sk AS STRING), 'location', {_LOC}), named_struct('player_puuid', "
              "CAST(x.pk AS STRING), 'location', named_struct('x', x.sk, 'y', CAST(x.ln AS BIGINT))))")


def _match_lines(T: Tables) -> DataFrame:
    return placed(T.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag",
                                    "l_linestatus", "l_shipdate", "l_discount", "l_tax"),
                  ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_returnflag", "l_linestatus"],
                  "match_lines", "line_place")


def match_docs(T: Tables) -> DataFrame:
    """Match documents in the reference's shape, from orders.

    metadata <- the order (UUID-shaped match id); players <- suppliers of
    its lines (aggregated per order and supplier); rounds and kills <- its
    lines, in line order.  Return flag R lines carry a plant (with two
    locations), A lines a defuse (likewise); lines of 10 or more units carry
    two damage events; O lines one assistant.  A match with more than PART
    lines or players comes in several documents: ``part`` counts them,
    ``first_round`` / ``first_kill`` are the places of its first round and
    kill, and part 0 stands for the match (metadata, teams).  Orders without lines have empty players /
    rounds / kills.
    """
    return _nested_matches(T, _match_lines(T), T.lineitem, T.orders)


def match_doc_slices(T: Tables) -> Iterator[DataFrame]:
    """The documents of ``match_docs`` as several frames that share no match: ranges of order keys of about ``SLICE``
    lines.  Who stores one after another has the shuffles of one range at a time on disk."""
    lines, n = _match_lines(T), -(-T.lineitem.count() // SLICE)
    cuts = T.lineitem.approxQuantile("l_orderkey", [i / n for i in range(1, n)], 0.1 / n) if n > 1 else []
    ends = [None, *sorted({int(c) for c in cuts}), None]
    for low, high in zip(ends, ends[1:]):
        def here(df: DataFrame, key: str) -> DataFrame:
            # each key is in one range; what is null goes with the first
            if low is not None:
                df = df.filter(F.col(key) >= low)
            if high is not None:
                df = df.filter(F.col(key) < high if low is not None else (F.col(key) < high) | F.col(key).isNull())
            return df
        yield _nested_matches(T, here(lines, "l_orderkey"), here(T.lineitem, "l_orderkey"), here(T.orders, "o_orderkey"))


def _nested_matches(T: Tables, lines: DataFrame, all_lines: DataFrame, orders: DataFrame) -> DataFrame:
    from ..schemas import KILL, PLAYER, ROUND
    text = _MATCH_DOCS_SQL.replace("{part}", str(PART)).replace("{loc}", _LOC).replace("{both_locs}", _BOTH_LOCS) \
        .replace("{empty_damage}", _empty("struct<receiver_puuid: string, damage: bigint>")) \
        .replace("{empty_kill_events}", _empty("struct<kill_time_in_round: bigint>")) \
        .replace("{empty_assistants}", _empty("struct<assistant_puuid: string>")) \
        .replace("{empty_players}", _empty(PLAYER)).replace("{empty_rounds}", _empty(ROUND)) \
        .replace("{empty_kills}", _empty(KILL)) \
        .replace("{match_id}", match_id_sql("o.o_orderkey")) \
        .replace("{game_start}", _ts_epoch_sql("o.o_orderdate"))
    return T.spark.sql(text, lineitem=lines, all_lines=all_lines, supplier=T.supplier, orders=orders)
