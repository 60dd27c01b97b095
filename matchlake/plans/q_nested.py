"""Registered queries for the nested-data operators (§2.8) and sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import (explode_child, explode_positional, flatten_shallow, flatten_struct, union_by_name,
                         vertical_split)
from ..session import materialize, scratch_path, stored
from ..sources import explode_envelope, map_to_rows, maps_callouts, read_documents, read_replaced
from .derived import FULL_TEAM, SQL_ROSTER_SUPPLIERS, roster_suppliers
from .documents import conversation_docs, customer_docs, envelope_docs, maps_docs
from .registry import Tables, register

CONVERSATION_DOC = "conv_id bigint, first bigint, turns array<struct<turn: bigint, role: string, text: string>>"


@register("scan_nested", """
SELECT conv_id, turn, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos, role, text FROM conversations""")
def scan_nested(spark, d):
    """Documents written as JSON Lines, read back with an explicit schema."""
    path = scratch_path(spark, "scan_nested")
    conversation_docs(Tables(spark, d)).write.json(path)
    docs = read_documents(spark, path, CONVERSATION_DOC)
    out = explode_positional(docs, "turns", pos_name="pos", keep=["conv_id", "first"], alias="t")
    return out.select("conv_id", "t.turn", (F.col("first") + F.col("pos")).alias("pos"), "t.role", "t.text")


@register("flatten_child", "SELECT conv_id, turn, role, text FROM conversations")
def flatten_child(spark, d):
    docs = conversation_docs(Tables(spark, d))
    return explode_child(docs, "turns", keep=["conv_id"], alias="t", expand=True)


@register("flatten_positional", """
SELECT conv_id, turn, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos FROM conversations""")
def flatten_positional(spark, d):
    docs = conversation_docs(Tables(spark, d))
    out = explode_positional(docs, "turns", pos_name="pos", keep=["conv_id", "first"], alias="t")
    return out.select("conv_id", F.col("t.turn").alias("turn"), (F.col("first") + F.col("pos")).alias("pos"))


@register("flatten_shallow", "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def flatten_shallow_q(spark, d):
    o = Tables(spark, d).orders.select(
        F.struct("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate").alias("o"))
    return flatten_shallow(o, "o")


_ORDER_POS = """
WITH op AS (
  SELECT o_custkey, o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS order_pos
  FROM orders)"""


@register("flatten_grandchild", f"""{_ORDER_POS}
SELECT op.o_custkey, op.o_orderkey, op.order_pos, l.l_linenumber, l.l_suppkey, l.l_quantity
FROM op JOIN lineitem l ON op.o_orderkey = l.l_orderkey""")
def flatten_grandchild(spark, d):
    docs = customer_docs(Tables(spark, d))
    orders = explode_positional(docs, "orders", pos_name="pos", keep=["o_custkey", "first"], alias="o")
    lines = explode_child(orders, "o.lines", keep=["o_custkey", F.col("o.o_orderkey").alias("o_orderkey"),
                                                   (F.col("first") + F.col("pos")).alias("order_pos")], alias="l")
    return lines.select("o_custkey", "o_orderkey", "order_pos", "l.l_linenumber", "l.l_suppkey", "l.l_quantity")


@register("flatten_deep", """
SELECT o.o_custkey, o.o_orderkey, l.l_linenumber, l.l_suppkey AS charged_by, 'tax' AS kind, l.l_tax AS amount
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
UNION ALL
SELECT o.o_custkey, o.o_orderkey, l.l_linenumber, l.l_suppkey AS charged_by, 'discount' AS kind,
       l.l_discount AS amount
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey""")
def flatten_deep(spark, d):
    """Three levels (orders -> lines -> charges); the line's supplier is
    carried down renamed as ``charged_by``."""
    docs = customer_docs(Tables(spark, d))
    orders = explode_child(docs, "orders", keep=["o_custkey"], alias="o")
    lines = explode_child(orders, "o.lines", keep=["o_custkey", F.col("o.o_orderkey").alias("o_orderkey")],
                          alias="l")
    charges = explode_child(lines, "l.charges",
                            keep={"o_custkey": "o_custkey", "o_orderkey": "o_orderkey",
                                  "l_linenumber": "l.l_linenumber", "charged_by": "l.l_suppkey"},
                            alias="c", expand=True)
    return charges


@register("flatten_struct", """
SELECT l_orderkey, l_quantity AS amount_quantity, l_extendedprice AS amount_extended,
       l_returnflag AS status_returnflag, l_linestatus AS status_linestatus
FROM lineitem""")
def flatten_struct_q(spark, d):
    l = Tables(spark, d).lineitem
    nested = l.select("l_orderkey", F.struct(
        F.struct(F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("extended")).alias("amount"),
        F.struct(F.col("l_returnflag").alias("returnflag"), F.col("l_linestatus").alias("linestatus"),
                 F.struct(F.col("l_shipdate").alias("date")).alias("ship")).alias("status")).alias("line"))
    return flatten_struct(nested, ["line"], prefix=False, drop=["line.status.ship"])


@register("teams_wide", """
SELECT l_orderkey,
       CAST(COUNT_IF(l_linestatus = 'F') AS BIGINT) AS f_lines,
       CAST(SUM(CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS f_qty,
       CAST(COUNT_IF(l_linestatus = 'O') AS BIGINT) AS o_lines,
       CAST(SUM(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS o_qty
FROM lineitem GROUP BY l_orderkey""")
def teams_wide(spark, d):
    q = F.col("l_quantity").cast("bigint")
    side = {s: F.struct(F.count_if(F.col("l_linestatus") == s.upper()).alias("lines"),
                        F.sum(F.when(F.col("l_linestatus") == s.upper(), q).otherwise(0)).alias("qty"))
            for s in ("f", "o")}
    g = Tables(spark, d).lineitem.groupBy("l_orderkey").agg(
        F.struct(side["f"].alias("f"), side["o"].alias("o")).alias("teams"))
    return flatten_struct(g, ["teams"], prefix=False)


@register("vertical_split", """
SELECT 'customer' AS part, c_custkey, c_name, CAST(NULL AS INTEGER) AS c_nationkey,
       CAST(NULL AS DOUBLE) AS c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer
UNION ALL
SELECT 'customer_identity', c_custkey, NULL, c_nationkey, NULL, NULL FROM customer
UNION ALL
SELECT 'customer_account', c_custkey, NULL, NULL, c_acctbal, c_mktsegment FROM customer""")
def vertical_split_q(spark, d):
    c = Tables(spark, d).customer.select(
        "c_custkey", "c_name", F.struct("c_nationkey").alias("identity"),
        F.struct("c_acctbal", "c_mktsegment").alias("account"))
    parts = vertical_split(c, {"customer": None, "customer_identity": "identity", "customer_account": "account"},
                           keys=["c_custkey"])
    return union_by_name(*[df.withColumn("part", F.lit(name)) for name, df in parts.items()])


@register("map_to_rows", """
SELECT event_id, key, CAST(json_extract_string(props, '$.' || key) AS BIGINT) AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)""")
def map_to_rows_q(spark, d):
    return map_to_rows(Tables(spark, d).events, "props", value_type="bigint", keep=["event_id"])


@register("explode_envelope", """
SELECT c.c_name AS name, c.c_mktsegment AS tag, 'matches' AS endpoint, 200 AS status,
       o.o_orderkey AS matchid, o.o_orderpriority AS map
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def explode_envelope_q(spark, d):
    env = explode_envelope(envelope_docs(Tables(spark, d)))
    return env.select("name", "tag", "endpoint", "status", "match.matchid", "match.map")


@register("assets_callouts", """
SELECT CAST(r.r_regionkey AS VARCHAR) AS uuid, r.r_name AS displayName, n.n_name AS regionName,
       r.r_name AS superRegionName,
       CAST(ROUND(CAST(s.s_acctbal AS DECIMAL(18,9)), 1) AS DOUBLE) AS location_x,
       CAST(ROUND(CAST(s.s_acctbal / 7 AS DECIMAL(18,9)), 1) AS DOUBLE) AS location_y
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE r.r_name IS DISTINCT FROM 'EUROPE'""")
def assets_callouts(spark, d):
    return maps_callouts(maps_docs(Tables(spark, d)), skip_name="EUROPE", digits=1)


def _uuid5_duck(name: str) -> str:
    """DuckDB's form of the keys (name space OID), the digest bound once."""
    return (f"list_transform([sha1(from_hex('6ba7b8129dad11d180b400c04fd430c8') || encode({name}))], "
            "lambda h: substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || "
            "translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3) || '-' || substr(h, 21, 12))[1]")


# What each star table holds: the relation its rows come from (of the CTEs below) and its columns, in order.
_STAR_ROWS = [
    ("metadata", "o", "mid, o_orderpriority, CAST(epoch(o_orderdate) AS BIGINT), COALESCE(n_lines, 0)"),
    ("teams", "o", "o_orderstatus = 'F', f_lines, o_lines, o_orderstatus = 'O', o_lines, f_lines, mid"),
    ("player", "p", "sid, s_name, s_nationkey, team, level, tier, role, made, received, mid"),
    ("player_ability_casts", "p", "o_lines, last_line, mid, sid"),
    ("player_assets", "p", "'P' || min_part, 'P' || max_part, mid, sid"),
    ("player_behavior", "p", "CAST(trunc(max_discount) AS BIGINT), CAST(trunc(min_tax) AS BIGINT), level, made, mid, sid"),
    ("player_economy", "p", "made, mid, sid"),
    ("player_platform", "p", "'PC', team, mid, sid"),
    ("player_session_playtime", "p", "received * 1000, mid, sid"),
    ("player_stats", "p", "made, qty_n, qty_a, qty_r, mid, sid"),
    ("round", "r", "side, rf, mid, rid, place"),
    ("round_plant_events", "r LEFT JOIN plants USING (rid)", "ln1000, px, py, who, mid, rid, place"),
    ("round_defuse_events", "r LEFT JOIN defuses USING (rid)", "ln2000, px, py, who, mid, rid, place"),
    ("player_locations_on_plant", "r CROSS JOIN both_ends WHERE rf = 'R'", "IF(nth = 0, sid, pid), IF(nth = 0, pk, sk), IF(nth = 0, sk, ln), mid, rid, place, nth"),
    ("player_locations_on_defuse", "r CROSS JOIN both_ends WHERE rf = 'A'", "IF(nth = 0, sid, pid), IF(nth = 0, pk, sk), IF(nth = 0, sk, ln), mid, rid, place, nth"),
    ("round_player_stats", "r", "sid, s_name, IF(ls = 'F', qty, 0), IF(ls = 'O', qty, 0), ln, rf, 1, NULL, ln, 0, mid, rid, place"),
    ("round_player_damage_events", "r CROSS JOIN both_ends WHERE qty >= 10", "IF(nth = 0, pid, sid), IF(nth = 0, qty, ln), sid, mid, rid, place, nth"),
    ("kills", "r", "place, ln * 100, sid, s_name, side, pid, 'Part#' || pid, mid, rid, kid, place"),
    ("player_locations_on_kill", "r", "sid, 0, 0, kid, mid, place, 0"),
    ("assistants", "r WHERE ls = 'O'", "sid, kid, mid, place, 0"),
]


def _star_rows_sql() -> str:
    def row_text(columns: str) -> str:
        depth, cut, parts = 0, 0, []
        for i, c in enumerate(columns + ","):
            depth += (c == "(") - (c == ")")
            if c == "," and not depth:
                parts.append(columns[cut:i].strip())
                cut = i + 1
        return "concat_ws('|', " + ", ".join(f"COALESCE(CAST({x} AS VARCHAR), '~')" for x in parts) + ")"

    tables = " UNION ALL ".join(f"SELECT '{name}' AS table_name, {row_text(columns)} AS t FROM {relation}" for name, relation, columns in _STAR_ROWS)
    return f"""
WITH {SQL_DOCUMENT_STAR},
rows_of AS ({tables})
SELECT table_name, COUNT(*) AS n_rows, COUNT(*) AS n_keys,
       CAST(SUM(CAST('0x' || substr(md5(t), 1, 8) AS BIGINT)) AS BIGINT) AS content
FROM rows_of GROUP BY table_name"""


# The match documents' content by level: o matches, l and r rounds (r with keys), p players.
SQL_DOCUMENT_STAR = f"""
per_order AS (
  SELECT l_orderkey, COUNT(*) AS n_lines, COUNT_IF(l_linestatus = 'F') AS f_lines, COUNT_IF(l_linestatus = 'O') AS o_lines
  FROM lineitem GROUP BY l_orderkey),
o AS (
  SELECT *, {_uuid5_duck("'order-' || CAST(o_orderkey AS VARCHAR)")} AS mid
  FROM orders LEFT JOIN per_order ON o_orderkey = l_orderkey),
l AS (
  SELECT mid, l_linenumber AS ln, l_partkey AS pk, l_suppkey AS sk, CAST(l_partkey AS VARCHAR) AS pid,
         CAST(l_suppkey AS VARCHAR) AS sid, CAST(l_quantity AS BIGINT) AS qty, l_returnflag AS rf, l_linestatus AS ls,
         l_discount, l_tax, s_name, s_nationkey, IF(l_linestatus = 'F', 'Red', 'Blue') AS side,
         ROW_NUMBER() OVER (PARTITION BY lineitem.l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity,
                            l_returnflag, l_linestatus) - 1 AS place
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey JOIN o ON lineitem.l_orderkey = o_orderkey),
r AS (SELECT *, {_uuid5_duck("mid || place")} AS rid, {_uuid5_duck("mid || place || sid || pid")} AS kid FROM l),
plants AS (SELECT rid, ln * 1000 AS ln1000, pk AS px, sk AS py, sid AS who FROM r WHERE rf = 'R'),
defuses AS (SELECT rid, ln * 2000 AS ln2000, pk AS px, sk AS py, sid AS who FROM r WHERE rf = 'A'),
both_ends AS (SELECT unnest([0, 1]) AS nth),
p AS (
  SELECT mid, sid, s_name, s_nationkey, IF(COUNT_IF(ls = 'F') > 0, 'Red', 'Blue') AS team, COUNT(*) AS level, MIN(ln) AS tier,
         CASE WHEN COUNT_IF(rf = 'R') > 0 THEN 'striker' WHEN COUNT_IF(rf = 'A') > 0 THEN 'support' ELSE 'scout' END AS role,
         CAST(SUM(qty) AS BIGINT) AS made, CAST(SUM(ln) AS BIGINT) AS received, COUNT_IF(ls = 'O') AS o_lines, MAX(ln) AS last_line,
         MIN(pk) AS min_part, MAX(pk) AS max_part, MAX(l_discount) AS max_discount, MIN(l_tax) AS min_tax,
         COALESCE(SUM(qty) FILTER (WHERE rf = 'A'), 0) AS qty_a, COALESCE(SUM(qty) FILTER (WHERE rf = 'N'), 0) AS qty_n,
         COALESCE(SUM(qty) FILTER (WHERE rf = 'R'), 0) AS qty_r
  FROM l GROUP BY mid, sid, s_name, s_nationkey)"""


@register("star_from_documents", _star_rows_sql())
def star_from_documents(spark, d):
    """Match documents made from orders, loaded into the 20-table star by the
    incremental loader, then per table: rows, distinct keys, and an
    order-free sum over a digest of every row's columns."""
    from functools import reduce

    from ..operators import count_distinct
    from .documents import match_doc_slices
    from .load import load_documents, read_star
    from .star import TABLE_KEYS

    warehouse = scratch_path(spark, "warehouse")
    load_documents(spark, match_doc_slices(Tables(spark, d)), warehouse)
    parts = []
    for name, df in read_star(spark, warehouse).items():
        text = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("~")) for c in df.columns])
        digest = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
        # keys are told apart by 128 bits, which is less to shuffle than their texts; none where a part is null
        keys = TABLE_KEYS[name]
        whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        key = [F.when(whole, F.xxhash64(F.lit(n), *keys)) for n in (1, 2)]
        # one table after another, so that the keys of one lie on disk, not those of all
        parts.append(materialize(df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                                        count_distinct(*key).alias("n_keys"), F.sum(digest).alias("content")), "counted"))
    return reduce(lambda a, b: a.unionByName(b), parts)


@register("marts_replace", f"""
WITH {SQL_DOCUMENT_STAR}, {SQL_ROSTER_SUPPLIERS},
ids AS (SELECT CAST(puuid AS VARCHAR) AS sid FROM roster),
sides AS (SELECT DISTINCT mid, team FROM p SEMI JOIN ids USING (sid)),
seen AS (SELECT o_orderpriority AS map, sides.team = l.side AS won FROM o LEFT JOIN sides USING (mid) LEFT JOIN l USING (mid))
SELECT 'headshots_per_weapon' AS mart, COUNT(DISTINCT (sid, rf)) AS n_rows FROM l SEMI JOIN ids USING (sid)
UNION ALL SELECT 'first_kill_and_death_ratio', COUNT(DISTINCT sid) FROM p SEMI JOIN ids USING (sid)
UNION ALL SELECT 'first_kill_impact_round_win', COUNT(*) FROM (SELECT DISTINCT map, won FROM seen)
UNION ALL SELECT 'first_kill_outcome_split', COUNT(*) FROM (SELECT DISTINCT map, won FROM seen WHERE won IS NOT NULL)
UNION ALL SELECT 'consolidated_matches_data', COUNT(*) FROM p SEMI JOIN ids USING (sid)""")
def marts_replace(spark, d):
    """Every mart built from the star of match documents, slice by slice, and replaced twice; rows of each as read back."""
    from functools import reduce

    from .analytical import build_marts, write_marts
    from .documents import match_doc_slices
    from .star import build_star, with_keys

    T = Tables(spark, d)
    who = materialize(roster_suppliers(T).select(F.col("s_suppkey").cast("string").alias("puuid"), F.col("s_name").alias("name")), "roster")

    def stars():
        for docs in match_doc_slices(T):
            with stored(with_keys(docs), "documents") as docs:
                yield build_star(docs, keyed=True)

    built = build_marts(stars(), who.select("puuid"), who.select("name"), full_team=FULL_TEAM)
    root = scratch_path(spark, "marts")
    for _ in range(2):      # made once, replaced twice
        write_marts(built, root)
    counts = [read_replaced(spark, f"{root}/{name}").agg(F.lit(name).alias("mart"), F.count(F.lit(1)).alias("n_rows")) for name in built]
    return reduce(lambda a, b: a.unionByName(b), counts)
