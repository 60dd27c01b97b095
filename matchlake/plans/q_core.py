"""Registered queries for the relational and scalar operators (§2.3-2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (concat_key, epoch_to_ts, format_ts, id_from_path, md5_key, nan_to_null,
                         null_tokens, percent, ratio, shift_hours, ts_to_epoch, uuid5)
from ..operators import (cond_count_distinct, count_distinct, dedupe, first_per_group, flag_first,
                         full_group_flag, is_false, is_true, only_new, roster_filter, star_except,
                         top1_rows, union_all, union_by_name)
from ..operators.contract import cast_first_n
from .derived import (SQL_ORDER_STAR, SQL_ROSTER_SUPPLIERS, line_players, order_lines, player_tags, qty,
                      roster_supplier_keys, roster_supplier_names)
from .registry import Tables, register

# Fixed values of the bindings: the "already loaded" cut and status words.
LOADED_BEFORE = "1995-01-01"
PENDING = "P"


def _r(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(18,9)), {n}) AS DOUBLE)"


# ----------------------------------------------------------- projections / filters

@register("project", """
SELECT o_orderkey AS matchid, o_orderpriority AS map, o_orderdate AS game_start, o_custkey, o_orderstatus
FROM orders""")
def project(spark, d):
    o = Tables(spark, d).orders
    return (o.select("o_orderkey", "o_orderpriority", "o_orderdate", "o_custkey", "o_orderstatus", "o_totalprice")
             .withColumnRenamed("o_orderkey", "matchid")
             .toDF("matchid", "map", "game_start", "o_custkey", "o_orderstatus", "o_totalprice")
             .drop("o_totalprice"))


@register("star_except", "SELECT * EXCLUDE (l_extendedprice, l_discount, l_tax) FROM lineitem")
def star_except_q(spark, d):
    return star_except(Tables(spark, d).lineitem, "l_extendedprice", "l_discount", "l_tax")


@register("filter_eq", "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'F'")
def filter_eq(spark, d):
    return Tables(spark, d).orders.filter(F.col("o_orderstatus") == "F") \
        .select("o_orderkey", "o_orderstatus", "o_orderpriority")


@register("filter_ne", """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IS DISTINCT FROM '5-LOW'""")
def filter_ne(spark, d):
    return Tables(spark, d).orders.filter(~F.col("o_orderpriority").eqNullSafe("5-LOW")) \
        .select("o_orderkey", "o_orderpriority")


@register("filter_in", """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def filter_in(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderpriority")
    return roster_filter(o, "o_orderpriority", ["1-URGENT", "2-HIGH"])


@register("three_valued", """
WITH per_order AS (
  SELECT o.o_orderkey, bool_and(l.l_returnflag = 'R') AS all_returned
  FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY o.o_orderkey)
SELECT all_returned, COUNT(*) AS n_orders,
       CAST(COUNT_IF(all_returned IS TRUE) AS BIGINT) AS n_true, CAST(COUNT_IF(all_returned IS FALSE) AS BIGINT) AS n_false,
       CAST(COUNT_IF(all_returned IS NULL) AS BIGINT) AS n_unknown
FROM per_order GROUP BY all_returned""")
def three_valued(spark, d):
    T = Tables(spark, d)
    flags = T.lineitem.groupBy("l_orderkey").agg(F.bool_and(F.col("l_returnflag") == "R").alias("all_returned"))
    per_order = T.orders.select("o_orderkey").join(flags, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    a = F.col("all_returned")
    return per_order.groupBy("all_returned").agg(
        F.count(F.lit(1)).alias("n_orders"), F.count_if(is_true(a)).alias("n_true"),
        F.count_if(is_false(a)).alias("n_false"), F.count_if(a.isNull()).alias("n_unknown"))


# ----------------------------------------------------------------------- joins

@register("left_join", f"""
WITH {SQL_ORDER_STAR}
SELECT o.o_orderkey, o.o_orderstatus, ol.n_lines, ol.f_lines
FROM orders o LEFT JOIN order_lines ol ON o.o_orderkey = ol.matchid""")
def left_join(spark, d):
    T = Tables(spark, d)
    ol = order_lines(T).select("matchid", "n_lines", "f_lines")
    return T.orders.select("o_orderkey", "o_orderstatus") \
        .join(ol, F.col("o_orderkey") == F.col("matchid"), "left").drop("matchid")


@register("left_join_2key", f"""
WITH {SQL_ORDER_STAR}
SELECT m.o_orderkey, p.puuid, p.team, lp.score, lp.headshots
FROM orders m
LEFT JOIN player p ON m.o_orderkey = p.matchid
LEFT JOIN line_players lp ON m.o_orderkey = lp.matchid AND p.puuid = lp.puuid""")
def left_join_2key(spark, d):
    T = Tables(spark, d)
    m = T.orders.select("o_orderkey").alias("m")
    p = line_players(T).select("matchid", "puuid", "team").alias("p")
    ps = line_players(T).select("matchid", "puuid", "score", "headshots").alias("ps")
    return (m.join(p, F.col("m.o_orderkey") == F.col("p.matchid"), "left")
             .join(ps, (F.col("m.o_orderkey") == F.col("ps.matchid")) & (F.col("p.puuid") == F.col("ps.puuid")),
                   "left")
             .select("m.o_orderkey", "p.puuid", "p.team", "ps.score", "ps.headshots"))


@register("left_to_inner", f"""
WITH {SQL_ROSTER_SUPPLIERS}, {SQL_ORDER_STAR}
SELECT m.o_orderkey, m.o_orderpriority, p.name, p.level
FROM orders m LEFT JOIN player p ON m.o_orderkey = p.matchid
WHERE p.name IN (SELECT name FROM roster)""")
def left_to_inner(spark, d):
    T = Tables(spark, d)
    p = line_players(T).select("matchid", "puuid", "level").join(player_tags(T).select("puuid", "name"), "puuid", "left") \
        .select("matchid", "name", "level")
    j = T.orders.select("o_orderkey", "o_orderpriority").join(p, F.col("o_orderkey") == F.col("matchid"), "left")
    return roster_filter(j, "name", roster_supplier_names(T)).select("o_orderkey", "o_orderpriority", "name", "level")


@register("semi_join_roster", f"""
WITH {SQL_ROSTER_SUPPLIERS}
SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey IN (SELECT puuid FROM roster)""")
def semi_join_roster(spark, d):
    T = Tables(spark, d)
    return roster_filter(T.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey"), "l_suppkey",
                         roster_supplier_keys(T))


@register("anti_join_new", f"""
SELECT DISTINCT l_orderkey AS matchid FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '{LOADED_BEFORE}')
  AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = '{PENDING}')""")
def anti_join_new(spark, d):
    T = Tables(spark, d)
    stored = T.lineitem.select(F.col("l_orderkey").alias("matchid")).distinct()
    loaded = T.orders.filter(F.col("o_orderdate") < F.lit(LOADED_BEFORE).cast("timestamp_ntz"))
    ignored = T.orders.filter(F.col("o_orderstatus") == PENDING)
    return only_new(only_new(stored, loaded, "matchid", "o_orderkey"), ignored, "matchid", "o_orderkey")


@register("agg_join_back", f"""
WITH {SQL_ORDER_STAR},
mvp AS (
  SELECT matchid, puuid, TRUE AS match_mvp FROM (
    SELECT matchid, puuid, ROW_NUMBER() OVER (PARTITION BY matchid
                                             ORDER BY score DESC NULLS LAST, puuid ASC NULLS FIRST) AS rn
    FROM line_players) WHERE rn = 1)
SELECT lp.matchid, lp.puuid, lp.score, COALESCE(mvp.match_mvp, FALSE) AS match_mvp
FROM line_players lp LEFT JOIN mvp ON lp.matchid = mvp.matchid AND lp.puuid = mvp.puuid""")
def agg_join_back(spark, d):
    ps = line_players(Tables(spark, d)).select("matchid", "puuid", "score")
    mvp = top1_rows(ps, ["matchid"], [("score", "desc"), "puuid"], flag="match_mvp").select(
        "matchid", "puuid", "match_mvp")
    return ps.join(mvp, ["matchid", "puuid"], "left").select(
        "matchid", "puuid", "score", F.coalesce(F.col("match_mvp"), F.lit(False)).alias("match_mvp"))


# ---------------------------------------------------------------- aggregations

@register("distinct_ids", "SELECT DISTINCT l_orderkey FROM lineitem")
def distinct_ids(spark, d):
    return Tables(spark, d).lineitem.select("l_orderkey").distinct()


@register("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark, d):
    return Tables(spark, d).lineitem.select("l_returnflag", "l_linestatus").distinct()


_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus", "l_shipdate"]


@register("dedupe", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey
                               ORDER BY {", ".join(c + " ASC NULLS FIRST" for c in _LINE_ORDER)}) AS rn
  FROM lineitem) WHERE rn = 1""")
def dedupe_q(spark, d):
    return dedupe(Tables(spark, d).lineitem, ["l_orderkey"], _LINE_ORDER)


@register("count_distinct", """
SELECT l_suppkey, COUNT(DISTINCT l_orderkey) AS n_matches FROM lineitem GROUP BY l_suppkey""")
def count_distinct_q(spark, d):
    return Tables(spark, d).lineitem.groupBy("l_suppkey").agg(count_distinct("l_orderkey").alias("n_matches"))


@register("count_distinct_pair", """
SELECT l_suppkey,
       COUNT(DISTINCT CASE WHEN l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
                           THEN (l_orderkey, l_linenumber) END) AS n_rounds
FROM lineitem GROUP BY l_suppkey""")
def count_distinct_pair(spark, d):
    return Tables(spark, d).lineitem.groupBy("l_suppkey").agg(
        count_distinct("l_orderkey", "l_linenumber").alias("n_rounds"))


@register("cond_distinct", """
SELECT l_suppkey,
       COUNT(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS n_returned,
       COUNT(DISTINCT CASE WHEN l_returnflag = 'A' THEN l_orderkey END) AS n_accepted,
       COUNT(DISTINCT CASE WHEN l_linestatus = 'F' THEN (l_orderkey, l_linenumber) END) AS n_final_lines
FROM lineitem GROUP BY l_suppkey""")
def cond_distinct(spark, d):
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return Tables(spark, d).lineitem.groupBy("l_suppkey").agg(
        cond_count_distinct(flag == "R", "l_orderkey").alias("n_returned"),
        cond_count_distinct(flag == "A", "l_orderkey").alias("n_accepted"),
        cond_count_distinct(status == "F", "l_orderkey", "l_linenumber").alias("n_final_lines"))


@register("full_group_flag", """
SELECT l_orderkey, COUNT(DISTINCT l_returnflag) = 3 AS all_flags FROM lineitem GROUP BY l_orderkey""")
def full_group_flag_q(spark, d):
    return full_group_flag(Tables(spark, d).lineitem, ["l_orderkey"], "l_returnflag", 3, "all_flags")


# ---------------------------------------------------------------- windows / top-1

@register("top1_per_group", """
SELECT l_orderkey, l_suppkey, l_linenumber, l_extendedprice, TRUE AS match_mvp FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey
                               ORDER BY l_extendedprice DESC NULLS LAST, l_linenumber ASC NULLS FIRST,
                                        l_suppkey ASC NULLS FIRST) AS rn
  FROM lineitem) WHERE rn = 1""")
def top1_per_group(spark, d):
    l = Tables(spark, d).lineitem.select("l_orderkey", "l_suppkey", "l_linenumber", "l_extendedprice")
    return top1_rows(l, ["l_orderkey"], [("l_extendedprice", "desc"), "l_linenumber", "l_suppkey"],
                     flag="match_mvp")


@register("first_per_group", """
SELECT user_id, day, event_id, event_type, ts FROM (
  SELECT user_id, CAST(ts AS DATE) AS day, event_id, event_type, ts,
         ROW_NUMBER() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                            ORDER BY ts ASC NULLS FIRST, event_id ASC NULLS FIRST) AS rn
  FROM events) WHERE rn = 1""")
def first_per_group_q(spark, d):
    e = Tables(spark, d).events.select("user_id", F.to_date("ts").alias("day"), "event_id", "event_type", "ts")
    return first_per_group(e, ["user_id", "day"], ["ts", "event_id"])


@register("latest_flag", """
SELECT o_orderkey, o_custkey, o_orderdate,
       ROW_NUMBER() OVER (PARTITION BY o_custkey
                          ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) = 1 AS last_order
FROM orders""")
def latest_flag(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return flag_first(o, ["o_custkey"], [("o_orderdate", "desc"), ("o_orderkey", "desc")], ["o_orderkey"],
                      "last_order")


# ------------------------------------------------------------------ set ops

@register("inline_union", """
SELECT c_custkey AS id, 'customer' AS source FROM customer
UNION ALL
SELECT s_suppkey AS id, 'supplier' AS source FROM supplier""")
def inline_union(spark, d):
    T = Tables(spark, d)
    return union_all(T.customer.select(F.col("c_custkey").alias("id"), F.lit("customer").alias("source")),
                     T.supplier.select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("source")))


@register("union_by_name", """
SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal,
       CAST(NULL AS VARCHAR) AS segment FROM supplier
UNION ALL
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS segment FROM customer""")
def union_by_name_q(spark, d):
    T = Tables(spark, d)
    s = T.supplier.toDF("key", "name", "nationkey", "acctbal")
    c = T.customer.select(F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("acctbal"),
                          F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                          F.col("c_nationkey").alias("nationkey"))
    return union_by_name(s, c)


# ---------------------------------------------------------------- scalar

@register("case_outcome", f"""
WITH {SQL_ORDER_STAR},
outcome AS (
  SELECT p.matchid, p.puuid, p.team,
         COALESCE(CASE p.team WHEN 'Red' THEN t.red_has_won WHEN 'Blue' THEN t.blue_has_won END, FALSE) AS side_won
  FROM player p LEFT JOIN teams t USING (matchid))
SELECT matchid, puuid, team, side_won AS we_won, side_won AS has_won_the_match,
       COALESCE(team = 'Red', FALSE) AS start_on_attack FROM outcome""")
def case_outcome(spark, d):
    T = Tables(spark, d)
    o = T.orders.select(F.col("o_orderkey").alias("matchid"), (F.col("o_orderstatus") == "F").alias("red_has_won"),
                        (F.col("o_orderstatus") == "O").alias("blue_has_won"))
    team = F.col("team")
    won = F.coalesce(F.when(team == "Red", F.col("red_has_won")).when(team == "Blue", F.col("blue_has_won")), F.lit(False))
    return line_players(T).select("matchid", "puuid", "team").join(o, "matchid", "left").select(
        "matchid", "puuid", "team", won.alias("we_won"), won.alias("has_won_the_match"),
        F.coalesce(team == "Red", F.lit(False)).alias("start_on_attack"))


@register("round_ratio", f"""
WITH g AS (
  SELECT l_suppkey,
         SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS qty_returned,
         SUM(CAST(l_quantity AS BIGINT)) AS qty, COUNT(*) AS n_lines,
         COUNT_IF(l_returnflag = 'R') AS n_returned
  FROM lineitem GROUP BY l_suppkey)
SELECT l_suppkey, CAST(qty_returned AS BIGINT) AS qty_returned, CAST(qty AS BIGINT) AS qty,
       {_r("qty_returned / NULLIF(qty, 0) * 100", 2)} AS pct_returned,
       {_r("qty_returned / NULLIF(qty, 0)", 3)} AS ratio_returned,
       {_r("n_returned / NULLIF(n_lines, 0)", 3)} / NULLIF({_r("(n_lines - n_returned) / NULLIF(n_lines, 0)", 3)}, 0)
         AS returned_vs_kept
FROM g""")
def round_ratio(spark, d):
    g = Tables(spark, d).lineitem.groupBy("l_suppkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", qty()).otherwise(0)).alias("qty_returned"),
        F.sum(qty()).alias("qty"), F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"))
    kept = F.col("n_lines") - F.col("n_returned")
    return g.select("l_suppkey", "qty_returned", "qty",
                    percent("qty_returned", "qty", 2).alias("pct_returned"),
                    ratio("qty_returned", "qty", 3).alias("ratio_returned"),
                    F.try_divide(ratio("n_returned", "n_lines", 3), ratio(kept, "n_lines", 3)).alias("returned_vs_kept"))


@register("concat_key", """
SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) || CAST(l_linenumber AS VARCHAR) AS round_key
FROM lineitem""")
def concat_key_q(spark, d):
    l = Tables(spark, d).lineitem
    return l.select("l_orderkey", "l_linenumber", concat_key("l_orderkey", "l_linenumber").alias("round_key"))


_UUID_SQL = """
WITH h AS (
  SELECT o_orderkey, sha1(from_hex('6ba7b8129dad11d180b400c04fd430c8')
                          || encode(CAST(o_orderkey AS VARCHAR) || o_orderpriority)) AS x
  FROM orders)
SELECT o_orderkey,
       substr(x, 1, 8) || '-' || substr(x, 9, 4) || '-5' || substr(x, 14, 3) || '-'
       || lower(printf('%02x', (CAST(('0x' || substr(x, 17, 2)) AS INTEGER) & 63) | 128))
       || substr(x, 19, 2) || '-' || substr(x, 21, 12) AS round_id
FROM h"""


@register("uuid5_key", _UUID_SQL)
def uuid5_key(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", uuid5(concat_key("o_orderkey", "o_orderpriority")).alias("round_id"))


@register("md5_key", """
SELECT event_id, md5(CAST(user_id AS VARCHAR) || event_type || CAST(event_id AS VARCHAR)) AS id FROM events""")
def md5_key_q(spark, d):
    return Tables(spark, d).events.select("event_id", md5_key("user_id", "event_type", "event_id").alias("id"))


@register("epoch_to_ts", """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS game_start,
       make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000) AS game_start_ts
FROM events""")
def epoch_to_ts_q(spark, d):
    e = Tables(spark, d).events.select("event_id", ts_to_epoch("ts").alias("game_start"))
    return e.withColumn("game_start_ts", epoch_to_ts("game_start"))


@register("local_time", """
SELECT event_id, strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%dT%H:%M:%S') AS dt_extract,
       date_trunc('second', ts - INTERVAL 3 HOUR) AS local_ts
FROM events""")
def local_time(spark, d):
    from ..functions.time import parse_ts
    e = Tables(spark, d).events.select("event_id", format_ts(shift_hours("ts", -3)).alias("dt_extract"))
    return e.withColumn("local_ts", parse_ts("dt_extract"))


@register("null_normalise", """
SELECT event_id,
       CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS event_type,
       CASE WHEN event_type = 'view' THEN NULL ELSE value END AS value
FROM events""")
def null_normalise(spark, d):
    e = Tables(spark, d).events
    raw = e.select("event_id",
                   F.when(F.col("event_type") == "error", "nan").otherwise(F.col("event_type")).alias("event_type"),
                   F.when(F.col("event_type") == "view", F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))
    return raw.select("event_id", null_tokens("event_type").alias("event_type"), nan_to_null("value").alias("value"))


@register("cast_first_n", """
SELECT CAST(trunc(l_quantity) AS BIGINT) AS l_quantity, CAST(trunc(l_extendedprice) AS BIGINT) AS l_extendedprice,
       CAST(trunc(l_discount) AS BIGINT) AS l_discount, CAST(trunc(l_tax) AS BIGINT) AS l_tax, l_returnflag
FROM lineitem""")
def cast_first_n_q(spark, d):
    l = Tables(spark, d).lineitem.select("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    return cast_first_n(l, 4)


@register("ids_from_paths", """
SELECT page_id, regexp_extract(url, '([^/?#]+?)(\\.[A-Za-z0-9]+)?([?#].*)?$', 1) AS doc_key FROM pages""")
def ids_from_paths(spark, d):
    return Tables(spark, d).pages.select("page_id", id_from_path("url").alias("doc_key"))
