"""Registered queries for sinks, incremental loads, streams and checks.

Each writes to a fresh folder under the checkpoint root, reads the result
back with Spark and returns it, so the check covers the written data.
"""

from __future__ import annotations

import json

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ..functions.time import ISO_SECONDS, format_ts, shift_hours
from ..operators import check_castable, check_not_null, check_report, check_unique, enforce, read_checks, read_contract
from ..operators.relational import only_new
from ..schemas import API_ERROR_LOG, MATCH_IN_STORAGE
from ..session import scratch_path
from ..sources import append, as_view, error_log, land_json, overwrite_partitions, read_replaced, replace, snapshot
from ..streaming import file_stream, keep_first, read_kept, run_available
from .derived import order_lines
from .q_core import LOADED_BEFORE
from .registry import Tables, register

# Fixed values of the bindings.
RUN_TIMES = ("2024-02-01T00:00:00", "2024-02-02T00:00:00")
RELOAD_YEAR = 1995

# Contract applied to the text form of ``events`` (``props`` is JSON text
# under "int", so every value is rejected).
EVENT_CONTRACT = {"int": ["event_id", "user_id", "props"], "float": ["value"], "bool": ["is_error"],
                  "str": ["event_type"]}

DECLARED_CHECKS = {"lineitem": {"l_orderkey,l_linenumber": ["unique"]}, "orders": {"o_orderkey": ["unique"]},
                   "order_lines": {"n_lines": ["not_null"]}, "customer": {"c_name": ["not_null"]}}


def _events_as_text(T: Tables):
    e = T.events
    return e.select(*[F.col(c).cast("string").alias(c) for c in ("event_id", "user_id", "value", "props")],
                    "event_type",
                    F.when(F.col("event_type") == "error", "true").otherwise("false").alias("is_error"))


@register("sink_append", "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def sink_append(spark, d):
    path = scratch_path(spark, "sink_append")
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    append(o.filter(F.col("o_orderstatus") == "F"), path)
    append(o.filter(~F.col("o_orderstatus").eqNullSafe("F")), path)
    return spark.read.parquet(path)


@register("sink_replace", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def sink_replace(spark, d):
    path = scratch_path(spark, "sink_replace")
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus")
    replace(o, path)
    replace(o.filter(F.col("o_orderstatus") != "P"), path)
    return read_replaced(spark, path)


@register("replace_fails", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def replace_fails(spark, d):
    """A replace that dies on some of its rows, and one that dies before it is made current: readers see the content before."""
    path = scratch_path(spark, "replace_fails")
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus")
    replace(o.filter(F.col("o_orderstatus") != "P"), path)
    try:
        bad = F.when(F.col("o_orderstatus") == "P", F.raise_error(F.lit("pending"))).otherwise(F.col("o_orderstatus"))
        replace(o.select("o_orderkey", bad.cast("string").alias("o_orderstatus")), path)
    except PySparkException:
        pass
    o.filter(F.col("o_orderstatus") == "P").write.parquet(f"{path}/content-of-a-dead-run")
    return read_replaced(spark, path)


@register("sink_view", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def sink_view(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus")
    as_view(o, "matchlake_settled_orders")
    return as_view(o.filter(F.col("o_orderstatus") != "P"), "matchlake_settled_orders")


@register("land_json", "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def land_json_q(spark, d):
    path = scratch_path(spark, "land_json")
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    land_json(o, path)
    return spark.read.schema("o_orderkey bigint, o_orderstatus string, o_totalprice double, "
                             "o_orderdate timestamp_ntz").json(path)


@register("idempotent_load", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS load_year FROM orders""")
def idempotent_load(spark, d):
    """Full load, then a re-run of one whole load partition: same rows."""
    path = scratch_path(spark, "idempotent_load")
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderstatus",
                                       F.year("o_orderdate").alias("load_year"))
    overwrite_partitions(o, path, ["load_year"])
    overwrite_partitions(o.filter(F.col("load_year") == RELOAD_YEAR), path, ["load_year"])
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", "o_orderstatus",
                                           F.col("load_year").cast("int").alias("load_year"))


@register("snapshot_append", f"""
SELECT TIMESTAMP '{RUN_TIMES[0].replace("T", " ")}' AS datetime, CAST(l_orderkey AS VARCHAR) AS matchid
FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linestatus = 'F')
UNION ALL
SELECT TIMESTAMP '{RUN_TIMES[1].replace("T", " ")}' AS datetime, CAST(l_orderkey AS VARCHAR) AS matchid
FROM (SELECT DISTINCT l_orderkey FROM lineitem)""")
def snapshot_append(spark, d):
    path = scratch_path(spark, "snapshot_append")
    l = Tables(spark, d).lineitem
    first = l.filter(F.col("l_linestatus") == "F").select(F.col("l_orderkey").cast("string").alias("matchid"))
    second = l.select(F.col("l_orderkey").cast("string").alias("matchid"))
    append(snapshot(first.distinct(), RUN_TIMES[0]), path, schema=MATCH_IN_STORAGE)
    append(snapshot(second.distinct(), RUN_TIMES[1]), path, schema=MATCH_IN_STORAGE)
    return spark.read.schema(MATCH_IN_STORAGE).parquet(path)


@register("api_errors", """
SELECT md5(strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%dT%H:%M:%S') || CAST(user_id AS VARCHAR) || event_type) AS id,
       date_trunc('second', ts - INTERVAL 3 HOUR) AS datetime,
       CAST(user_id AS VARCHAR) AS name, event_type AS tag, 'matches' AS endpoint, 500 AS status
FROM events WHERE event_type = 'error'""")
def api_errors(spark, d):
    """Each event is an API call made at its own local (UTC-3) time; error
    events failed with status 500."""
    e = Tables(spark, d).events
    calls = e.select(format_ts(shift_hours("ts", -3), ISO_SECONDS).alias("run_time"),
                     F.col("user_id").cast("string").alias("name"), F.col("event_type").alias("tag"),
                     F.lit("matches").alias("endpoint"),
                     F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"))
    path = scratch_path(spark, "api_errors")
    append(error_log(calls, F.col("run_time")), path, schema=API_ERROR_LOG)
    return spark.read.schema(API_ERROR_LOG).parquet(path)


@register("incremental_batch", f"""
SELECT matchid, fetched_by FROM (
  SELECT l_orderkey AS matchid, l_suppkey AS fetched_by,
         ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_suppkey ASC NULLS FIRST) AS rn
  FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '{LOADED_BEFORE}'))
WHERE rn = 1""")
def incremental_batch(spark, d):
    """Documents fetched this run (one per line: the supplier fetched the
    order): the first copy of each, less those already stored.  Copies are
    reduced map-side before anything is joined."""
    T = Tables(spark, d)
    fetched = T.lineitem.select(F.col("l_orderkey").alias("matchid"), F.col("l_suppkey").alias("fetched_by"))
    stored = T.orders.filter(F.col("o_orderdate") < F.lit(LOADED_BEFORE).cast("timestamp_ntz"))
    first = fetched.groupBy("matchid").agg(F.min(F.struct(F.col("fetched_by").isNotNull(), "fetched_by"))["fetched_by"].alias("fetched_by"))
    return only_new(first, stored, "matchid", "o_orderkey")


@register("stream_new_files", "SELECT event_id, user_id, event_type FROM events")
def stream_new_files(spark, d):
    """Two landings, one run after each: every file is processed once."""
    base = scratch_path(spark, "stream_new_files")
    e = Tables(spark, d).events.select("event_id", "user_id", "event_type")
    schema = "event_id bigint, user_id bigint, event_type string"
    e.filter(F.col("event_type") == "purchase").write.parquet(f"{base}/landing/batch=1")
    for batch in (1, 2):
        if batch == 2:
            e.filter(~F.col("event_type").eqNullSafe("purchase")).write.parquet(f"{base}/landing/batch=2")
        stream = file_stream(spark, f"{base}/landing/*", schema)
        run_available(stream, f"{base}/sink", f"{base}/checkpoint")
    return spark.read.schema(schema).parquet(f"{base}/sink")


# Three landings: users of some last digits come first in each, and later ones repeat users of earlier ones.
_LANDING_SQL = """CASE WHEN event_type = 'view' AND RIGHT(CAST(user_id AS STRING), 1) IN ('0', '1', '2') THEN 0
  WHEN event_type IN ('view', 'click') AND RIGHT(CAST(user_id AS STRING), 1) IN ('0', '1', '2', '3', '4', '5') THEN 1 ELSE 2 END"""


def _kept_events(spark, d, name):
    base = scratch_path(spark, name)
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint"
    e = Tables(spark, d).events.withColumn("landing", F.expr(_LANDING_SQL))
    for n in range(3):
        e.filter(F.col("landing") == n).select("event_id", "ts", "user_id").write.parquet(f"{base}/landing/batch={n}")
        keep_first(file_stream(spark, f"{base}/landing/*", schema), f"{base}/sink", f"{base}/checkpoint", ["user_id"], ["ts", "event_id"])
    return read_kept(spark, f"{base}/sink", schema)


@register("stream_dedupe", "SELECT DISTINCT user_id FROM events")
def stream_dedupe(spark, d):
    """Three landings over the whole span of time, a run after each: each user once, with no delay to be set."""
    return _kept_events(spark, d, "stream_dedupe").select("user_id")


@register("stream_keep_first", f"""
SELECT user_id, event_id, ts FROM (
  SELECT user_id, event_id, ts, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY landing, ts NULLS FIRST, event_id) AS rn
  FROM (SELECT *, {_LANDING_SQL} AS landing FROM events))
WHERE rn = 1""")
def stream_keep_first(spark, d):
    """Which event of each user is kept: the earliest of the landing in which the user came first."""
    return _kept_events(spark, d, "stream_keep_first").select("user_id", "event_id", "ts")


@register("enforce_schema", """
SELECT event_id, user_id, value, CAST(NULL AS BIGINT) AS props, event_type,
       event_type = 'error' AS is_error
FROM events""")
def enforce_schema(spark, d):
    """The contract is written as JSON and read from there, as a load would find it."""
    path = scratch_path(spark, "contract")
    spark.createDataFrame([(json.dumps(EVENT_CONTRACT),)], "value string").coalesce(1).write.text(path)
    return enforce(_events_as_text(Tables(spark, d)), read_contract(spark, path))


@register("check_castable", """
SELECT 'event_id' AS "column", 'bigint' AS target_type, CAST(0 AS BIGINT) AS rejected
UNION ALL SELECT 'user_id', 'bigint', 0
UNION ALL SELECT 'props', 'bigint', (SELECT COUNT(*) FROM events WHERE props IS NOT NULL)
UNION ALL SELECT 'value', 'double', 0
UNION ALL SELECT 'is_error', 'boolean', 0
UNION ALL SELECT 'event_type', 'string', 0""")
def check_castable_q(spark, d):
    return check_castable(_events_as_text(Tables(spark, d)), EVENT_CONTRACT)


@register("check_unique", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""")
def check_unique_q(spark, d):
    return check_unique(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"])


@register("check_not_null", """
SELECT o.o_orderkey, ol.n_lines FROM orders o
LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n_lines FROM lineitem GROUP BY l_orderkey) ol
  ON o.o_orderkey = ol.l_orderkey
WHERE ol.n_lines IS NULL""")
def check_not_null_q(spark, d):
    T = Tables(spark, d)
    j = T.orders.select("o_orderkey").join(order_lines(T).select("matchid", "n_lines"),
                                           F.col("o_orderkey") == F.col("matchid"), "left").drop("matchid")
    return check_not_null(j, "n_lines")


@register("check_report", """
SELECT 'unique' AS "check", 'lineitem' AS table_name, 'l_orderkey,l_linenumber' AS column_name,
       (SELECT COUNT(*) FROM (SELECT 1 FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
                              GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)) AS failures
UNION ALL
SELECT 'unique', 'orders', 'o_orderkey',
       (SELECT COUNT(*) FROM (SELECT 1 FROM orders WHERE o_orderkey IS NOT NULL
                              GROUP BY o_orderkey HAVING COUNT(*) > 1))
UNION ALL
SELECT 'not_null', 'order_lines', 'n_lines',
       (SELECT COUNT(*) FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem) l
          ON o.o_orderkey = l.l_orderkey WHERE l.l_orderkey IS NULL)
UNION ALL
SELECT 'not_null', 'customer', 'c_name', (SELECT COUNT(*) FROM customer WHERE c_name IS NULL)""")
def check_report_q(spark, d):
    """The checks are declared in a file and read from there."""
    T = Tables(spark, d)
    ol = T.orders.select("o_orderkey").join(order_lines(T).select("matchid", "n_lines"),
                                            F.col("o_orderkey") == F.col("matchid"), "left")
    path = scratch_path(spark, "checks")
    spark.createDataFrame([(json.dumps(DECLARED_CHECKS),)], "value string").coalesce(1).write.text(path)
    return check_report(read_checks(spark, path, {"lineitem": T.lineitem, "orders": T.orders, "order_lines": ol, "customer": T.customer}))
