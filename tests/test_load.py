import os

from pyspark.sql import functions as F

from matchlake.plans.load import load_documents, read_star
from matchlake.plans.star import TABLES
from matchlake.session import scratch_path
from matchlake.sources import error_log, explode_envelope, map_to_rows, maps_callouts, read_documents
from matchlake.schemas import ENVELOPE, MAPS

from conftest import FIXTURES, M1, M2, M3, rows


def _counts(spark, wh):
    return {k: v.count() for k, v in read_star(spark, wh).items()}


def test_load_twice_equals_once(spark, docs):
    wh = scratch_path(spark, "wh")
    assert load_documents(spark, docs, wh) is not None
    once = _counts(spark, wh)
    assert load_documents(spark, docs, wh) is None          # nothing new
    assert _counts(spark, wh) == once
    assert once["metadata"] == 3 and once["kills"] == 8


def test_crash_before_metadata_then_rerun(spark, docs):
    """A run that wrote child tables but died before metadata is repaired by the re-run."""
    wh = scratch_path(spark, "wh")
    partial = [t for t in TABLES if t != "metadata"][:7]
    load_documents(spark, docs, wh, tables=partial)
    load_documents(spark, docs, wh)
    counts = _counts(spark, wh)
    assert counts["player"] == 9 and counts["metadata"] == 3


def test_only_new_and_ignore(spark, docs):
    wh = scratch_path(spark, "wh")
    load_documents(spark, docs.filter(F.col("metadata.matchid") == M1), wh)
    load_documents(spark, docs, wh, ignore=[M3])
    assert rows(read_star(spark, wh)["metadata"], "matchid") == [(M1,), (M2,)]


def test_envelope_dedupe_and_error_log(spark):
    env = read_documents(spark, os.path.join(FIXTURES, "landing"), ENVELOPE)
    matches = explode_envelope(env.filter(F.col("status") == 200)).select("match.*")
    wh = scratch_path(spark, "wh")
    load_documents(spark, matches, wh)                        # m1 arrives twice, stored once
    assert rows(read_star(spark, wh)["metadata"], "matchid") == [(M1,), (M2,)]
    errors = error_log(env, "2024-05-01T09:30:00")
    assert rows(errors, "name", "tag", "endpoint", "status") == [("ghost", "t9", "matches", 404)]
    import hashlib
    assert errors.first().id == hashlib.md5(b"2024-05-01T09:30:00ghostt9").hexdigest()


def test_roster_map_to_rows(spark):
    raw = spark.read.text(os.path.join(FIXTURES, "users.json"), wholetext=True)
    assert rows(map_to_rows(raw, "value", key="name", value="tag")) == [
        ("alpha", "t1"), ("bravo", "t2"), ("ghost", "t9")]


def test_maps_callouts(spark):
    maps = spark.read.schema(MAPS).option("multiLine", True).json(os.path.join(FIXTURES, "maps.json"))
    out = maps_callouts(maps)
    assert rows(out) == sorted([("map-1", "Harbor", "Mid", "A", 1.3, -2.4),
                                ("map-1", "Harbor", "Top", "B", 10.0, 4.0)], key=repr)


def test_ids_from_landed_files(spark):
    from matchlake.sources import list_stored_ids
    ids = list_stored_ids(spark, os.path.join(FIXTURES, "matches"))
    assert rows(ids) == [(M1,), (M2,), (M3,)]


def test_bucketed_catalog_load_and_colocated_join(spark, docs):
    import uuid as _uuid
    db = f"star_{_uuid.uuid4().hex[:8]}"
    wh = scratch_path(spark, "wh")
    load_documents(spark, docs, wh, database=db, buckets=8)
    assert load_documents(spark, docs, wh, database=db, buckets=8) is None      # nothing new
    star = read_star(spark, wh, database=db)
    assert {k: v.count() for k, v in star.items()}["player"] == 9
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = star["player"].join(star["player_stats"], ["matchid", "puuid"]).join(
            star["player_economy"], ["matchid", "puuid"])
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert j.count() == 9 and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_ids_from_document_paths(docs):
    from matchlake.sources import ids_from_paths
    assert rows(ids_from_paths(docs)) == [(M1,), (M2,), (M3,)]


def _doc(mid, kills=1, extra=""):
    return ('{"metadata": {"matchid": "%s"}, "kills": [%s]%s}' % (
        mid, ", ".join('{"round": 0, "killer_puuid": "k%d", "victim_puuid": "v"}' % i for i in range(kills)), extra))


def _land(spark, folder, *lines):
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("append").text(folder)


def test_copies_in_one_file_are_loaded_once(spark):
    land, wh = scratch_path(spark, "land"), scratch_path(spark, "wh")
    _land(spark, land, _doc("m1"), _doc("m1"), _doc("m2"), _doc("m1", kills=3))
    load_documents(spark, read_documents(spark, land, with_path=True), wh)
    star = read_star(spark, wh)
    assert rows(star["metadata"], "matchid") == [("m1",), ("m2",)]
    assert star["kills"].count() in (2, 4)                    # of m1 one whole document, whichever is first


def test_crash_then_new_file(spark):
    """A dead run's rows are never seen, also when the next run loads another set of documents."""
    land, wh = scratch_path(spark, "land"), scratch_path(spark, "wh")
    _land(spark, land, _doc("m1", kills=2))
    load_documents(spark, read_documents(spark, land, with_path=True), wh, tables=[t for t in TABLES if t != "metadata"])
    assert _counts(spark, wh).get("kills") == 0
    _land(spark, land, _doc("m2"))
    load_documents(spark, read_documents(spark, land, with_path=True), wh)
    counts = _counts(spark, wh)
    assert (counts["metadata"], counts["kills"]) == (2, 3)


def test_malformed_documents_are_rejected(spark):
    from matchlake.plans.load import read_rejects
    land, wh = scratch_path(spark, "land"), scratch_path(spark, "wh")
    _land(spark, land, _doc("m1"), _doc("m2")[:-3], '{"kills": []}')
    for _ in range(2):
        load_documents(spark, read_documents(spark, land, with_path=True), wh)
    assert _counts(spark, wh)["metadata"] == 1
    rejects = read_rejects(spark, wh)
    assert {r["reason"] for r in rejects.collect()} == {"malformed", "no matchid"}
    assert {r["raw"] for r in rejects.collect()} == {_doc("m2")[:-3], None}


def test_json_lines_read_as_whole_files_are_rejected(spark):
    land = scratch_path(spark, "land")
    _land(spark, land, _doc("m1"), _doc("m2"))
    got = read_documents(spark, land, multi_line=True).collect()
    assert [r["metadata"] for r in got] == [None] and got[0]["_corrupt_record"].count("matchid") == 2


def test_later_batches_may_have_more_columns(spark):
    from matchlake.schemas import MATCH
    land, wh = scratch_path(spark, "land"), scratch_path(spark, "wh")
    _land(spark, f"{land}/1", _doc("m1"))
    load_documents(spark, read_documents(spark, f"{land}/1"), wh)
    wider = MATCH.replace("metadata struct<", "metadata struct<season: string, ")
    _land(spark, f"{land}/2", _doc("m2").replace('"matchid"', '"season": "s1", "matchid"'))
    load_documents(spark, read_documents(spark, f"{land}/2", wider), wh)
    assert rows(read_star(spark, wh)["metadata"], "matchid", "season") == sorted([("m1", None), ("m2", "s1")], key=repr)


def test_unknown_fields_are_counted(spark):
    from matchlake.sources import unknown_fields
    land = scratch_path(spark, "land")
    _land(spark, land, _doc("m1", extra=', "odd": 1'), _doc("m2"))
    assert rows(unknown_fields(spark, land)) == [("odd", 1)]


def test_order_with_very_many_lines(spark):
    """130 lines more in one order: its match is still one, and its rounds are numbered on."""
    from matchlake.plans.documents import match_docs
    from matchlake.plans.registry import Tables
    T = Tables(spark, "/root/testdata/sf0.001")
    lines = T.lineitem
    one = lines.select("l_orderkey").first()[0]
    more = lines.filter(F.col("l_orderkey") == one).limit(1).drop("l_linenumber").crossJoin(
        spark.range(1, 131).selectExpr("id AS l_linenumber")).select(*lines.columns)
    T._cache["lineitem"] = lines.unionByName(more.withColumn("l_linenumber", F.col("l_linenumber").cast(lines.schema["l_linenumber"].dataType)))
    n = lines.filter(F.col("l_orderkey") == one).count() + 130
    wh = scratch_path(spark, "wh")
    load_documents(spark, match_docs(T), wh)
    star = read_star(spark, wh)
    assert star["metadata"].count() == T.orders.count() == star["teams"].count()
    assert star["round"].select("round_id").distinct().count() == star["round"].count() == T.lineitem.count()
    mid = star["round"].groupBy("matchid").count().orderBy(F.desc("count")).first()
    assert mid["count"] == n
    assert [r["round"] for r in star["round"].filter(F.col("matchid") == mid["matchid"]).orderBy("round").collect()] == list(range(n))
    assert star["player"].groupBy("matchid", "puuid").count().filter("count > 1").count() == 0


def test_bucketed_star_join_has_no_exchange(spark):
    from matchlake.plans import QUERIES
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["star_join_bucketed"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 4 and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_ids_from_folders_of_the_listing(spark):
    from matchlake.sources import list_stored_ids
    land = scratch_path(spark, "land")
    spark.createDataFrame([("m1", 1), ("m 2", 2), ("m1", 3)], "matchid string, x int").repartition(2).write.partitionBy("matchid").json(f"{land}/a")
    spark.createDataFrame([("m3", 1)], "matchid string, x int").write.partitionBy("matchid").json(f"{land}/b")
    ids = list_stored_ids(spark, [f"{land}/a", f"{land}/b"], by_folder=True)
    assert rows(ids) == [("m 2",), ("m1",), ("m3",)]
    assert "content" not in ids._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_places_go_on_from_deal_to_deal(spark):
    """Parents that lie in several deals, a null one too: places without a second shuffle of the rows."""
    from matchlake.plans.documents import placed
    data = [(p, i) for p, n in (("a", 3), ("hot", 4000), (None, 700), ("z", 1)) for i in range(n)]
    df = spark.createDataFrame(data, "p string, i int").repartition(4)
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    try:
        out = placed(df, ["p"], ["i"], "places")
        assert "hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
        assert sorted((str(r["p"]), r["i"], r["place"]) for r in out.collect()) == sorted((str(p), i, i) for p, i in data)
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_first_load_moves_no_documents_and_leaves_no_stage(spark):
    import glob

    from matchlake.plans.load import select_new
    from matchlake.session import checkpoint_root
    from matchlake.sources import read_documents
    land, wh = scratch_path(spark, "land"), scratch_path(spark, "wh")
    _land(spark, land, _doc("m1"), _doc("m2"))
    docs = read_documents(spark, land, with_path=True)
    assert "Join" not in select_new(spark, docs, wh)._jdf.queryExecution().optimizedPlan().toString()
    stages = f"{checkpoint_root(spark).removeprefix('file:')}/matchlake/stage-*"
    before = set(glob.glob(stages))
    load_documents(spark, docs, wh)
    assert set(glob.glob(stages)) <= before and read_star(spark, wh)["metadata"].count() == 2


def test_landing_by_id_is_dealt_to_several_tasks(spark):
    import glob

    from matchlake.sources import land_json, list_stored_ids
    land = scratch_path(spark, "land")
    land_json(spark.range(40).selectExpr("CAST(id AS STRING) AS matchid", "id AS x").coalesce(1), land, ["matchid"])
    files = glob.glob(f"{land.removeprefix('file:')}/matchid=*/part-*.json")
    assert len(files) == 40 and len({os.path.basename(f).split("-")[1] for f in files}) > 1
    assert list_stored_ids(spark, land, by_folder=True).count() == 40


def _shop(spark, n_orders=40, per_order=5):
    """Tables of own rows: orders, their lines (the last order has none, a line has no order), suppliers."""
    from matchlake.plans.registry import Tables
    T = Tables(spark, "/nowhere")
    T._cache["orders"] = spark.range(1, n_orders + 1).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "'F' AS o_orderstatus", "1.0D AS o_totalprice",
        "timestamp_ntz'1995-01-01 00:00:00' AS o_orderdate", "concat('p', id % 3) AS o_orderpriority")
    T._cache["lineitem"] = spark.range((n_orders - 1) * per_order + 1).selectExpr(
        f"CASE WHEN id = {(n_orders - 1) * per_order} THEN 999999 ELSE id DIV {per_order} + 1 END AS l_orderkey", "id * 3 % 50 AS l_partkey",
        "id % 4 AS l_suppkey", f"CAST(id % {per_order} + 1 AS INT) AS l_linenumber", "CAST(id % 30 AS DOUBLE) AS l_quantity",
        "0.1D AS l_discount", "0.2D AS l_tax", "substring('RAN', CAST(id % 3 + 1 AS INT), 1) AS l_returnflag",
        "substring('FO', CAST(id % 2 + 1 AS INT), 1) AS l_linestatus", "timestamp_ntz'1995-01-01 00:00:00' AS l_shipdate")
    T._cache["supplier"] = spark.range(4).selectExpr("id AS s_suppkey", "concat('S', id) AS s_name", "CAST(id AS INT) AS s_nationkey")
    return T


def test_documents_in_slices_load_as_one_batch(spark, monkeypatch):
    from matchlake.plans import documents
    T = _shop(spark)
    whole, sliced = scratch_path(spark, "wh"), scratch_path(spark, "wh")
    load_documents(spark, documents.match_docs(T), whole)
    monkeypatch.setattr(documents, "SLICE", 30)
    frames = list(documents.match_doc_slices(T))
    assert len(frames) > 3
    assert load_documents(spark, frames, sliced) is not None and load_documents(spark, frames, sliced) is None
    one, several = read_star(spark, whole), read_star(spark, sliced)
    for name in TABLES:
        assert rows(one[name]) == rows(several[name]), name
    assert one["metadata"].count() == 40 and len(os.listdir(f"{sliced.removeprefix('file:')}/metadata")) >= 1


def test_match_in_two_frames_is_loaded_once(spark):
    land, wh = scratch_path(spark, "land"), scratch_path(spark, "wh")
    _land(spark, f"{land}/1", _doc("m1", kills=2), _doc("m2"))
    _land(spark, f"{land}/2", _doc("m1", kills=3), _doc("m3"), '{"kills": []}')
    load_documents(spark, [read_documents(spark, f"{land}/{n}") for n in (1, 2)], wh)
    counts = _counts(spark, wh)
    assert (counts["metadata"], counts["kills"]) == (3, 4)


def _shuffle_files(spark):
    import glob
    import time
    time.sleep(1)       # Spark deletes them beside the work
    dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}


def test_stored_tables_leave_no_shuffle_files(spark):
    from matchlake.session import FREE_SHUFFLES, materialize, stored
    before, was = _shuffle_files(spark), spark.conf.get(FREE_SHUFFLES, None)
    df = spark.range(1000).repartition(4, "id")
    assert len(materialize(df, "kept", df).collect()) == 2000
    with stored(df, "passing") as held:
        path = held.inputFiles()[0].removeprefix("file:").removeprefix("//")
        assert len(held.collect()) == 1000 and os.path.exists(path)
    assert not os.path.exists(path)
    assert _shuffle_files(spark) <= before and spark.conf.get(FREE_SHUFFLES, None) == was


def test_bucketed_load_writes_a_file_for_each_bucket(spark):
    import glob
    import uuid as _uuid
    from matchlake.plans.documents import match_docs
    wh = scratch_path(spark, "wh")
    load_documents(spark, match_docs(_shop(spark)).repartition(6), wh, tables=("player", "metadata"), database=f"star_{_uuid.uuid4().hex[:8]}", buckets=3)
    assert len(glob.glob(f"{wh.removeprefix('file:')}/player/*/part-*")) == 3
