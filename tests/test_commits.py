"""Commit logs, loads that meet or die, replaced tables, open fields, keep-first streams."""

import json
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from matchlake.plans import load
from matchlake.plans.load import BATCH_COL, LoadConflict, commit_log, committed, load_documents, loaded_ids, read_rejects, read_star
from matchlake.schemas import LOAD_COMMIT
from matchlake.session import scratch_path
from matchlake.sources import commits
from matchlake.sources import CommitLog, drop_old_contents, field_drift, read_documents, read_replaced, replace
from matchlake.streaming import file_stream, keep_first, read_kept

from conftest import rows
from test_load import _doc, _land

SMALL = ("kills", "metadata")


def test_a_number_is_taken_once(spark):
    log = CommitLog(spark, scratch_path(spark, "log"), "version bigint, batch string")
    assert log.latest() == 0 and log.frame().count() == 0
    assert log.put(1, batch="a") and not log.put(1, batch="b") and log.put(2, batch="c")
    assert log.latest() == 2 and rows(log.frame()) == [(1, "a"), (2, "c")]


def test_a_file_without_its_line_is_no_commit(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path), "version bigint, batch string")
    log.put(1, batch="a")
    (tmp_path / "000000000000" / "00000000000000000002.json").write_text("")
    (tmp_path / "000000000000" / "00000000000000000003.json").write_text('{"version": 3, "bat')
    assert rows(log.frame()) == [(1, "a")] and log.latest() == 3 and log.put(4, batch="d")


def test_full_folders_are_sealed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "FOLDER", 10)
    log = CommitLog(spark, str(tmp_path), "version bigint, batch string")
    for n in range(1, 36):
        assert log.put(n, batch=f"b{n}")
        if n == 13:     # a writer that has its number, and not its line yet
            (tmp_path / "000000000001" / "00000000000000000013.json").write_text("")
    assert not log.put(35, batch="again") and log.latest() == 35
    assert sorted(p.name for p in (tmp_path / "sealed").glob("0*.json")) == ["000000000000.json", "000000000002.json"]
    want = sorted([(n, f"b{n}") for n in range(1, 36) if n != 13], key=repr)
    assert rows(log.frame()) == want
    for p in (tmp_path / "000000000000").glob("*.json"):
        p.write_text("")        # sealed commits are not read from their files any more
    (tmp_path / "sealed-000000000001-of-a-dead-writer").mkdir()
    assert rows(log.frame()) == want


def test_ten_thousand_batches_are_no_list(spark, tmp_path):
    wh = str(tmp_path / "wh")
    load_documents(spark, read_documents(spark, _landed(spark, _doc("m1")), with_path=True), wh, tables=SMALL)
    folder = tmp_path / "wh" / "commits" / "000000000000"
    table = [{"name": "metadata", "columns": spark.range(0).schema.json()}]
    lines = [json.dumps({"version": n, "batch": f"b{n}", "tables": table}) for n in range(2, 10_001)]
    (folder / f"{10_000:020d}.json").write_text("\n".join(lines) + "\n")
    star = read_star(spark, wh)
    for df in (star["kills"], loaded_ids(spark, wh)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert len(plan) < 20_000 and "b9999" not in plan and "LeftSemi" in plan
    assert committed(spark, wh).count() == 10_000 and star["kills"].count() == 1


def _landed(spark, *lines):
    land = scratch_path(spark, "land")
    _land(spark, land, *lines)
    return land


def test_run_that_dies_between_two_files_of_metadata(spark, tmp_path):
    wh = str(tmp_path / "wh")
    docs = read_documents(spark, _landed(spark, _doc("m1"), _doc("m2")), with_path=True)
    spark.createDataFrame([("m1", "dead")], f"matchid string, {BATCH_COL} string").write.partitionBy(BATCH_COL).parquet(f"{wh}/metadata")
    assert load_documents(spark, docs, wh, tables=SMALL)
    assert rows(read_star(spark, wh)["metadata"], "matchid") == [("m1",), ("m2",)]


def _meeting(monkeypatch, then):
    """Lets ``then`` run once while another load has chosen its documents and has not committed."""
    plain, todo = load.build_star, [then]

    def build(*args, **more):
        if todo and args[0].columns:
            todo.pop()()
        return plain(*args, **more)
    monkeypatch.setattr(load, "build_star", build)


@pytest.mark.parametrize("attempts", [1, 3])
def test_two_loads_of_the_same_match(spark, monkeypatch, attempts):
    wh = scratch_path(spark, "wh")
    both = read_documents(spark, _landed(spark, _doc("m1"), _doc("m2")), with_path=True)
    one = read_documents(spark, _landed(spark, _doc("m1", kills=3)), with_path=True)
    _meeting(monkeypatch, lambda: load_documents(spark, one, wh, tables=SMALL))
    if attempts == 1:
        with pytest.raises(LoadConflict):
            load_documents(spark, both, wh, tables=SMALL, attempts=1)
        assert rows(read_star(spark, wh)["metadata"], "matchid") == [("m1",)]
        return
    load_documents(spark, both, wh, tables=SMALL)
    star = read_star(spark, wh)
    assert rows(star["metadata"], "matchid") == [("m1",), ("m2",)] and star["kills"].count() == 4


def test_two_loads_of_different_matches_both_commit(spark, monkeypatch):
    wh = scratch_path(spark, "wh")
    a, b = (read_documents(spark, _landed(spark, _doc(m)), with_path=True) for m in ("m1", "m2"))
    _meeting(monkeypatch, lambda: load_documents(spark, b, wh, tables=SMALL))
    load_documents(spark, a, wh, tables=SMALL, attempts=1)
    assert rows(read_star(spark, wh)["metadata"], "matchid") == [("m1",), ("m2",)] and commit_log(spark, wh).latest() == 2


def test_rejects_stay_the_same_when_nothing_new_landed(spark):
    wh = scratch_path(spark, "wh")
    land = _landed(spark, _doc("m1"), _doc("m2")[:-3], _doc("m2")[:-3], '{"kills": []}')
    for _ in range(3):
        load_documents(spark, read_documents(spark, land, with_path=True), wh, tables=SMALL)
    assert rows(read_rejects(spark, wh), "reason", "n_copies") == [("malformed", 2), ("no matchid", 1)]
    _land(spark, land, '{"kills": null}', "{")
    load_documents(spark, read_documents(spark, land, with_path=True), wh, tables=SMALL)
    assert read_rejects(spark, wh).count() == 4
    load_documents(spark, read_documents(spark, land), wh, tables=SMALL)         # without paths they are other rejects, once
    load_documents(spark, read_documents(spark, land), wh, tables=SMALL)
    assert read_rejects(spark, wh).count() == 8


def test_reads_open_no_footers_for_their_schema(spark):
    wh = scratch_path(spark, "wh")
    load_documents(spark, read_documents(spark, _landed(spark, _doc("m1")), with_path=True), wh, tables=SMALL)
    plan = loaded_ids(spark, wh)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<matchid:string>" in plan
    assert [f.name for f in spark.createDataFrame([], LOAD_COMMIT).schema] == ["version", "batch", "tables"]


# -- replaced tables -------------------------------------------------------

def test_replace_that_fails_leaves_the_old_content(spark):
    target = scratch_path(spark, "replaced")
    with pytest.raises(FileNotFoundError):
        read_replaced(spark, target)
    replace(spark.range(5).toDF("x"), target)
    before = read_replaced(spark, target)
    with pytest.raises(PySparkException):
        replace(spark.range(9).select(F.when(F.col("id") == 7, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).cast("bigint").alias("x")), target)
    assert rows(read_replaced(spark, target)) == [(i,) for i in range(5)]
    replace(spark.range(2).select(F.col("id").cast("string").alias("y"), F.lit(1).alias("z")), target)      # other columns
    assert rows(read_replaced(spark, target)) == [("0", 1), ("1", 1)]
    assert before.count() == 5                                                # who has begun to read goes on
    for n in range(3):
        replace(spark.range(n), target)
    assert drop_old_contents(spark, target) == 3 and drop_old_contents(spark, target) == 0
    assert read_replaced(spark, target).count() == 2


def test_replace_in_the_catalog(spark):
    name = f"replaced_{scratch_path(spark, 'x')[-8:]}"
    replace(spark.range(3).toDF("x"), name)
    with pytest.raises(PySparkException):
        replace(spark.range(3).select(F.raise_error(F.lit("stop")).cast("bigint").alias("x")), name)
    assert read_replaced(spark, name).count() == 3
    replace(spark.range(4).select(F.lit("a").alias("y")), name)
    assert rows(spark.table(name)) == [("a",)] * 4
    spark.sql(f"DROP VIEW {name}")


# -- open fields -----------------------------------------------------------

def _put(doc, path, value):
    """Set a field by its path, as ``read_documents`` names it."""
    steps = [json.loads(s)[0] if s.startswith("[") else s for s in re.findall(r'\[\d+\]|\["(?:[^"\\]|\\.)*"\]|[A-Za-z_]\w*', path)]
    for step in steps[:-1]:
        doc = doc[step]
    doc[steps[-1]] = value


def test_whole_documents_come_back(spark):
    docs = [{"metadata": {"matchid": "m1", "map": "M", "season": "s1", "mode": {"id": 7, "tags": ["x", None, 1.5]}},
             "players": {"all_players": [{"puuid": "p", "stats": {"score": 3, "aces": 1}, "rank": True}, {"puuid": "q"}], "coaches": []},
             "kills": [{"round": 0, "weapon": "w", "assistants": [{"assistant_puuid": "z", "odd key": None}]}, {"round": 1}],
             "rounds": [{"player_stats": [{"player_puuid": "p", "damage_events": [{"damage": 5, "bone": "head"}]}]}],
             "a\"b": "1", "observers": {"x": [{"y": 2}]}, "kept": 12345678901234567890},
            {"metadata": {"matchid": "m2"}}]
    land = _landed(spark, *[json.dumps(d) for d in docs])
    read = read_documents(spark, land, with_path=True, with_open=True)
    got = {r["metadata"]["matchid"]: r for r in read.collect()}
    assert got["m2"]["open_fields"] == {}
    known = json.loads(read.filter("metadata.matchid = 'm1'").select(F.to_json(F.struct("metadata", "players", "kills", "rounds"))).first()[0])
    for path, value in got["m1"]["open_fields"].items():
        _put(known, path, json.loads(value))
    assert known == docs[0]
    plain = read_documents(spark, land).filter("metadata.matchid = 'm1'").collect()[0].asDict(recursive=True)
    assert {k: v for k, v in got["m1"].asDict(recursive=True).items() if k in plain} == plain


def test_open_fields_of_bad_documents_and_of_the_star(spark):
    land = _landed(spark, _doc("m1", extra=', "odd": [1, {"b": 2}]'), _doc("m2")[:-2], "", "[1]", '{"metadata": {"matchid": "m3", "x": "y"}}')
    docs = read_documents(spark, land, with_path=True, with_open=True)
    assert docs.filter("_corrupt_record is not null").filter("open_fields is not null").count() == 0
    assert rows(field_drift(docs)) == [("metadata.x", 1, 1), ("odd", 1, 1)]
    wh = scratch_path(spark, "wh")
    load_documents(spark, docs, wh, tables=SMALL)
    load_documents(spark, docs, wh, tables=SMALL)
    star = read_star(spark, wh)
    assert rows(star["open_fields"]) == [("m1", 0, "odd", '[1,{"b":2}]'), ("m3", 0, "metadata.x", '"y"')]
    assert rows(field_drift(star["open_fields"])) == [("metadata.x", 1, 1), ("odd", 1, 1)]


# -- keep-first streams ----------------------------------------------------

def test_keep_first_over_all_time_and_replays(spark):
    base = scratch_path(spark, "keep")
    schema = "id bigint, at bigint, what string"
    landings = [[(1, 5, "b"), (1, 3, "a"), (None, 9, "n"), (2, None, "z"), (2, 1, "y")], [(1, 0, "late"), (3, 1, "c"), (None, 0, "m")], [(3, 0, "d")]]
    want = [(1, 3, "a"), (2, None, "z"), (3, 1, "c"), (None, 9, "n")]
    for n, some in enumerate(landings):
        spark.createDataFrame(some, schema).coalesce(1).write.parquet(f"{base}/in/b={n}")
        keep_first(file_stream(spark, f"{base}/in/*", schema), f"{base}/out", f"{base}/ck", ["id"], ["at"])
    assert rows(read_kept(spark, f"{base}/out", schema), "id", "at", "what") == sorted(want, key=repr)
    # a replayed first micro-batch overwrites itself
    import shutil
    shutil.copytree(f"{base}/in/b=0", f"{base}/in0/b=0")
    keep_first(file_stream(spark, f"{base}/in0/*", schema), f"{base}/out", f"{base}/ck2", ["id"], ["at"])
    assert rows(read_kept(spark, f"{base}/out", schema), "id", "at", "what") == sorted(want, key=repr)
    plan = read_kept(spark, f"{base}/nothing", schema)
    assert plan.count() == 0
