from matchlake.operators import Check, check_not_null, check_report, check_unique

from conftest import rows


def test_starter_model_checks(spark):
    """The starter model emits ids 1 and NULL: unique passes, not_null fails once;
    the model filtered on id = 1 passes both."""
    first = spark.sql("SELECT 1 AS id UNION ALL SELECT CAST(NULL AS INT) AS id")
    second = first.filter("id = 1")
    report = check_report([Check("unique", "first", "id", first), Check("not_null", "first", "id", first),
                           Check("unique", "second", "id", second), Check("not_null", "second", "id", second)])
    assert rows(report, "table_name", "check", "failures") == [
        ("first", "not_null", 1), ("first", "unique", 0), ("second", "not_null", 0), ("second", "unique", 0)]


def test_check_unique_and_not_null_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c"), (None, "d")], "k int, v string")
    assert rows(check_unique(df, "k")) == [(1, 2)]
    assert rows(check_not_null(df, "v")) == [(2, None)]


def test_checks_from_a_file(spark):
    import json

    from matchlake.operators import check_report, read_checks
    from matchlake.session import scratch_path
    path = scratch_path(spark, "checks")
    declared = {"a": {"k": ["unique", "not_null"], "k,x": ["unique"]}, "b": {"y": ["not_null"]}}
    spark.createDataFrame([(json.dumps(declared, indent=1),)], "value string").coalesce(1).write.text(path)
    a = spark.createDataFrame([(1, 1), (1, 2), (None, 3), (None, 3)], "k int, x int")
    b = spark.createDataFrame([(None,), (None,), (2,)], "y int")
    got = {(r["check"], r["table_name"], r["column_name"]): r["failures"] for r in check_report(read_checks(spark, path, {"a": a, "b": b})).collect()}
    assert got == {("unique", "a", "k"): 1, ("not_null", "a", "k"): 2, ("unique", "a", "k,x"): 0, ("not_null", "b", "y"): 2}
    import pytest
    with pytest.raises(KeyError):
        read_checks(spark, path, {"a": a})
