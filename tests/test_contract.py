from matchlake.operators import cast_first_n, check_castable, enforce

from conftest import rows

CONTRACT = {"int": ["level", "missing_int"], "float": ["rate"], "bool": ["won"], "other": ["name"]}


def test_enforce_try_cast_tokens_and_missing(spark):
    df = spark.createDataFrame([("7", "1.5", "true", "nan"), ("x", "abc", None, "bob"), ("1.5", "nan", "no", None)],
                               "level string, rate string, won string, name string")
    out = enforce(df, CONTRACT)
    assert out.dtypes == [("level", "bigint"), ("rate", "double"), ("won", "boolean"), ("name", "string"),
                          ("missing_int", "bigint")]
    assert rows(out) == sorted([(7, 1.5, True, None, None), (None, None, None, "bob", None),
                                (None, None, False, None, None)], key=repr)


def test_enforce_numeric_sources(spark):
    df = spark.createDataFrame([(1.9, float("nan"), 1.0)], "level double, rate double, won double")
    out = enforce(df, CONTRACT).first()
    assert (out.level, out.rate, out.won) == (1, None, True)


def test_check_castable_counts_rejected(spark):
    df = spark.createDataFrame([("7", "1.5", "true", "a"), ("x", "abc", None, "b"), ("nan", None, "maybe", None)],
                               "level string, rate string, won string, name string")
    got = {r.column: r.rejected for r in check_castable(df, CONTRACT).collect()}
    assert got == {"level": 1, "rate": 1, "won": 1, "name": 0}


def test_cast_first_n(spark):
    df = spark.createDataFrame([(1.0, 2.7, 3.2, 4.9, 5.5)], "a double, b double, c double, d double, e double")
    assert cast_first_n(df, 4).first() == (1, 2, 3, 4, 5.5)


def test_warehouse_schema_maps_or_raises(spark, star):
    import pytest as _pytest
    from matchlake.operators import warehouse_schema
    got = warehouse_schema(star["teams"])
    assert got[0] == {"name": "red_has_won", "type": "BOOLEAN"} and got[1]["type"] == "INTEGER"
    with _pytest.raises(TypeError):
        warehouse_schema(star["round"].select("round_id").selectExpr("array(round_id) AS a"))
