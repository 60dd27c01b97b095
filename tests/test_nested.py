import pytest
from pyspark.sql import functions as F

from matchlake.operators import (explode_child, explode_positional, flatten_shallow, flatten_struct,
                                 vertical_split)

from conftest import rows


@pytest.fixture(scope="module")
def nested(spark):
    return spark.createDataFrame(
        [(1, {"a": 1, "c": {"d": 2, "e": "x"}}, [{"k": 1}, {"k": 2}]),
         (2, None, []),
         (3, {"a": None, "c": None}, None)],
        "id int, s struct<a: int, c: struct<d: int, e: string>>, arr array<struct<k: int>>")


def test_flatten_struct_prefix_and_sep(nested):
    out = flatten_struct(nested, ["s"])
    assert out.columns == ["id", "s_a", "s_c_d", "s_c_e", "arr"]
    assert rows(out, "id", "s_a", "s_c_d") == [(1, 1, 2), (2, None, None), (3, None, None)]
    dotted = flatten_struct(nested, ["s"], sep=".", prefix=False)
    assert dotted.columns == ["id", "a", "c.d", "c.e", "arr"]


def test_flatten_struct_drop_nested_field(nested):
    out = flatten_struct(nested, ["s"], drop=["s.c.e", "s.missing"])
    assert out.columns == ["id", "s_a", "s_c_d", "arr"]


def test_flatten_struct_duplicate_names_raise(spark):
    df = spark.createDataFrame([(1, {"b": 2})], "a_b int, a struct<b: int>")
    with pytest.raises(ValueError):
        flatten_struct(df)


def test_explode_child_skips_null_and_empty(nested):
    out = explode_child(nested, "arr", keep=["id"], alias="x", expand=True)
    assert rows(out) == [(1, 1), (1, 2)]


def test_explode_child_renames_parent_key(nested):
    out = explode_child(nested, "arr", keep={"parent_id": "id", "a": "s.a"}, alias="x")
    assert out.columns == ["parent_id", "a", "x"]


def test_explode_positional_is_zero_based(nested):
    out = explode_positional(nested, "arr", pos_name="round", keep=["id"], alias="x")
    assert rows(out.select("id", "round", "x.k")) == [(1, 0, 1), (1, 1, 2)]


def test_flatten_shallow_keeps_nested(nested):
    out = flatten_shallow(nested, "s", keep=["id"])
    assert out.columns == ["id", "a", "c"]
    assert dict(out.dtypes)["c"].startswith("struct")


def test_vertical_split(spark):
    df = spark.createDataFrame([(1, "p", {"x": 1}, {"y": {"z": 2}})],
                               "id int, name string, a struct<x: int>, b struct<y: struct<z: int>>")
    parts = vertical_split(df, {"base": None, "part_a": "a", "part_b": "b"}, keys=["id"])
    assert parts["base"].columns == ["id", "name"]
    assert parts["part_a"].columns == ["id", "x"]
    assert parts["part_b"].columns == ["id", "y_z"]


def test_explode_is_narrow(nested):
    """Flattening adds no shuffle."""
    out = explode_child(nested, "arr", keep=["id"], alias="x", expand=True)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert F is not None
