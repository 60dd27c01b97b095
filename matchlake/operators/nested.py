"""Nested-document operators: struct flattening and child-array explodes.

The document model is one row per document with ``StructType`` records
and ``ArrayType(StructType)`` child lists.  Every operator here is a
narrow ``select`` -- no shuffle -- so a whole load of documents flattens
in one pass per output table, in parallel across files.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def q(name: str) -> str:
    """Back-tick a column name for use in ``F.col``."""
    return "`" + name.replace("`", "``") + "`"


def _leaves(col: Column, st: StructType, name: str, sep: str, drop: set[str], path: str):
    for f in st.fields:
        full = f"{path}.{f.name}" if path else f.name
        if full in drop:
            continue
        out = f"{name}{sep}{f.name}" if name else f.name
        child = col.getField(f.name)
        if isinstance(f.dataType, StructType):
            yield from _leaves(child, f.dataType, out, sep, drop, full)
        else:
            yield child.alias(out)


def flatten_struct(df: DataFrame, cols: Iterable[str] | None = None, sep: str = "_",
                   prefix: bool = True, drop: Iterable[str] = ()) -> DataFrame:
    """Replace struct columns by one column per leaf field, recursively.

    ``{a: {b: 1, c: {d: 2}}}`` becomes ``a_b``, ``a_c_d`` (``b``, ``c_d``
    with ``prefix=False``).  Arrays are leaves and stay array columns,
    like a JSON normaliser.  ``drop`` removes nested fields first, named
    by dotted path from the column (``"a.c"``); unknown paths are ignored.
    A NULL struct gives NULL leaves.  Raises on duplicate output names.
    """
    wanted = None if cols is None else set(cols)
    dropped = set(drop)
    out: list[Column] = []
    for f in df.schema.fields:
        if isinstance(f.dataType, StructType) and (wanted is None or f.name in wanted):
            if f.name in dropped:
                continue
            inner = {d[len(f.name) + 1:] for d in dropped if d.startswith(f.name + ".")}
            out.extend(_leaves(F.col(q(f.name)), f.dataType, f.name if prefix else "", sep, inner, ""))
        elif f.name not in dropped:
            out.append(F.col(q(f.name)))
    result = df.select(*out)
    dupes = {c for c in result.columns if result.columns.count(c) > 1}
    if dupes:
        raise ValueError(f"flatten_struct: duplicate column names {sorted(dupes)}")
    return result


def flatten_shallow(df: DataFrame, col: str, keep: Iterable[str] = ()) -> DataFrame:
    """One level only: ``keep`` columns plus ``col.*``; nested fields stay structs."""
    return df.select(*[F.col(q(k)) for k in keep], F.col(q(col) + ".*"))


def _keep_cols(keep) -> list[Column]:
    """Parent columns to carry; strings are column paths (``"s.player_puuid"``)."""
    if isinstance(keep, Mapping):
        return [(F.col(src) if isinstance(src, str) else src).alias(dst) for dst, src in keep.items()]
    return [F.col(k) if isinstance(k, str) else k for k in keep]


def explode_child(df: DataFrame, array_col: str | Column, keep=(), alias: str = "child",
                  expand: bool = False) -> DataFrame:
    """One row per element of a child array, with parent columns carried.

    ``keep`` is a list of columns or a ``{new_name: column}`` mapping (to
    rename a parent key, e.g. ``damager_puuid <- player_puuid``).  NULL and
    empty arrays give no rows.  ``expand`` spreads a struct element into
    columns.
    """
    arr = F.col(array_col) if isinstance(array_col, str) else array_col
    out = df.select(*_keep_cols(keep), F.explode(arr).alias(alias))
    if expand:
        out = out.select(*[c for c in out.columns if c != alias], F.col(q(alias) + ".*"))
    return out


def explode_positional(df: DataFrame, array_col: str | Column, pos_name: str = "pos", keep=(),
                       alias: str = "child", expand: bool = False) -> DataFrame:
    """Like :func:`explode_child` plus the 0-based array position."""
    arr = F.col(array_col) if isinstance(array_col, str) else array_col
    out = df.select(*_keep_cols(keep), F.posexplode(arr).alias(pos_name, alias))
    if expand:
        out = out.select(*[c for c in out.columns if c != alias], F.col(q(alias) + ".*"))
    return out


def vertical_split(df: DataFrame, parts: Mapping[str, str | None], keys: Iterable[str],
                   sep: str = "_") -> dict[str, DataFrame]:
    """Split one record into 1:1 sibling tables sharing ``keys``.

    ``parts`` maps table name -> struct column to flatten into it (without
    prefix); ``None`` means "every column that is not a listed part".
    """
    keys = list(keys)
    structs = {c for c in parts.values() if c}
    out = {}
    for name, col in parts.items():
        if col is None:
            rest = df.select(*[F.col(q(c)) for c in df.columns if c not in structs])
            out[name] = flatten_struct(rest, sep=sep)
        else:
            sub = df.select(*[F.col(q(k)) for k in keys], F.col(q(col)))
            out[name] = flatten_struct(sub, [col], sep=sep, prefix=False)
    return out
