"""Relational building blocks used by the marts.

Conventions: ``order`` is a list of column names, optionally given as
``(name, "desc")``; ascending sorts NULLs first and descending sorts
NULLs last (Spark's default).  Ties are broken only by the columns you
list, so list enough of them to make the order total when the result
must be deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .nested import q

OrderItem = str | tuple[str, str]


def sort_cols(order: Sequence[OrderItem]) -> list[Column]:
    cols = []
    for item in order:
        name, direction = (item, "asc") if isinstance(item, str) else item
        c = F.col(q(name))
        cols.append(c.desc_nulls_last() if direction.lower() == "desc" else c.asc_nulls_first())
    return cols


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[OrderItem],
                    rank_col: str = "_rn") -> DataFrame:
    """The first row of each ``keys`` group under ``order`` (top-1).

    Written as ``row_number() = 1``: Catalyst plans a partial
    ``WindowGroupLimit`` before the shuffle, so each map task keeps one
    row per group and a hot group costs no more to shuffle than a cold
    one.  Output has the input columns.
    """
    w = Window.partitionBy(*[F.col(q(k)) for k in keys]).orderBy(*sort_cols(order))
    return (df.withColumn(rank_col, F.row_number().over(w))
              .filter(F.col(rank_col) == 1)
              .drop(rank_col))


def top1_rows(df: DataFrame, keys: Sequence[str], order: Sequence[OrderItem],
              flag: str | None = None) -> DataFrame:
    """Top-1 per group, optionally with a constant TRUE flag column."""
    out = first_per_group(df, keys, order)
    return out.withColumn(flag, F.lit(True)) if flag else out


def flag_first(df: DataFrame, keys: Sequence[str], order: Sequence[OrderItem],
               identity: Sequence[str], name: str) -> DataFrame:
    """Every row, plus ``name`` = TRUE on the first row of its group.

    Same result as ``row_number() OVER (PARTITION BY keys ORDER BY order)
    = 1`` as a column, planned without sending a whole group to one
    task: the top-1 rows are found with :func:`first_per_group`
    (map-side reduced) and joined back on ``keys + identity``.
    ``identity`` must identify a row within its group (e.g. a match id);
    the join is then on a near-unique key and cannot skew.  ``df`` is
    evaluated twice (top-1 side and row side): pass a stored table, or a
    narrow relation, when it is expensive -- the consolidated mart computes
    its latest-match flag on (puuid, matchid, game_start) for that reason.
    """
    keys, identity = list(keys), list(identity)
    on = list(dict.fromkeys(keys + identity))
    top = (first_per_group(df.select(*[q(c) for c in dict.fromkeys(on + [o if isinstance(o, str) else o[0] for o in order])]),
                           keys, order)
           .select(*[q(c) for c in on]).withColumn(name, F.lit(True)))
    joined = df.alias("_l").join(top.alias("_r"), [F.col(f"_l.{q(c)}").eqNullSafe(F.col(f"_r.{q(c)}")) for c in on], "left")
    return joined.select(*[F.col(f"_l.{q(c)}") for c in df.columns],
                         F.coalesce(F.col(f"_r.{q(name)}"), F.lit(False)).alias(name))


def count_distinct(*cols) -> Column:
    """``COUNT(DISTINCT a, b, ...)``: rows with any NULL part are not counted."""
    return F.count_distinct(*[F.col(q(c)) if isinstance(c, str) else c for c in cols])


def cond_count_distinct(cond: Column, *cols) -> Column:
    """``COUNT(DISTINCT CASE WHEN cond THEN key END)`` for one or more key parts.

    A NULL condition counts as false.  Several of these in one ``agg``
    share one Expand + two-phase aggregate, keyed first on the distinct
    values, so one big group is spread over many tasks.
    """
    return F.count_distinct(*[F.when(cond, F.col(q(c)) if isinstance(c, str) else c) for c in cols])


def full_group_flag(df: DataFrame, keys: Sequence[str], member: str, n: int, name: str) -> DataFrame:
    """Per group: TRUE when exactly ``n`` distinct non-NULL ``member`` values occur."""
    return df.groupBy(*[q(k) for k in keys]).agg((F.count_distinct(F.col(q(member))) == n).alias(name))


def roster_filter(df: DataFrame, col: str, roster) -> DataFrame:
    """Keep rows whose ``col`` is in the roster.

    A Python list becomes an ``IN`` list (pushed into the Parquet scan); a
    one-column DataFrame becomes a left-semi join, which AQE turns into a
    broadcast only when the roster's measured size is under the threshold.
    """
    if isinstance(roster, DataFrame):
        r = roster.select(F.col(roster.columns[0]).alias("_roster_key"))
        return df.join(r, F.col(q(col)) == F.col("_roster_key"), "left_semi")
    return df.filter(F.col(q(col)).isin(list(roster)))


def only_new(df: DataFrame, existing: DataFrame, key: str, existing_key: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not among ``existing`` keys (anti-join)."""
    ek = existing_key or key
    ex = existing.select(F.col(q(ek)).alias("_existing_key"))
    return df.join(ex, F.col(q(key)) == F.col("_existing_key"), "left_anti")


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[OrderItem]) -> DataFrame:
    """One row per key, the first under ``order`` (deterministic keep-first)."""
    return first_per_group(df, keys, order)


def star_except(df: DataFrame, *cols: str) -> DataFrame:
    """``t.* EXCEPT (cols)``; names that are absent are ignored."""
    return df.drop(*cols)


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Row append by column name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.union(b), dfs)


def is_true(c: Column) -> Column:
    """``c IS TRUE`` (never NULL)."""
    return c.eqNullSafe(F.lit(True))


def is_false(c: Column) -> Column:
    """``c IS FALSE`` (never NULL)."""
    return c.eqNullSafe(F.lit(False))
