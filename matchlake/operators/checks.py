"""Data-quality checks returning failing rows or one summary row per check.

A check never collects data to the driver; each is an aggregate or a
filter, and :func:`check_report` unions their one-row summaries.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .nested import q


def check_unique(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Key values occurring more than once (rows with a NULL key part are
    skipped, as a uniqueness test does).  Columns: the key columns + ``n``."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    nonnull = reduce(lambda a, b: a & b, [F.col(q(c)).isNotNull() for c in cols])
    return (df.filter(nonnull).groupBy(*[q(c) for c in cols]).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1))


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """The rows whose ``col`` is NULL."""
    return df.filter(F.col(q(col)).isNull())


@dataclass(frozen=True)
class Check:
    kind: str            # "unique" | "not_null"
    table: str
    column: str | tuple[str, ...]
    df: DataFrame

    def failures(self) -> DataFrame:
        cols = (self.column,) if isinstance(self.column, str) else tuple(self.column)
        if self.kind == "unique":
            failing = check_unique(self.df, cols)
        elif self.kind == "not_null":
            failing = check_not_null(self.df.select(q(cols[0])), cols[0])
        else:
            raise ValueError(f"unknown check kind {self.kind!r}")
        return failing.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(self.kind).alias("check"), F.lit(self.table).alias("table_name"),
            F.lit(",".join(cols)).alias("column_name"), F.col("failures"))


def read_checks(spark: SparkSession, path: str, tables: Mapping[str, DataFrame]) -> list[Check]:
    """The checks that a JSON file declares, ``{table: {column: [kind, ...]}}``, in any store; the columns of a composite
    key are joined by commas.  ``tables`` are the frames by name; a table that is not there is an error."""
    declared = json.loads(spark.read.text(path, wholetext=True).first()[0])
    return [Check(kind, table, tuple(column.split(",")) if "," in column else column, tables[table])
            for table, columns in declared.items() for column, kinds in columns.items() for kind in kinds]


def _null_counts(table: str, checks: Sequence[Check]) -> DataFrame:
    """The not-null checks of one frame in one aggregate, a row for each column."""
    cols = [c.column if isinstance(c.column, str) else c.column[0] for c in checks]
    counts = checks[0].df.agg(*[F.count_if(F.col(q(c)).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit("not_null").alias("check"), F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                              F.col(f"n{i}").alias("failures")) for i, c in enumerate(cols)])
    return counts.select(F.inline(rows))


def check_report(checks: Sequence[Check]) -> DataFrame:
    """One row per check: ``check, table_name, column_name, failures``.

    ``failures`` counts duplicated key values for ``unique`` and NULL rows
    for ``not_null``; 0 means the check passes.  All not-null checks of one
    table take one scan.
    """
    parts, nulls = [], {}
    for c in checks:
        if c.kind == "not_null":
            nulls.setdefault((c.table, id(c.df)), []).append(c)
        else:
            parts.append(c.failures())
    parts += [_null_counts(table, group) for (table, _), group in nulls.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
