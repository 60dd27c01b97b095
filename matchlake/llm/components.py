"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is a minimum per vertex (partially aggregated, stored) joined back to
the edges, so a vertex with very many neighbours is spread by the skew join and
nothing is gathered in one task or the driver.  Every round is written to the
shared checkpoint folder, so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u > v); the result again has u > v, each edge once."""
    both = edges.select("u", "v")
    if large:
        both = both.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = store(both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m")), "least")
    out = both.join(least, "u")
    if large:
        out = out.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = out.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
    return out.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) for every vertex of ``edges`` (u, v): root is the smallest vertex of its component.

    Loops and repeated or reversed edges do no harm; no edges give no rows.
    """
    now = store(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "edges")
    while True:
        after = store(_star(_star(now, True), False), "star")
        # a fixed point: the same edges, which then are stars
        sums = [x.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("decimal(20,0)"))).first() for x in (now, after)]
        now = after
        if sums[0] == sums[1]:
            break
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("root")) \
        .unionByName(now.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct())
