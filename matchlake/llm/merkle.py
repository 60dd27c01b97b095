"""Merkle manifest of a dataset, with nested-interval labels.

Rows are the leaves of one tree per group (a partition of the dataset, such as
a language), in the order of their ids; every two consecutive nodes become one
until a group has one node left, its subroot.  The subroots, in the order of
their groups, are the leaves of the top tree and give the root.  H is the
lower-case hex SHA-256 of its inputs put together; a leaf is H of the row's
fields, each ``-`` if null, else the number of its UTF-8 bytes, a colon and the
value.

Labels: a node carries the interval of leaf ranks that it covers, [lo, hi).  A
node is an ancestor of a leaf if its interval contains the leaf's rank, and of
the two nodes in a parent's interval the one that is left when a node's own
interval is taken away is its sibling.  Both are joins on (group, level,
bucket), where the bucket is the place of the parent's interval on its level,
so a bucket has two nodes at most.

Trees grow in bands of ``BAND`` levels: one shuffle brings the 2^BAND nodes
under a band's node together, and a leaf is joined with the nodes of its own
band only; the path of a band's node goes on to all leaves below it.  So rows
grow with the number of leaves, not with leaves times levels, and no group
meets in one task: ranks come from a deal by range of (group, id), with the
sizes of earlier deals added.

Defined cases: a null group is a group of its own, before all others; null ids
come first; rows that share an id are ordered by their leaves, and repeated rows
are leaves each.  A lone leaf is its subroot and a lone subroot is the root.
Empty texts are values of length 0.  Empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import store

BAND = 8


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``rank``, from 0 in each group, and the groups' sizes (group, n)."""
    dealt = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    dealt = store(dealt.select("*", F.spark_partition_id().alias("_deal"), F.monotonically_increasing_id().alias("_at")), name)
    deals = store(dealt.groupBy(group, "_deal").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")), f"{name}-deals")
    before = Window.partitionBy(group).orderBy("_deal").rowsBetween(Window.unboundedPreceding, -1)
    skips = deals.select(group, "_deal", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_skip"))
    placed = dealt.join(skips, [group, "_deal"]).select(*rows.columns, (F.col("_at") + F.col("_skip")).alias("rank"))
    return placed, deals.groupBy(group).agg(F.sum("_n").alias("n"))


def _height(n: Column) -> Column:
    """Levels above the leaves: halvings, rounded up, until one node is left."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0).cast("int")


def _pairs(nodes: str) -> Column:
    """Every two consecutive digests become one; the last one may stand alone."""
    a = F.col(nodes)
    return F.transform(F.sequence(F.lit(0), F.expr(f"(size({nodes}) - 1) div 2")),
                       lambda k: digest(F.get(a, 2 * k), F.coalesce(F.get(a, 2 * k + 1), F.lit(""))))


def _band(base: DataFrame, low: int) -> DataFrame:
    """(g, level, i, lo, hi, digest, n, h): the nodes of ``base`` (g, i, digest, n, h; on level ``low``) and of the levels
    above, as far as the band goes; ``i`` counts the nodes of a level."""
    grown = base.groupBy("g", F.shiftright("i", BAND).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("i", "digest"))).alias("a"), F.first("n").alias("n"), F.first("h").alias("h")) \
        .select("g", "block", "n", "h", F.transform("a", lambda x: x["digest"]).alias("a0"))
    for k in range(BAND):
        grown = grown.withColumn(f"a{k + 1}", F.when(F.col("h") > low + k, _pairs(f"a{k}")).otherwise(F.array().cast("array<string>")))

    def labelled(k: int) -> Column:
        return F.transform(f"a{k}", lambda x, at: F.struct(F.lit(low + k).alias("level"), (F.shiftleft("block", BAND - k) + at).alias("i"),
                                                           x.alias("digest")))

    every = F.concat(*[labelled(k) for k in range(BAND + 1)])
    nodes = grown.select("g", "n", "h", F.explode(every).alias("x")).select("g", "x.level", "x.i", "x.digest", "n", "h")
    return nodes.withColumn("lo", F.expr("shiftleft(i, level)")).withColumn("hi", F.least(F.expr("shiftleft(i + 1, level)"), F.col("n")))


def _siblings(base: DataFrame, nodes: DataFrame, low: int) -> DataFrame:
    """(g, i, path): for each of ``base`` the siblings on the way up through the band, array<struct<level, left,
    digest>>; the digest is null on a level where the node has none."""
    own = base.where(F.col("h") > low).select("g", "i", "n", F.explode(F.sequence(F.lit(low), F.least(F.lit(low + BAND), F.col("h")) - 1)).alias("level"))
    own = own.withColumn("lo", F.expr(f"shiftleft(shiftright(i, level - {low}), level)")) \
        .withColumn("bucket", F.expr(f"shiftright(i, level - {low} + 1)"))
    own = own.withColumn("hi", F.least(F.expr("lo + shiftleft(1L, level)"), F.col("n"))) \
        .withColumn("parent_lo", F.expr("shiftleft(bucket, level + 1)")) \
        .withColumn("parent_hi", F.least(F.expr("shiftleft(bucket + 1, level + 1)"), F.col("n"))).alias("o")
    held = nodes.select("g", "level", F.shiftright("i", 1).alias("bucket"), "lo", "hi", "digest").alias("s")
    inside = (F.col("s.lo") >= F.col("o.parent_lo")) & (F.col("s.hi") <= F.col("o.parent_hi"))
    beside = (F.col("s.hi") <= F.col("o.lo")) | (F.col("s.lo") >= F.col("o.hi"))
    same = (F.col("o.g") == F.col("s.g")) & (F.col("o.level") == F.col("s.level")) & (F.col("o.bucket") == F.col("s.bucket"))
    met = own.join(held, same & inside & beside, "left")
    step = F.struct(F.col("o.level").alias("level"), (F.col("s.lo") < F.col("o.lo")).alias("left"), F.col("s.digest").alias("digest"))
    return met.groupBy("o.g", "o.i").agg(F.array_sort(F.collect_list(step)).alias("path"))


NO_PATH = "array<struct<level:int,left:boolean,digest:string>>"


def _forest(leaves: DataFrame, sizes: DataFrame, name: str) -> tuple[DataFrame, DataFrame, list[DataFrame], list[DataFrame]]:
    """Of ``leaves`` (g, rank, digest): all nodes, the subroots (g, digest, n, h), and by band its base nodes and their paths."""
    sizes = sizes.select("g", "n", _height(F.col("n")).alias("h"))
    top = sizes.agg(F.max("h")).first()[0] or 0
    base = leaves.join(sizes, "g").select("g", F.col("rank").alias("i"), "digest", "n", "h")
    nodes, bases, paths = [], [], []
    for low in range(0, max(top, 1), BAND):
        band = store(_band(base, low), f"{name}-nodes")
        base = band.where(F.col("level") == low).select("g", "i", "digest", "n", "h")
        bases.append(base)
        paths.append(store(_siblings(base, band.where(F.col("level") < low + BAND), low), f"{name}-paths"))
        nodes.append(band if not nodes else band.where(F.col("level") > low))
        base = band.where((F.col("level") == low + BAND) & (F.col("h") > low + BAND)).select("g", "i", "digest", "n", "h")
    every = nodes[0]
    for band in nodes[1:]:
        every = every.unionByName(band)
    return every, every.where("level = h").select("g", "digest", "n", "h"), bases, paths


def _upward(subroots: DataFrame, paths: list[DataFrame]) -> DataFrame:
    """(g, block, path, subroot, root) for the first band's blocks: what goes on above them; ``subroots`` has (g, h, subroot,
    root, path) with the path from the subroot up."""
    above = None
    for band in range(len(paths) - 1, -1, -1):
        ends = F.col("h") <= BAND * (band + 1)
        here = subroots.where(ends & (F.col("h") > BAND * band) if band else ends).select("g", F.lit(0).cast("bigint").alias("block"), "path", "subroot", "root")
        above = here if above is None else here.unionByName(above)
        if band:
            below = above.withColumnRenamed("path", "rest")
            above = paths[band].withColumn("block", F.shiftright("i", BAND)).join(below, ["g", "block"]) \
                .select("g", F.col("i").alias("block"), F.concat("path", "rest").alias("path"), "subroot", "root")
    return above


@dataclass
class Manifest:
    """``nodes`` (group, level, lo, hi, digest) of the groups' trees; ``proofs`` (id, group, rank, leaf, [claim,] subroot,
    root, path) of the rows, where path has the siblings from the leaf to the root, array<struct<level, left, digest>>."""

    nodes: DataFrame
    proofs: DataFrame


def build(rows: DataFrame, columns: list[str], group_col: str, id_col: str, claim: Column | None = None) -> Manifest:
    """The manifest of ``rows`` by their fields ``columns``; ``claim`` is a leaf digest to be held against the root."""
    group = F.col(group_col).cast("string")
    narrow = rows.select(F.when(group.isNull(), "-").otherwise(F.concat(F.lit("="), group)).alias("g"), F.col(id_col).alias("id"),
                         leaf_digest(*[F.col(c) for c in columns]).alias("leaf"), *([] if claim is None else [claim.alias("claim")]),
                         F.monotonically_increasing_id().alias("salt"))     # parts repeated rows
    leaves, sizes = ranked(store(narrow, "leaves"), "g", ["id", "leaf", "salt"], "ranked")
    leaves = store(leaves.drop("salt"), "places")
    nodes, subroots, _, paths = _forest(leaves.select("g", "rank", F.col("leaf").alias("digest")), sizes, "tree")
    subroots = store(subroots, "subroots")
    top_leaves, top_sizes = ranked(subroots.select(F.lit("").alias("all"), "g", "digest"), "all", ["g"], "top-ranked")
    top_leaves = store(top_leaves, "top-places")
    _, roots, _, top_paths = _forest(top_leaves.select(F.col("all").alias("g"), "rank", "digest"), top_sizes.withColumnRenamed("all", "g"), "top")
    top = roots.select("g", F.col("h"), F.col("digest").alias("subroot"), F.col("digest").alias("root"), F.array().cast(NO_PATH).alias("path"))
    upward = _upward(top, top_paths).select(F.col("g").alias("all"), "block", "root", F.col("path").alias("rest"))
    ends = top_leaves.withColumn("block", F.shiftright("rank", BAND)).join(upward, ["all", "block"]) \
        .join(top_paths[0].select(F.col("g").alias("all"), F.col("i").alias("rank"), "path"), ["all", "rank"], "left") \
        .select("g", F.col("digest").alias("subroot"), "root", F.concat(F.coalesce("path", F.array().cast(NO_PATH)), "rest").alias("path"))
    ends = store(ends.join(subroots.select("g", "h"), "g"), "ends")
    above = store(_upward(ends, paths).withColumnRenamed("path", "rest"), "above")
    own = leaves.join(paths[0].withColumnRenamed("i", "rank"), ["g", "rank"], "left").withColumn("block", F.shiftright("rank", BAND))
    whole = F.concat(F.coalesce("path", F.array().cast(NO_PATH)), "rest")
    back = F.when(F.col("g") != "-", F.expr("substr(g, 2)"))
    proofs = own.join(above, ["g", "block"]).select("id", back.alias("group"), "rank", "leaf", *([] if claim is None else ["claim"]),
                                                     "subroot", "root", whole.alias("path"))
    return Manifest(nodes.select(back.alias("group"), "level", "lo", "hi", "digest"), proofs)


def path_digest(path: str = "path") -> Column:
    """H of the siblings, from the leaf up."""
    return digest(F.array_join(F.transform(path, lambda x: x["digest"]), ""))


def folded(leaf: str, path: str = "path") -> Column:
    """The root that follows from a leaf and the siblings on its path."""
    return F.aggregate(path, F.col(leaf), lambda below, x: F.when(x["digest"].isNull(), digest(below))
                       .when(x["left"], digest(x["digest"], below)).otherwise(digest(below, x["digest"])))


def audit(rows: DataFrame, claim: Column, columns: list[str], group_col: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """(id_col, leaf, subroot, root, proof_sha256, folded_root, verified): is each row's ``claim``, a leaf digest, what the
    manifest of ``rows`` has?"""
    proofs = build(rows, columns, group_col, id_col, claim).proofs
    out = proofs.select(F.col("id").alias(id_col), "leaf", "subroot", "root", path_digest().alias("proof_sha256"), folded("claim").alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
