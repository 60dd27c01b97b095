"""Approximate nearest neighbours with a forest of random-projection trees.

Largest inner product becomes nearest direction by one more component that
brings every vector to the largest norm of the table.  The trees are fitted on
a bounded sample (``sample`` vectors, by a hash of their id): a node takes two
random members, projects on their difference and splits at the median, down
to ``leaf_size`` sample members.  All rows are then indexed by their leaf in
each tree.

A query walks all trees through one priority queue, ordered by the squared
margins of the planes it went past on the wrong side, until it has
``probe_share`` of the forest's leaves (``least_probes`` at least); the members
of these leaves are the candidates, reranked by their exact inner product in
double precision.  The number of leaves is bounded by the sample, so the share
of rows that a query meets, and with it the recall, does not fall as the table
grows; a smaller share trades recall for work.

Equal vectors have equal scores and go by id, so of one vector only the first
k + 1 ids can be in a result of k; a windowed row limit (taken before the
shuffle) leaves these and the trees index distinct vectors.  Leaves that are
large beyond the sample's expectation are dealt over several groups of at most
``group_rows`` members, and so are a leaf's queries; each group answers with
its k best per query.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, as candidates or queries; so do rows with null id and
vectors of another length than most.  Repeated rows count once.  Fewer than k candidates: all
that were found.  Empty tables give empty results.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import store

TREES, LEAF_SIZE, PROBE_SHARE, LEAST_PROBES, SAMPLE, GROUP_ROWS = 8, 1024, 0.11, 32, 65_536, 4096


@dataclass
class Forest:
    """Nodes of all trees in flat arrays; a child >= 0 is a node, otherwise leaf -child - 1."""
    normals: np.ndarray
    offsets: np.ndarray
    children: np.ndarray    # node x 2: at or below the median, above
    roots: list
    leaf_tree: np.ndarray


def fit(vectors: np.ndarray, trees: int, leaf_size: int, seed: int) -> Forest:
    rng = np.random.default_rng(seed)
    normals, offsets, children, roots, leaf_tree = [], [], [], [], []

    def leaf(tree: int) -> int:
        leaf_tree.append(tree)
        return -len(leaf_tree)

    for tree in range(trees):
        todo = [(np.arange(len(vectors)), None)]
        while todo:
            rows, parent = todo.pop()
            here = None
            if len(rows) > leaf_size:
                for _ in range(5):
                    a, b = vectors[rng.choice(rows, 2, replace=False)]
                    normal = a - b
                    side = vectors[rows] @ normal
                    cut = float(np.median(side))
                    low = side <= cut
                    if 0 < low.sum() < len(rows):
                        here = len(normals)
                        normals.append(normal / np.linalg.norm(normal))
                        offsets.append(cut / np.linalg.norm(normal))
                        children.append([0, 0])
                        todo += [(rows[low], (here, 0)), (rows[~low], (here, 1))]
                        break
            here = leaf(tree) if here is None else here
            if parent is None:
                roots.append(here)
            else:
                children[parent[0]][parent[1]] = here
    width = vectors.shape[1]
    return Forest(np.array(normals).reshape(-1, width), np.array(offsets), np.array(children, dtype=np.int64).reshape(-1, 2), roots,
                  np.array(leaf_tree))


def leaves_of(forest: Forest, vectors: np.ndarray) -> np.ndarray:
    """The leaf of every vector in every tree (vectors x trees)."""
    out = np.empty((len(vectors), len(forest.roots)), dtype=np.int64)
    for t, root in enumerate(forest.roots):
        here = np.full(len(vectors), root)
        while len(go := np.flatnonzero(here >= 0)):
            node = here[go]
            side = np.einsum("ij,ij->i", vectors[go], forest.normals[node]) - forest.offsets[node]
            here[go] = forest.children[node, (side > 0).astype(np.int64)]
        out[:, t] = -here - 1
    return out


def probe(forest: Forest, margins: np.ndarray, probes: int) -> list[int]:
    """Leaves for one query in the order of a priority queue shared by all trees; ``margins`` are its distances to
    the nodes' planes."""
    queue = [(0.0, r) for r in forest.roots]
    heapq.heapify(queue)
    found: list[int] = []
    children = forest.children
    while queue and len(found) < probes:
        p, here = heapq.heappop(queue)
        while here >= 0:            # down the near side, which keeps the priority; the far side waits
            m = margins[here]
            near, far = (children[here, 1], children[here, 0]) if m > 0 else (children[here, 0], children[here, 1])
            heapq.heappush(queue, (p + m * m, int(far)))
            here = int(near)
        found.append(-here - 1)
    return found


def valid_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec array<double>) of the rows that take part."""
    vec = F.col("vec")
    rows = table.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"))
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & vec.isNotNull() & (F.size(vec) > 0) & finite & F.exists(vec, lambda x: x != 0))


def _matrix(column, extra: np.ndarray | None = None) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 0))
    m = np.stack([np.asarray(x, dtype=np.float64) for x in column])
    return m if extra is None else np.column_stack([m, extra])


def search(table: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = TREES,
           leaf_size: int = LEAF_SIZE, probe_share: float = PROBE_SHARE,
           least_probes: int = LEAST_PROBES, sample: int = SAMPLE, seed: int = 5, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for every row where ``is_query`` (a function of the id
    column) holds, the query's own row left out."""
    spark = table.sparkSession
    out_schema = "query_id bigint, rank int, vec_id bigint, score double"
    rows = valid_vectors(table, id_col, vector_col)
    widths = rows.groupBy(F.size("vec").alias("w")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").first()
    if widths is None:
        return spark.createDataFrame([], out_schema)
    rows = store(rows.where(F.size("vec") == widths["w"]).distinct(), "vectors")
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    largest = rows.agg(F.max(square)).first()[0]
    # ids of equal vectors: the first k + 1
    first = Window.partitionBy("vec").orderBy("id")
    few = rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1)
    members = store(few.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("lift", F.sqrt(F.greatest(F.lit(0.0), F.lit(largest) - square))), "distinct-vectors")
    n = members.count()
    chance = min(1.0, sample / n)
    fitted = members.where(F.pmod(F.xxhash64(F.col("ids")[0], F.lit(seed)), F.lit(1 << 20)) < int(chance * (1 << 20))) \
        .orderBy(F.xxhash64(F.col("ids")[0], F.lit(seed)), F.col("ids")[0]).limit(sample).select("vec", "lift").toPandas()
    if fitted.empty:
        fitted = members.limit(1).select("vec", "lift").toPandas()
    forest = fit(_matrix(fitted["vec"], fitted["lift"].to_numpy()), trees, leaf_size, seed)
    probes = max(least_probes, int(np.ceil(probe_share * len(forest.leaf_tree))))
    sent = spark.sparkContext.broadcast(forest)     # bounded by the sample

    def index(batches):
        for b in batches:
            if b.num_rows:
                vec = _matrix(b.column(0).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False))
                at = leaves_of(sent.value, vec)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * at.shape[1]), pa.array(at.reshape(-1))),
                                                  b.column(0), b.column(1)], names=["leaves", "vec", "ids"])

    def walk(batches):
        for b in batches:
            if b.num_rows:
                vec = _matrix(b.column(1).to_numpy(zero_copy_only=False), np.zeros(b.num_rows))
                f = sent.value
                margins = vec @ f.normals.T - f.offsets
                found = [probe(f, m, probes) for m in margins]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64())), b.column(0), b.column(1)], names=["leaves", "query", "vec"])

    indexed = members.select("vec", "ids", "lift").mapInArrow(index, "leaves array<bigint>, vec array<double>, ids array<bigint>") \
        .select(F.explode("leaves").alias("leaf"), "vec", "ids")
    queries = rows.where(is_query(F.col("id"))).select("id", "vec")
    probed = queries.mapInArrow(walk, "leaves array<bigint>, query bigint, vec array<double>") \
        .select(F.explode("leaves").alias("leaf"), "query", "vec")
    indexed, probed = store(indexed, "leaves"), store(probed, "probes")
    # both sides of a leaf are cut to groups of bounded size: each member cell meets each query cell of its leaf
    size = store(indexed.groupBy("leaf").agg(F.ceil(F.count("*") / group_rows).cast("int").alias("cells")) \
        .join(probed.groupBy("leaf").agg(F.ceil(F.count("*") / group_rows).cast("int").alias("blocks")), "leaf"), "sizes")
    of_members = indexed.join(size, "leaf").select("leaf", "vec", "ids", F.pmod(F.xxhash64("ids"), "cells").cast("int").alias("cell"),
                                                   F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    of_queries = probed.join(size, "leaf").select("leaf", "query", "vec", F.pmod(F.xxhash64("query"), "blocks").cast("int").alias("block"),
                                                  F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"))

    def rerank(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(members):
            return pd.DataFrame({"query": [], "vec_id": [], "score": []}).astype({"query": "int64", "vec_id": "int64", "score": "float64"})
        q, m = _matrix(queries["vec"]), _matrix(members["vec"])
        counts = np.array([len(x) for x in members["ids"]])
        ids = np.concatenate([np.asarray(x) for x in members["ids"]])
        of = np.repeat(np.arange(len(m)), counts)
        got = []
        for a in range(0, len(q), 256):
            score = (q[a:a + 256] @ m.T)[:, of]
            for j, s in enumerate(score):
                other = ids != queries["query"].iloc[a + j]
                i, s = ids[other], s[other]
                if len(s) > k:      # a margin above rounding; then once more, with sums in one order for all
                    some = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k] - 1e-9 * np.abs(s).max())
                    i, s = i[some], s[some]
                    s = (m[of[other][some]] * q[a + j]).sum(axis=1)
                    order = np.lexsort((i, -s))[:k]
                    i, s = i[order], s[order]
                else:
                    s = (m[of[other]] * q[a + j]).sum(axis=1)
                got.append((np.full(len(i), queries["query"].iloc[a + j]), i, s))
        return pd.DataFrame({"query": np.concatenate([x for x, _, _ in got]), "vec_id": np.concatenate([x for _, x, _ in got]),
                             "score": np.concatenate([x for _, _, x in got])})

    keys = ("leaf", "cell", "block")
    near = of_queries.groupBy(*keys).cogroup(of_members.groupBy(*keys)).applyInPandas(rerank, "query bigint, vec_id bigint, score double")
    best = near.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), "vec_id", "score")
