"""SimHash near-duplicates, searched with BK-trees.

Fingerprints: A-Z are lower-cased, words are runs of characters other than
space and U+0009 to U+000D; a shingle is ``shingle`` neighbouring words joined
by a space (a shorter text is one shingle, a text without words has
fingerprint zero).  A bit of the fingerprint is 1 if it is set in over half of
the shingles' XXH64 values (seed 42), repeats included.

Linking: equal fingerprints are one class.  Two fingerprints within
``radius`` bits agree on at least one of radius + 1 blocks of their bits, so
each distinct fingerprint goes to one shard per block, named by the block's
value.  A shard over ``shard_size`` is split again by the bits that it has not
fixed, in the same way, until it fits (fingerprints are distinct, so the free
bits bound it in the end); no shard is cut by rows, so no link is lost.  In a
shard a BK-tree takes the fingerprints one by one: children are keyed by their
integer Hamming distance to the parent, and a search follows only edges whose
distance is within ``radius`` of the query's.  The trees meet their queries in
the shard's task instead of being broadcast: their number follows the corpus,
so a broadcast of them would have no bound.  A shard gives one edge per member
to the root of its local component, not all pairs.

Defined cases: null text has no words.  Rows with null id are classified like
others; component_id is the smallest non-null id of the component (null if it
has none).  Repeated rows and repeated ids each give their row.  Empty tables
give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append_columns, store, texts_of
from .components import components

SHARD_SIZE = 2048


def fingerprint(text: str, shingle: int = 3) -> int:
    """SimHash of one text, as a signed 64-bit integer."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        end = np.cumsum(size) - 1
        start = end - size + 1
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(start[:len(words) - shingle + 1].tolist(), end[shingle - 1:].tolist())]
    h = np.array(hashes, dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for a in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[a:a + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(h), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, fp) of every row: its id, a hash of its text, its fingerprint."""
    def start():
        return lambda text: [pa.array([fingerprint(t, shingle) for t in texts_of(text)], pa.int64())]

    keyed = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("th"), F.col(text_col).alias("text"))
    return append_columns(keyed, ["text"], [("fp", "bigint")], start, "text", keep=["id", "th"])


class BKTree:
    """Distinct 64-bit integers; children keyed by the Hamming distance to their parent."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        here, new = 0, len(self.values) - 1
        while new:
            d = (self.values[here] ^ value).bit_count()
            below = self.children[here].setdefault(d, new)
            if below == new:
                break
            here = below

    def within(self, value: int, radius: int) -> Iterator[int]:
        """Places of the members at most ``radius`` bits away."""
        todo = [0] if self.values else []
        while todo:
            here = todo.pop()
            d = (self.values[here] ^ value).bit_count()
            if d <= radius:
                yield here
            children = self.children[here]
            if len(children) <= 2 * radius + 1:
                todo.extend(k for e, k in children.items() if d - radius <= e <= d + radius)
            else:
                todo.extend(children[e] for e in range(d - radius, d + radius + 1) if e in children)


def shard_links(members: list[int], radius: int) -> list[tuple[int, int]]:
    """(member, root) edges that join the members of one shard as all its pairs within the radius would."""
    tree, root = BKTree(), list(range(len(members)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, value in enumerate(members):
        unsigned = value & 0xFFFFFFFFFFFFFFFF
        for j in tree.within(unsigned, radius):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
        tree.add(unsigned)
    return [(members[i], members[find(i)]) for i in range(len(members)) if find(i) != i]


def _blocks(mask: int, parts: int) -> list[int]:
    """The bits that ``mask`` leaves free, in ``parts`` blocks, each joined to the mask."""
    free = [b for b in range(64) if not mask >> b & 1]
    cut = [len(free) * k // parts for k in range(parts + 1)]
    return [mask | sum(1 << b for b in free[x:y]) for x, y in zip(cut, cut[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(distinct: DataFrame, radius: int = 2, shard_size: int = SHARD_SIZE) -> DataFrame:
    """Edges (u, v) whose components are those of all pairs of ``distinct`` (fp) within ``radius`` bits."""
    if not 0 <= radius < 16:
        raise ValueError("radius must be 0 to 15")

    def search(batches):
        for batch in batches:
            got = [e for shard in batch.column(0).to_pylist() for e in shard_links(shard, radius)]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in got], pa.int64()), pa.array([b for _, b in got], pa.int64())], names=["u", "v"])

    found, masks, members = None, [0], distinct.select("fp", F.lit(0).cast("bigint").alias("mask"))
    while masks:
        split = {m: _blocks(m & 0xFFFFFFFFFFFFFFFF, radius + 1) for m in masks}
        to = F.array()
        for m, parts in split.items():
            to = F.when(F.col("mask") == m, F.array(*[F.lit(_signed(p)).cast("bigint") for p in parts])).otherwise(to)
        keyed = members.select("fp", F.explode(to).alias("mask")).withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        counts = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
        sized = store(keyed.join(counts, ["mask", "key"]), "shards")
        cold = sized.where(F.col("n") <= shard_size).groupBy("mask", "key").agg(F.array_sort(F.collect_list("fp")).alias("shard"))
        edges = cold.select("shard").mapInArrow(search, "u bigint, v bigint")
        found = edges if found is None else found.unionByName(edges)
        hot = sized.where(F.col("n") > shard_size)
        # the masks of one level: radius + 1 for each mask above that still has a hot shard
        masks = [r["mask"] for r in hot.select("mask").distinct().collect()]
        members = hot.select("fp", "mask").distinct()
    return found


def classes(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text",
            shard_size: int = SHARD_SIZE) -> DataFrame:
    """(id, th, fp, root, component_id) of every row; rows are near-duplicates if their root is equal."""
    prints = store(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = store(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    joined = components(links(distinct, radius, shard_size))
    rooted = distinct.join(joined, distinct["fp"] == joined["vertex"], "left") \
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = store(rooted.join(least, "root").select("fp", "root", "component_id"), "classes")
    return prints.join(named, "fp")      # of stored tables, so that the skew join can split a fingerprint with very many copies


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text",
                    shard_size: int = SHARD_SIZE) -> DataFrame:
    """One row per row of ``docs``: id_col, fingerprint (16 hex digits), component_id."""
    return classes(docs, shingle, radius, id_col, text_col, shard_size).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text",
                    shard_size: int = SHARD_SIZE) -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near-duplicates the one with the smallest id (nulls last,
    then by a hash of the text); of exactly repeated rows one."""
    kept = classes(docs, shingle, radius, id_col, text_col, shard_size).groupBy("root") \
        .agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), F.coalesce("id", F.lit(0)).alias("key"), "th")).alias("k")) \
        .select("k.*")
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, text = F.col(f"c{names.index(id_col)}"), F.col(f"c{names.index(text_col)}")
    on = ["no_id", "key", "th"]
    named = inner.withColumn("no_id", key.isNull()).withColumn("key", F.coalesce(key, F.lit(0))) \
        .withColumn("th", F.xxhash64(F.coalesce(text, F.lit(""))))
    return named.join(kept, on, "left_semi").dropDuplicates(on).select(*inner.columns).toDF(*names)
