"""Ranked lexical search over hashed max-sketches.

Terms are runs of digits, letters a-z (A-Z are lower-cased) and characters
beyond ASCII.  N counts the documents with a term, L all terms, n the terms of
one document, df the documents that hold a term, tf its occurrences in one.  A
term weighs w = floor(1000 ln((2 N + 2) / (2 df + 1))); with m = 75 +
25 n N div L a document's impact of a term is (10^9 tf) div (1000 tf + 12 m),
and its score is the sum of w times impact over the query's terms, repeats
included.

Index: the impact grows with tf, so each document folds its terms' tf (255 at
most, which stands for any larger one) into coordinatewise maxima: ``ROWS`` rows
of cells, a power of two at least ``LOAD`` times its different terms, each term
hashed to one cell a row.  The least of a term's cells is never below its tf.
The index also has the lexicon (term, df).  Both come from one pass over the
texts and do not depend on any query; a lexicon is added up in the task before
it is shuffled.

Search: queries go in blocks of at most about ``BLOCK_TERMS`` terms and
``BLOCK_ITEMS`` items, which bounds what a task holds of them.  A block is
looked up in the sketches of many documents at once and gives an upper bound of
every score.  First the documents with the ``k`` highest bounds of each query
are scored exactly; the k-th of these scores is the threshold, and all documents
whose bound reaches it are scored, none else can be among the first k.  Scores
come from whole texts in 64-bit integers.

Defined cases: null text has no terms.  Rows are documents each, repeated ones
and those that share an id included; equal scores are ranked by ascending id,
a null id last.  Queries that share an id are one query with the terms of all
its different texts; a null id is an id.  A query without terms, or without
documents that score above 0, has no rows.  Empty tables give empty results.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bloom_filters, slices, store
from .decontaminate import words_of

ROWS, LOAD, LEAST_CELLS = 4, 2, 16
BLOCK_TERMS, BLOCK_ITEMS = 8192, 256
LEXICON = 1 << 18       # terms that a task adds up before it gives them away
CHUNK = 1 << 21         # cells that are looked at together
FULL = 255


def cells_of(hashes: np.ndarray, width: int) -> np.ndarray:
    """The cell of each term in each row of a sketch."""
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return ((low + np.arange(ROWS, dtype=np.uint64)[:, None] * high) & np.uint64(width - 1)).astype(np.int64)


def sketch(hashes: np.ndarray, tf: np.ndarray) -> bytes:
    """Coordinatewise maxima of one document's term counts."""
    width = LEAST_CELLS
    while width < LOAD * len(hashes):
        width *= 2
    out = np.zeros((ROWS, width), dtype=np.uint8)
    count = np.minimum(tf, FULL).astype(np.uint8)
    for row, at in zip(out, cells_of(hashes, width)):
        np.maximum.at(row, at, count)
    return out.tobytes()


def norm(n: int, documents: int, terms: int) -> int:
    """m of a document with n terms."""
    return 75 + 25 * n * documents // terms


@dataclass
class Index:
    """``sketches`` (id, th, n, cells) of all rows, ``lexicon`` (term, df), and the totals N and L."""

    sketches: DataFrame
    lexicon: DataFrame
    documents: int
    terms: int


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, text): a row is addressed by its id and a hash of its text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """Sketches and lexicon of ``docs``, stored."""
    names = ["id", "th", "n", "cells", "term", "df"]

    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        lexicon: dict[bytes, int] = {}
        hashes, df = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)

        def told():
            n = len(lexicon)
            return pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()),
                                               pa.array(list(lexicon), pa.binary()), pa.array(df[:n])], names=names)

        for batch in batches:
            for part in slices(batch, 2):
                seen, n = [], []
                counts = []
                before = len(lexicon)
                for text in part.column(2):
                    count = Counter(words_of(text.as_py()))
                    seen.append(np.fromiter((lexicon.setdefault(t, len(lexicon)) for t in count), dtype=np.int64, count=len(count)))
                    counts.append(np.fromiter(count.values(), dtype=np.int64, count=len(count)))
                    n.append(int(counts[-1].sum()))
                new = list(lexicon)[before:]
                hashes = np.concatenate([hashes, np.fromiter(map(digest, new), dtype=np.uint64, count=len(new))])
                df = np.concatenate([df, np.zeros(len(new), dtype=np.int64)])
                df += np.bincount(np.concatenate(seen), minlength=len(df))
                cells = [sketch(hashes[s], c) if len(s) else None for s, c in zip(seen, counts)]
                k = part.num_rows
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(cells, pa.binary()),
                                                  pa.nulls(k, pa.binary()), pa.nulls(k, pa.int64())], names=names)
                if len(lexicon) > LEXICON:
                    yield told()
                    lexicon, hashes, df = {}, hashes[:0], df[:0]
        yield told()

    rows = keyed(docs, id_col, text_col).mapInArrow(run, "id bigint, th bigint, n bigint, cells binary, term binary, df bigint")
    rows = store(rows, "sketches", compression="zstd")
    totals = rows.where("n > 0").agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L")).first()
    return Index(rows.where("n > 0").select("id", "th", "n", "cells"), rows.where("df is not null").select("term", "df"), totals["N"], totals["L"] or 0)


def query_terms(items: DataFrame, index: Index, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, term, w): the terms of each item, with their weights times their repeats."""
    texts = items.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).where("text is not null").distinct()
    kind = items.schema[item_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for k, text in enumerate(batch.column(1)):
                count = Counter(words_of(text.as_py()))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([k] * len(count), pa.int64())), pa.array(list(count), pa.binary()),
                                                  pa.array(count.values(), pa.int64())], names=["item", "term", "n"])

    terms = store(texts.mapInArrow(run, f"item {kind}, term binary, n bigint").groupBy("item", "term").agg(F.sum("n").alias("n")), "query-terms")
    asked = terms.select("term").distinct()
    known = index.lexicon.join(asked, "term").groupBy("term").agg(F.sum("df").alias("df"))
    df = F.coalesce("df", F.lit(0))
    weight = F.floor(1000 * F.log(F.lit(2.0 * index.documents + 2) / (2 * df + 1).cast("double")))
    return store(terms.join(known, "term", "left").select("item", "term", (weight * F.col("n")).alias("w")), "weights")


class Block:
    """Some queries, as arrays: different terms, items, and who weighs what (term, item, w)."""

    def __init__(self, rows: list, kind: pa.DataType):
        items = list(dict.fromkeys(r["item"] for r in rows))
        terms = list(dict.fromkeys(bytes(r["term"]) for r in rows))
        at, of = {t: i for i, t in enumerate(terms)}, {x: i for i, x in enumerate(items)}
        self.slot = at
        self.items = pa.array(items, kind)
        self.hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, terms), dtype=np.uint64, count=len(terms))
        self.at = np.array([at[bytes(r["term"])] for r in rows])
        self.of = np.array([of[r["item"]] for r in rows])
        self.w = np.array([r["w"] for r in rows], dtype=np.int64)

    def matrix(self, kind) -> np.ndarray:
        out = np.zeros((len(self.slot), len(self.items)), dtype=kind)
        out[self.at, self.of] = self.w
        return out


def upper_bounds(batches, block: Block, documents: int, terms: int):
    """Of batches (id, th, n, cells): (ids, ths, bounds[document, item]), in chunks.  Bounds are whole numbers below 2^53,
    so sums in doubles are exact."""
    weights, cells = block.matrix(np.float64), {}
    count = np.arange(FULL + 1, dtype=np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, ths, sketches = batch.column(0), batch.column(1), batch.column(3)
        size = np.array([len(c.as_buffer()) for c in sketches])
        m = np.array([norm(n, documents, terms) for n in batch.column(2).to_pylist()], dtype=np.int64)
        for whole in np.unique(size):
            width = int(whole) // ROWS
            if width not in cells:
                cells[width] = cells_of(block.hashes, width)
            rows = np.flatnonzero(size == whole)
            step = max(1, CHUNK // max(width * ROWS, len(block.slot), len(block.items)))
            for a in range(0, len(rows), step):
                some = rows[a:a + step]
                data = np.frombuffer(b"".join(sketches[int(r)].as_buffer() for r in some), dtype=np.uint8).reshape(len(some), ROWS, width)
                tf = data[:, 0, cells[width][0]]
                for r in range(1, ROWS):
                    tf = np.minimum(tf, data[:, r, cells[width][r]])
                held = np.flatnonzero(tf.any(axis=0))
                impact = (10 ** 9 * count) // (1000 * count + 12 * m[some][:, None])
                impact[:, FULL] = 10 ** 6
                parts = np.take_along_axis(impact.astype(np.float64), tf[:, held].astype(np.int64), axis=1)
                take = pa.array(some)
                yield ids.take(take), ths.take(take), parts @ weights[held]


def highest_bounds(index: Index, block, k: int, kind: str) -> DataFrame:
    """(item, id, th, bound): the k documents with the highest bounds of each item in each task."""
    documents, terms = index.documents, index.terms

    def run(batches):
        b = block.value
        item, doc = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        bound, ids, ths = np.zeros(0), pa.array([], pa.int64()), pa.array([], pa.int64())
        floor = np.zeros(len(b.items))

        def prune():
            nonlocal item, doc, bound, ids, ths
            order = np.lexsort((-bound, item))
            item, doc, bound = item[order], doc[order], bound[order]
            first = np.searchsorted(item, item)
            best = np.arange(len(item)) - first < k
            last = np.arange(len(item)) - first == k - 1
            floor[item[last]] = bound[last]
            item, doc, bound = item[best], doc[best], bound[best]
            left, doc = np.unique(doc, return_inverse=True)
            ids, ths = ids.take(pa.array(left)), ths.take(pa.array(left))

        for new_ids, new_ths, bounds in upper_bounds(batches, b, documents, terms):
            row, of = np.nonzero(bounds > floor)
            if not len(row):
                continue
            item, doc, bound = np.concatenate([item, of]), np.concatenate([doc, row + len(ids)]), np.concatenate([bound, bounds[row, of]])
            ids, ths = pa.concat_arrays([ids, new_ids]), pa.concat_arrays([ths, new_ths])
            prune()
        yield pa.RecordBatch.from_arrays([b.items.take(pa.array(item)), ids.take(pa.array(doc)), ths.take(pa.array(doc)), pa.array(bound.astype(np.int64))],
                                         names=["item", "id", "th", "bound"])

    return index.sketches.mapInArrow(run, f"item {kind}, id bigint, th bigint, bound bigint")


def above(index: Index, block, floors, kind: str) -> DataFrame:
    """(item, id, th): all documents whose bound reaches the item's floor."""
    documents, terms = index.documents, index.terms

    def run(batches):
        b, floor = block.value, floors.value
        for ids, ths, bounds in upper_bounds(batches, b, documents, terms):
            row, of = np.nonzero(bounds >= floor)
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([b.items.take(pa.array(of)), ids.take(take), ths.take(take)], names=["item", "id", "th"])

    return index.sketches.mapInArrow(run, f"item {kind}, id bigint, th bigint")


def exact(texts: DataFrame, pairs: DataFrame, index: Index, block, kind: str) -> DataFrame:
    """(item, id, score) above 0 of the documents and items in ``pairs`` (item, id, th); ``texts`` as from ``keyed``."""
    documents, terms = index.documents, index.terms
    wanted = store(pairs.groupBy("id", "th").agg(F.collect_set(F.struct("item")).alias("items")), "wanted")
    same = (texts["th"] == wanted["th"]) & texts["id"].eqNullSafe(wanted["id"])
    with bloom_filters(texts.sparkSession):
        rows = texts.join(wanted.where("size(items) > 0"), same).select(texts["id"], "text", "items")

        def run(batches):
            b = block.value
            weights, of = b.matrix(np.int64), {x: i for i, x in enumerate(b.items.to_pylist())}
            for batch in batches:
                for part in slices(batch, 1):
                    for r in range(part.num_rows):
                        words = words_of(part.column(1)[r].as_py())
                        held = Counter(w for w in words if w in b.slot)
                        at = np.fromiter((b.slot[w] for w in held), dtype=np.int64, count=len(held))
                        tf = np.fromiter(held.values(), dtype=np.int64, count=len(held))
                        impact = 10 ** 9 * tf // (1000 * tf + 12 * norm(len(words), documents, terms)) if len(words) else tf
                        asked = np.array([of[x["item"]] for x in part.column(2)[r].as_py()])
                        score = impact @ weights[np.ix_(at, asked)]
                        asked, score = asked[score > 0], score[score > 0]
                        yield pa.RecordBatch.from_arrays([b.items.take(pa.array(asked)), part.column(0).take(pa.array([r] * len(asked), pa.int64())),
                                                          pa.array(score, pa.int64())], names=["item", "id", "score"])

        return store(rows.mapInArrow(run, f"item {kind}, id bigint, score bigint"), "scores")


def _best(rows: DataFrame, k: int, *order) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def search(index: Index, docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_terms: int = BLOCK_TERMS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(item_col, rank, id_col, score): the k best documents of each item; ``index`` is that of ``docs``."""
    spark = docs.sparkSession
    field = items.schema[item_col].dataType
    kind = field.simpleString()
    arrow = items.select(item_col).limit(0).toArrow().schema[0].type
    queries = query_terms(items, index, item_col, item_text_col)
    size = queries.agg(F.count(F.lit(1)).alias("terms"), F.count_distinct(F.struct("item")).alias("items")).first()
    blocks = max(1, -(-size["terms"] // block_terms), -(-size["items"] // block_items))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    texts = keyed(docs, id_col, text_col)
    out = None
    for n in range(blocks):
        rows = queries.where(F.col("block") == n).collect()     # a block is bounded
        if not rows or not index.documents:
            continue
        made = Block(rows, arrow)
        block = spark.sparkContext.broadcast(made)
        first = _best(store(highest_bounds(index, block, k, kind), "bounds"), k, F.col("bound").desc())
        scored = exact(texts, first, index, block, kind)
        least = _best(scored, k, F.col("score").desc()).groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("score"))
        of = {x: i for i, x in enumerate(made.items.to_pylist())}
        floor = np.ones(len(of))
        for r in least.where(F.col("n") >= k).collect():
            floor[of[r["item"]]] = r["score"]
        floors = spark.sparkContext.broadcast(floor)
        scored = exact(texts, store(above(index, block, floors, kind), "above"), index, block, kind)
        best = store(_best(scored, k, F.col("score").desc(), F.col("id").asc_nulls_last()), "ranked")
        out = best if out is None else out.unionByName(best)
        block.unpersist()
        floors.unpersist()
    if out is None:
        out = queries.select("item").where("false").select("item", F.lit(1).alias("rank"), F.lit(0).cast("bigint").alias("id"), F.lit(0).cast("bigint").alias("score"))
    return out.select(F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
