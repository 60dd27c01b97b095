"""Token ids in ORC files.

Documents are dealt by range of their id and sorted, tokenized where they
land, and written as ORC: ids are integer columns (run-length encoded),
stripes are cut by size and read in parallel, every ``stride`` rows have an
index entry, and the document ids have Bloom filters, so a reader of a few
documents skips stripes and row groups by metadata alone (``read_tokens`` with
``ids``).  Each document ends with ``end_id``.

A task writes the offset inside its own part; what all parts before hold is
added when the files are read, from one sum per part.

Defined cases: null or empty text holds the end id alone.  Null document ids
come first; rows with equal ids are ordered by a hash of their text (equal
rows are interchangeable), so a repeated id can be dealt over several tasks.
An empty table writes files without rows.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import append_columns, slices

END_ID = 1
MARK = "\x01"
# A Latin letter (one that normalising and lower case leave one letter) and one of these are never in one token: such
# tokenizers part letters from other characters first.  Not so the apostrophe of contractions and what special tokens
# are written with.
WORD_END, PARTED = r"""([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{17F}])([!"#$%&()*+,\-./:;=>?@\[\]^_`{}~])""", r"\1 \2"
CACHE, CACHE_IDS = 1_000_000, 4_000_000  # pieces of text between white space that a task remembers, and ids of them in all

@lru_cache(4)
def _tokenizer(spec: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(spec)


class _Numbers(dict):
    """Numbers new keys in order and lists them."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, key):
        self[key] = n = len(self)
        self.new.append(key)
        return n


class Encoder:
    """Encodes whole texts through the ids of their parts between ASCII white space and after words.

    White space never takes part in a token of this kind of tokenizer (its
    normaliser makes every run one space and its pre-tokenizer drops it), so
    the ids of a text are those of its parts; a part that repeats is encoded
    once.  New parts go to the tokenizer many at a time.  Parts of letters are
    one word each, whose last token bears the vocabulary's end-of-word mark;
    between other parts stands a control character whose own id parts the
    result.  Whenever such a count does not come out, parts go one by one.
    """

    def __init__(self, spec: str):
        self.tokenizer = _tokenizer(spec)
        mark = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.mark_id = mark[0] if len(mark) == 1 else -1
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.is_end = np.zeros(self.tokenizer.get_vocab_size() + 1, dtype=bool)
        if suffix:
            self.is_end[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        added = pa.array([t.content for t in self.tokenizer.get_added_tokens_decoder().values()], pa.string())
        self.parted = not pc.any(pc.match_substring_regex(added, WORD_END)).as_py()
        self._forget()

    def _forget(self) -> None:
        self.number = _Numbers()
        self.pool, self.first, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _encoded(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.int32)

    def _together(self, parts: list[str], words: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts, concatenated, and the number of each part's ids."""
        joined = (" " if words else f" {MARK} ").join(parts)
        ids = self._encoded(joined)
        if words:
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) == len(parts) and ends[-1] == len(ids):
                return ids, np.diff(ends, prepend=0)
        elif self.mark_id >= 0 and joined.count(MARK) == len(parts) - 1:
            marks = ids == self.mark_id
            cuts = np.flatnonzero(marks)
            return ids[~marks], np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1
        each = [self._encoded(p) for p in parts]
        return np.concatenate(each), np.array([len(x) for x in each], dtype=np.int64)

    def _learn(self, parts: list[str]) -> None:
        kinds: tuple = ([], [])
        for i, p in enumerate(parts):
            kinds[p.isalpha()].append(i)
        first, size, pool, have = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64), [self.pool], len(self.pool)
        for words, places in enumerate(kinds):
            for a in range(0, len(places), 1000):
                some = places[a:a + 1000]
                ids, n = self._together([parts[i] for i in some], bool(words))
                first[some], size[some] = have + np.cumsum(n) - n, n
                pool.append(ids)
                have += len(ids)
        self.first, self.size, self.pool = np.concatenate([self.first, first]), np.concatenate([self.size, size]), np.concatenate(pool)

    def ids(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, concatenated, each followed by ``end``; and the number of ids of each."""
        if len(self.number) > CACHE or len(self.pool) > CACHE_IDS:
            self._forget()
        texts = pc.fill_null(texts, "")
        rows = pc.ascii_split_whitespace(pc.replace_substring_regex(texts, WORD_END, PARTED) if self.parted else texts)
        parts = rows.flatten().dictionary_encode()
        number = self.number
        known = np.fromiter(map(number.__getitem__, parts.dictionary.to_pylist()), dtype=np.int64, count=len(parts.dictionary))
        if number.new:
            self._learn(number.new)
            number.new = []
        parts = known[parts.indices.to_numpy()]
        size = self.size[parts]
        sums = np.concatenate([[0], np.cumsum(size)])
        flat = self.pool[np.repeat(self.first[parts] - sums[:-1], size) + np.arange(sums[-1])]
        ends = sums[np.cumsum(rows.value_lengths().to_numpy())]
        n = np.diff(np.concatenate([[0], ends]))
        return (flat, n) if end is None else (np.insert(flat, ends, end), n + 1)


@lru_cache(2)
def _encoder(spec: str) -> Encoder:
    """One for the Python worker, whose next tasks go on with the parts it knows."""
    return Encoder(spec)


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, stride: int = 1000, stripe_bytes: int = 16 << 20) -> None:
    """ORC files of (part, doc_id, at, n_tokens, ids) under ``path``, in ascending order of the id."""
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = "part int, doc_id bigint, at bigint, n_tokens int, ids array<int>"

    def tokenize(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        encoder, at = _encoder(spec.value), 0
        for batch in batches:
            for rows in slices(batch, 1, 4 << 20):
                flat, n = encoder.ids(rows.column(1), end_id)
                ends = np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(2), rows.column(0), pa.array(at + ends - n), pa.array(n, pa.int32()),
                     pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(flat))],
                    names=["part", "doc_id", "at", "n_tokens", "ids"])
                at += int(n.sum())

    ordered = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = ordered.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")) \
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")) \
        .withColumn("part", F.spark_partition_id())
    ordered.mapInArrow(tokenize, schema).write.mode("errorifexists") \
        .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01") \
        .option("orc.create.index", "true").option("orc.row.index.stride", stride) \
        .option("orc.stripe.size", stripe_bytes).option("compression", "zstd").orc(path)


def read_tokens(spark: SparkSession, path: str, ids: list[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids): start counts the ids of all documents before.  ``ids``: only those documents
    (the filter reaches the stripes' statistics, row indexes and Bloom filters)."""
    files = spark.read.schema("part int, doc_id bigint, at bigint, n_tokens int, ids array<int>").orc(path)
    sums = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    base = sums.select("part", F.coalesce(before, F.lit(0)).alias("base"))  # a row for each part
    if ids is not None:
        files = files.where(F.col("doc_id").isin(ids))
    return files.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"),
                                                        F.col("n_tokens").cast("bigint").alias("n_tokens"), "ids")


def token_digests(tokens: DataFrame) -> DataFrame:
    """``tokens`` without the ids but with ids_crc32, of the ids as little-endian unsigned 32-bit integers."""
    def start():
        def work(ids):
            flat, cuts = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4"), np.concatenate([[0], np.cumsum(
                ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).tolist()
            return [pa.array([zlib.crc32(flat[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])], pa.int64())]
        return work

    return append_columns(tokens, ["ids"], [("ids_crc32", "bigint")], start, "ids", keep=["doc_id", "start", "n_tokens"])
