"""Benchmark decontamination: a prefix-filtered join of item windows with documents.

A window is ``window`` neighbouring words of a benchmark item (an item with
fewer words is one window).  The tokens of a window are ordered by rarity, the
number of documents that hold the word.  Exact containment needs every token,
so the prefix that must be joined is the rarest one alone: documents are
joined with windows on it, the place of the token in the window gives the
window's place in the document (positional bound), a window that would not fit
between the document's ends is passed over (length bound), and what is left is
compared word for word.  Every word inside an occurrence is hit.

The benchmark is the query set: its windows go to the tasks in blocks of at
most ``block_windows``, each a broadcast value of bounded size; the documents
stream past all blocks in one stage, unshuffled.  Word counts are taken over
all documents, for the benchmark's words only, and added up before the driver
sees one number per word.

Defined cases: null or empty text has no words.  A null item id counts as hit
but not as item.  Items that share an id are one item.  An empty benchmark
hits nothing.  Rows are independent; repeated rows and null ids need nothing.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append_columns, texts_of

# Digits, a-z and everything beyond ASCII make words, A-Z become a-z, the rest parts words.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
BLOCK_WINDOWS = 200_000


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def item_windows(words: list[bytes], window: int) -> list[tuple[bytes, ...]]:
    if len(words) <= window:
        return [tuple(words)] if words else []
    return [tuple(words[i:i + window]) for i in range(len(words) - window + 1)]


def document_frequency(docs: DataFrame, vocabulary: set, text_col: str = "text") -> dict:
    """In how many rows of ``docs`` each word of a bounded vocabulary occurs."""
    words = docs.sparkSession.sparkContext.broadcast(frozenset(vocabulary))

    def count(batches):
        of: dict = dict.fromkeys(words.value, 0)
        for batch in batches:
            for t in batch.column(0):
                for w in words.value.intersection(words_of(t.as_py())):
                    of[w] += 1
        some = [(w, n) for w, n in of.items() if n]
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.binary()), pa.array([n for _, n in some], pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(text_col)).mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {bytes(r["word"]): r["n"] for r in rows}


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", block_windows: int = BLOCK_WINDOWS, keep: list[str] | None = None) -> DataFrame:
    """``docs`` plus n_words, n_hit, n_items, items_sha256, contaminated, hits array<struct<first,end>> (word places)."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text")).toLocalIterator()

    def blocks():
        """Windows with their item ids, a block at a time; the driver holds one block."""
        now: dict = {}
        for item, text in items:
            for win in item_windows(words_of(text), window):
                now.setdefault(win, set()).add(item)
                if len(now) >= block_windows:
                    yield now
                    now = {}
        yield now

    hit_type = "array<struct<first:int,end:int>>"
    arrow_hits = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
    out = docs
    for b in blocks():
        if not b and out is not docs:
            continue
        frequency = document_frequency(docs, {w for win in b for w in win}, text_col) if b else {}
        index: dict = {}
        for win, ids in b.items():
            at = min(range(len(win)), key=lambda i: (frequency.get(win[i], 0), win[i], i))
            index.setdefault(win[at], []).append((at, win, sorted(i for i in ids if i is not None)))
        sent = spark.sparkContext.broadcast(index)
        first = out is docs

        def start(sent=sent, first=first):
            index = sent.value

            def work(text, *before):
                rows = {"words": [], "hits": [], "items": []}
                for k, t in enumerate(texts_of(text)):
                    words = words_of(t)
                    hits = [] if first else [(h["first"], h["end"]) for h in before[0][k].as_py()]
                    found = set() if first else set(before[1][k].as_py())
                    n = len(words)
                    for i in [i for i, w in enumerate(words) if w in index]:
                        for at, win, ids in index[words[i]]:
                            a = i - at
                            if a >= 0 and a + len(win) <= n and tuple(words[a:a + len(win)]) == win:
                                hits.append((a, a + len(win)))
                                found.update(ids)
                    rows["words"].append(n)
                    rows["hits"].append([{"first": a, "end": z} for a, z in merged(hits)])
                    rows["items"].append(sorted(found))
                return [pa.array(rows["words"], pa.int64()), pa.array(rows["hits"], arrow_hits), pa.array(rows["items"], pa.list_(pa.string()))]
            return work

        out = append_columns(out, [text_col] + ([] if first else ["hits", "items"]),
                             [("n_words", "bigint"), ("hits", hit_type), ("items", "array<string>")], start, text_col,
                             keep=None if keep is None else [*keep, text_col])
    hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda s, h: s + (h["end"] - h["first"]))
    n_hit, n_items = hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items")
    sha = F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256")
    new = ("n_words", "hits", "items", "n_hit", "n_items", "items_sha256", "contaminated")
    kept = [c for c in out.columns if c not in new and (keep is None or c in keep)]
    return out.select(*[F.col(f"`{c}`") for c in kept], "n_words", n_hit, n_items, sha, (F.size("hits") > 0).alias("contaminated"), "hits")


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans that do not touch or overlap, covering the same places."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out
