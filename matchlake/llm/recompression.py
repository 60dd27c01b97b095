"""Removal of long repeats between documents, found by recompression.

Words are runs of characters other than space and U+0009 to U+000D.  A window
is ``window`` neighbouring words of one document; a word goes if a window that
covers it also starts in a document with a smaller id.  Windows are judged on
the input.

Rounds: a document is a sequence of symbols, at first its words.  A round
joins runs of equal symbols, then pairs of neighbours of which the first is a
left and the second a right one; the side is a keyed bit of the symbol's name.
Only symbols of at most the round's number of words take part, so a symbol
stays short against the window.  A name is the digest of what is joined, so all
tasks give the same run or pair the same name and Spark's aggregates over names
are global.

Interior symbols: at each step the outermost symbols of a window that could be
joined with something outside are left off (a run at an end, a right symbol at
the start, a left one at the end), whatever stands there.  What remains is told
by the window's words alone, so equal windows hold equal symbols at equal
places.  A window is represented by the symbol of the least name hash (the
leftmost of equals) on the highest level on which something remains; half a
window of words to the right or left of its start is inside the window, and
verifies the symbol.  Consecutive windows with one representative and one such
side make a region, named by both.

Shared symbols: regions are counted in Spark per (name, digest of the region's
words); the smallest document of each is the one that keeps it, all others
lose it whole.  Different regions with a shared name can still share windows
(at the ends of a match, at edits): the windows of one copy of each are
compared by digest, and the smallest document of each window is taken back to
the regions that hold it.  Rows of one name are at most the windows that
stand around it, never pairs of them, and names, regions and windows that
very many documents share are aggregated before they are shuffled and joined
from stored tables, which the skew join splits.

Defined cases: null text has no words; a document with fewer words than the
window loses nothing.  Documents that share an id do not take words from each
other.  A row with null id is not compared: it loses nothing and takes nothing.
Repeated rows each give their row.  Empty tables give empty results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append_columns, bloom_filters, mix64, slices, store
from .decontaminate import merged

WINDOW = 50
#: Most words of a symbol that takes part, by round.
ACTIVE = (1, 1, 2, 2)
#: Regions whose windows are told together.
PLACES = 1 << 12
STEP = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def word_names(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def _join(names: np.ndarray, starts: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Joins symbols up to the next one that is ``new``: names and starts of the joined, and which one each went to."""
    first = np.flatnonzero(new)
    to = np.cumsum(new) - 1
    at = (np.arange(len(names)) - first[to]).astype(np.uint64)
    alone = np.diff(first, append=len(names)) == 1
    # a sum over (place, name) names what is joined; a symbol left alone keeps its name
    joined = mix64(np.add.reduceat(mix64(names + (at + np.uint64(1)) * STEP), first) ^ STEP)
    return np.where(alone, names[first], joined), starts[first], to


def _least(keys: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Place of the least of ``keys`` in each a <= place < b (the leftmost of equals)."""
    out = np.empty(len(a), dtype=np.int64)
    width = b - a
    best, size = np.arange(len(keys)), 1
    while True:
        now = (width >= size) & (width < 2 * size)
        if now.any():
            left, right = best[a[now]], best[b[now] - size]
            out[now] = np.where(keys[right] < keys[left], right, left)
        if not (width >= 2 * size).any():
            return out
        left, right = best[:-size], best[size:]
        best = np.where(keys[right] < keys[left], right, left)
        size *= 2


def representatives(names: np.ndarray, ends: np.ndarray, window: int = WINDOW, active: tuple[int, ...] = ACTIVE) -> tuple[np.ndarray, ...]:
    """For documents laid end to end (word names; ``ends`` of the documents): the places of all windows, and of each
    the place and the name of the symbol that represents it."""
    length = np.diff(ends, prepend=0)
    count = np.maximum(length - window + 1, 0)
    at = np.repeat(ends - length - (np.cumsum(count) - count), count) + np.arange(count.sum())
    symbol_at, symbol = np.empty(len(at), dtype=np.int64), np.empty(len(at), dtype=np.uint64)
    if not len(at):
        return at, symbol_at, symbol
    total = len(names)
    starts = np.arange(total)
    opens = np.zeros(total, dtype=bool)        # symbols that begin a document are never joined to what is before them
    opens[(ends - length)[length > 0]] = True
    todo = np.arange(len(at))
    i, j = at.copy(), at + window

    def settle(which: np.ndarray, i: np.ndarray, j: np.ndarray, level: int) -> None:
        if len(which):
            best = _least(mix64(names ^ np.uint64(level + 1)), i, j)
            symbol_at[which] = starts[best]
            symbol[which] = mix64(names[best] + np.uint64(level) * STEP)

    level = 0
    with np.errstate(over="ignore"):
        for n, most in enumerate(active):
            for pairs in (False, True):
                takes = np.diff(starts, append=total) <= most
                if pairs:
                    right = (mix64(names + np.uint64(n + 1) * STEP) & np.uint64(1)).astype(bool)
                    joins = takes[1:] & takes[:-1] & ~right[:-1] & right[1:]
                    before, after = takes & right, takes & ~right
                else:
                    joins = takes[1:] & (names[1:] == names[:-1])
                    before = after = takes
                new = np.concatenate([[True], ~joins]) | opens
                to = np.cumsum(new) - 1
                # what could be joined with something outside the window is left off
                i2, j2 = to[i] + before[i], to[j - 1] + 1 - after[j - 1]
                over = i2 >= j2
                settle(todo[over], i[over], j[over], level)
                todo, i, j = todo[~over], i2[~over], j2[~over]
                names, starts, _ = _join(names, starts, new)
                opens = opens[new]
                level += 1
                if not len(todo):
                    return at, symbol_at, symbol
        settle(todo, i, j, level)
    return at, symbol_at, symbol


FOUND = "id bigint, th bigint, first int, count int, name bigint, region bigint, n_words bigint, whole string"


def regions(keyed: DataFrame, window: int = WINDOW) -> DataFrame:
    """(id, th, first, count, name, region, n_words, whole): every region of ``keyed`` (id, th, text), and one row of
    each document with the number and the digest of its words (no region in it)."""
    def run(batches):
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for part in slices(batch, 2):
                whole, counts, rows, names = [], [], [], []
                for k in range(part.num_rows):
                    words = words_of(part.column(2)[k].as_py())
                    whole.append(hashlib.sha256(b" ".join(words)).hexdigest())
                    counts.append(len(words))
                    if len(words) >= window and part.column(0)[k].is_valid:
                        rows.append(k)
                        names.append(word_names(words))
                n = part.num_rows
                empty = pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *empty, pa.array(counts, pa.int64()), pa.array(whole, pa.string())],
                                                 names=["id", "th", "first", "count", "name", "region", "n_words", "whole"])
                if not rows:
                    continue
                ends = np.cumsum([len(x) for x in names])
                names = np.concatenate(names)
                at, symbol_at, symbol = representatives(names, ends, window)
                doc = np.searchsorted(ends, at, side="right")
                # a window holds half a window of words on one side of its symbol's start at least: that side names it
                onward = window // 2
                back = window - onward + 1
                left = symbol_at - at >= back
                new = np.flatnonzero(np.concatenate([[True], (symbol_at[1:] != symbol_at[:-1]) | (symbol[1:] != symbol[:-1])
                                                     | (doc[1:] != doc[:-1]) | (left[1:] != left[:-1])]))
                count = np.diff(new, append=len(at))
                first, doc, left, q = at[new], doc[new], left[new], symbol_at[new]
                raw = memoryview(names.tobytes())

                def told(a, b, seed=0):
                    return np.fromiter((digest(raw[x:y], seed) for x, y in zip((8 * a).tolist(), (8 * b).tolist())), dtype=np.uint64, count=len(a))
                side = told(np.where(left, q - back, q), np.where(left, q, q + onward), 1)
                name = mix64(side ^ mix64(symbol[new] + left))
                region = told(first, first + count - 1 + window)
                take = pa.array(np.array(rows)[doc])
                begin = np.concatenate([[0], ends])[doc]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), pa.array(first - begin, pa.int32()), pa.array(count, pa.int32()),
                     pa.array(name.view(np.int64)), pa.array(region.view(np.int64)), pa.nulls(len(new), pa.int64()), pa.nulls(len(new), pa.string())],
                    names=["id", "th", "first", "count", "name", "region", "n_words", "whole"])

    return keyed.mapInArrow(run, FOUND)


def _partly_shared(keyed: DataFrame, classes: DataFrame, window: int) -> DataFrame:
    """(name, region, starts): windows (counted from the region's start) that a region's own smallest document shares
    with a smaller one, by a region of other words around the same symbol."""
    several = classes.groupBy("name").agg(F.count(F.lit(1)).alias("rivals")).where("rivals > 1")
    contested = store(classes.join(store(several, "symbols"), "name"), "contested")
    # the regions of a document, as one row; their number is bounded by the document
    places = store(contested.groupBy("at.id", "at.th").agg(F.collect_list(F.struct("at.first", "at.count", "name", "region")).alias("places")), "places")

    def expand(batches):
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for part in slices(batch, 1):
                for k in range(part.num_rows):
                    raw = memoryview(word_names(words_of(part.column(1)[k].as_py())).tobytes())
                    held = [tuple(p.values()) for p in part.column(2)[k].as_py()]
                    for some in range(0, len(held), PLACES):
                        first, count, name, region = map(np.array, zip(*held[some:some + PLACES]))
                        start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                        at = 8 * (np.repeat(first, count) + start)
                        found = np.fromiter((digest(raw[x:x + 8 * window], 1) for x in at.tolist()), dtype=np.uint64, count=len(at))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(at), part.column(0)[k].as_py())), pa.array(np.repeat(name, count)), pa.array(np.repeat(region, count)),
                             pa.array(start, pa.int32()), pa.array(found.view(np.int64))], names=["id", "name", "region", "start", "window"])

    same = (keyed["th"] == places["th"]) & (keyed["id"] == places["id"])
    with bloom_filters(keyed.sparkSession):
        windows = store(keyed.join(places.where("size(places) > 0"), same).select(keyed["id"], "text", "places").mapInArrow(
            expand, "id bigint, name bigint, region bigint, start int, window bigint"), "windows")
    earliest = windows.groupBy("name", "window").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").drop("most")
    earliest = store(earliest, "earliest")      # stored, so that the skew join can split what meets it
    same = (windows["name"] == earliest["name"]) & (windows["window"] == earliest["window"]) & (windows["id"] > earliest["least"])
    return windows.join(earliest, same).groupBy(windows["name"], "region").agg(F.collect_set("start").alias("starts"))


def repeated_spans(keyed: DataFrame, found: DataFrame, window: int = WINDOW) -> DataFrame:
    """(id, th, found array<struct<start,end>>): word spans to remove from each document; spans may overlap."""
    entries = found.where("name is not null").select("id", "th", "first", "count", "name", "region")
    totals = entries.groupBy("name").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select("name")
    with bloom_filters(keyed.sparkSession):
        candidates = store(entries.join(store(totals, "shared"), "name"), "candidates")
    classes = store(candidates.groupBy("name", "region").agg(
        F.min(F.struct("id", "th", "first", "count")).alias("at"), F.max("id").alias("most")), "classes")
    partial = _partly_shared(keyed, classes, window)
    covered = classes.join(partial, ["name", "region"], "left").where("at.id < most or starts is not null") \
        .select("name", "region", F.col("at.id").alias("keeper"), "starts")
    covered = store(covered, "covered")
    whole = F.array(F.struct(F.col("first").alias("start"), (F.col("first") + F.col("count") - 1 + window).alias("end")))
    some = F.transform("starts", lambda x: F.struct((F.col("first") + x).alias("start"), (F.col("first") + x + window).alias("end")))
    same = (candidates["name"] == covered["name"]) & (candidates["region"] == covered["region"]) \
        & ((candidates["id"] > covered["keeper"]) | covered["starts"].isNotNull())
    return candidates.join(covered, same).select("id", "th", F.when(F.col("id") > F.col("keeper"), whole).otherwise(some).alias("s")) \
        .groupBy("id", "th").agg(F.flatten(F.collect_set("s")).alias("found"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, keep_text: bool = False) -> DataFrame:
    """(id_col, n_words, n_removed, kept_sha256[, spans array<struct<start,end>>, kept string]) per row; ``kept`` is the
    kept words joined by a space, spans are places of removed words."""
    if window < 2:
        raise ValueError("window must be 2 or more")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text, F.col(id_col)).alias("th"), text.alias("text"))
    found = store(regions(keyed, window), "regions")
    spans = store(repeated_spans(keyed, found, window), "spans")
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def start():
        def work(text, found):
            cols: list[list] = [[], [], [], []]
            for k in range(len(text)):
                words = words_of(text[k].as_py())
                cut = merged([(x["start"], x["end"]) for x in found[k].as_py()]) if found[k].is_valid else []
                at, kept = 0, []
                for a, b in cut:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                joined = b" ".join(kept)
                for c, v in zip(cols, (len(words) - len(kept), hashlib.sha256(joined).hexdigest(), [{"start": a, "end": b} for a, b in cut],
                                       joined.decode("utf-8", "surrogatepass") if keep_text else None)):
                    c.append(v)
            return [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()),
                    *([pa.array(cols[2], spans_type), pa.array(cols[3], pa.string())] if keep_text else [])]
        return work

    fields = [("n_removed", "bigint"), ("kept_sha256", "string"),
              *([("spans", "array<struct<start:int,end:int>>"), ("kept", "string")] if keep_text else [])]
    same = (keyed["th"] == spans["th"]) & keyed["id"].eqNullSafe(spans["id"])
    if keep_text:       # every text is given back
        rows = keyed.join(spans, same, "left").select(keyed["id"], keyed["th"], "text", "found")
        out = append_columns(rows, ["text", "found"], fields, start, "text", keep=["id", "th"])
        told = found.where("whole is not null").groupBy("id", "th").agg(F.first("n_words").alias("n_words"))
        back = (out["th"] == told["th"]) & out["id"].eqNullSafe(told["id"])
        return out.join(told, back).select(out["id"].alias(id_col), "n_words", *[n for n, _ in fields])
    with bloom_filters(docs.sparkSession):
        cut = keyed.join(spans.where("size(found) > 0"), same).select(keyed["id"], keyed["th"], "text", "found")
        cut = append_columns(cut, ["text", "found"], fields, start, "text", keep=["id", "th"])
        # repeated rows are cut alike; one of them tells
        cut = store(cut.groupBy("id", "th").agg(*[F.first(n).alias(n) for n, _ in fields]), "cut")
    rows = found.where("whole is not null").select("id", "th", "n_words", "whole")
    same = (rows["th"] == cut["th"]) & rows["id"].eqNullSafe(cut["id"])
    return rows.join(cut, same, "left").select(rows["id"].alias(id_col), "n_words", F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
                                               F.coalesce("kept_sha256", "whole").alias("kept_sha256"))
