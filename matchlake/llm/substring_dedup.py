"""Removal of repeated byte strings with a family of sparse suffix arrays.

A byte goes if a string of ``length`` bytes that covers it also starts
anywhere else in the corpus.  Strings are judged on the input and never cross
documents.

Sparse suffixes: of every window of ``length`` bytes the anchor is the position
whose next ``GRAM`` bytes have the least hash (the leftmost of equals).  It
depends on the window's bytes alone, so equal windows have equal anchors, and
about one position in 70 is one.  Consecutive windows with one anchor make a
region; an entry of the suffix array is (hash of the anchor's bytes, hash of
the region's bytes), together 128 bits.

Index family: documents come in batches.  A batch's entries are sorted, and
scanned together with the levels that exist; equal-sized levels are merged, so
an entry is rewritten logarithmically often.  Anchors that meet are the
candidates, all other entries are done with.  A family with a folder keeps its
levels there, with the place of one holder of each region, so that a later call
takes its documents as a new batch and finds what repeats earlier ones.

Long matches: a region that occurs twice is repeated whole.  Regions that
differ while their anchors agree can still share windows (at the ends of a
match, or at edits).  Of each different one a single copy is compared.  Up to
``GROUP`` regions of an anchor are compared byte by byte to either side of it.
More are parted by what lies beside the anchor (a window holds half of its
bytes to the right of it or more than half to the left) and compared by runs of
``RUN`` windows, counted from the anchor: equal runs are one content, and only
runs of different contents are told window by window.  So rows are regions and
runs, never pairs, and an edit costs the windows of the one run that it ends in.

Each document is addressed by (id, hash of id and text), so null or repeated
ids do no harm.  Counts are partially aggregated and joined back from stored
tables, so an anchor or region that a third of all documents share is spread by
the skew join; what is gathered per document is bounded by the document.  The
joins that would shuffle all texts or entries pass Spark's runtime Bloom filter
first, of at most ``common.FILTER_BITS`` bits; on larger corpora it lets more rows
through, never fewer than belong.

Defined cases: null text is empty; text shorter than ``length`` loses nothing;
equal documents of ``length`` bytes or more are removed whole, repeated rows
included.  Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import append_columns, bloom_filters, mix64, slices, store
from .decontaminate import merged

LENGTH, GRAM, BATCHES, GROUP, RUN = 200, 48, 4, 32, 16
STARTS = 1 << 21            # windows that are looked at together
LOW = np.uint64((1 << 24) - 1)
MASK = (1 << 64) - 1


def _byte_values() -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _gram_hashes(b: np.ndarray) -> np.ndarray:
    """A hash of the GRAM = 32 + 16 bytes at each position, by doubling."""
    h = _byte_values()[b]
    step, factor = 1, np.uint64(0xD6E8FEB86659FD93)
    sixteen = None
    while step < 32:
        h = h[:-step] * factor + h[step:]
        factor = factor * factor + np.uint64(2)
        step *= 2
        if step == 16:
            sixteen = h
    return mix64(h[:len(h) - 16] * factor + sixteen[32:])


def regions(buffer: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each region of one document: first window start, number of windows, anchor's place in it, anchor's hash."""
    n = len(buffer) - length + 1
    empty = np.zeros(0, dtype=np.int64)
    if n <= 0:
        return empty, empty, empty, empty
    data = np.frombuffer(buffer, dtype=np.uint8)
    firsts, anchors, hashes = [], [], []
    span = length - GRAM + 1            # grams of a window
    with np.errstate(over="ignore"):
        for at in range(0, n, STARTS):
            m = min(STARTS, n - at)
            h = _gram_hashes(data[at:at + m + length - 1])
            least = (h & ~LOW) | np.arange(len(h), dtype=np.uint64)
            width = 1
            while 2 * width <= span:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            if width < span:
                least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
            anchor = (least & LOW).astype(np.int64)
            new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
            firsts.append(new + at)
            anchors.append(anchor[new] + at)
            hashes.append(h[anchor[new]])
    first, anchor, gram = np.concatenate(firsts), np.concatenate(anchors), np.concatenate(hashes)
    new = np.concatenate([[True], anchor[1:] != anchor[:-1]])
    first, anchor, gram = first[new], anchor[new], gram[new]
    return first, np.diff(first, append=n), anchor - first, gram.view(np.int64)


def _signed(x: int | None) -> int | None:
    return None if x is None else x - (1 << 64) if x >> 63 else x


def _bytes_of(scalar) -> bytes:
    text = scalar.as_py()
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def sides(first: np.ndarray, count: np.ndarray, lead: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Regions parted by the side on which their windows hold half of their bytes: first, count, lead, and the bytes
    that tell the side, from a to b."""
    back = length - length // 2 + 1
    left = np.clip(lead - back + 1, 0, count)
    right = count - left
    at = first + lead
    order = np.argsort(np.concatenate([np.arange(len(first)), np.arange(len(first)) + 0.5]), kind="stable")
    cols = [np.concatenate(pair)[order] for pair in ((first, first + left), (left, right), (lead, lead - left), (at - back, at), (at + GRAM, at + length // 2))]
    held = cols[1] > 0
    return tuple(c[held] for c in cols)


def suffix_entries(keyed: DataFrame, length: int = LENGTH) -> DataFrame:
    """(id, th, first, count, lead, gram, region) of every region of ``keyed`` (id, th, text)."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, 2):
                rows, cols = [], [[], [], [], [], []]
                for i in range(part.num_rows):
                    raw = _bytes_of(part.column(2)[i])
                    first, count, lead, gram = regions(raw, length)
                    if len(first):
                        digest, end = xxhash.xxh3_64_intdigest, first + count - 1 + length
                        region = np.array([digest(raw[a:b]) for a, b in zip(first.tolist(), end.tolist())], dtype=np.uint64).view(np.int64)
                        for c, x in zip(cols, (first, count, lead, gram, region)):
                            c.append(x)
                        rows.append(np.full(len(first), i))
                if rows:
                    take = pa.array(np.concatenate(rows))
                    first, count, lead, gram, region = map(np.concatenate, cols)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(take), part.column(1).take(take), pa.array(first, pa.int32()), pa.array(count, pa.int32()),
                         pa.array(lead, pa.int32()), pa.array(gram), pa.array(region)],
                        names=["id", "th", "first", "count", "lead", "gram", "region"])

    return keyed.mapInArrow(run, "id bigint, th bigint, first int, count int, lead int, gram bigint, region bigint")


class LevelFamily:
    """Sorted runs of entries, one row for each of ``keys`` with the number of its entries; equal-sized runs are merged,
    so there are logarithmically many.

    With a ``root`` the runs are kept there, and a row has the place of one entry (``at``); a family that is opened
    on the folder again goes on with them.  A call that dies leaves the family as it was: which runs are in it is
    appended to its list last.
    """

    HOLDER = ("id", "th", "first", "count", "lead")

    def __init__(self, spark: SparkSession | None = None, root: str | None = None):
        self.root, self.version = root, 0
        self.keys = ["gram"] if root is None else ["gram", "region"]
        self.levels: list[tuple[int, DataFrame]] = []
        if root is not None:
            self.paths: dict[int, str] = {}
            runs = self._list(spark).groupBy("version").agg(F.collect_list(F.struct("rank", "path")).alias("runs")).orderBy(F.desc("version")).first()
            if runs:
                self.version, self.paths = runs["version"], {r["rank"]: r["path"] for r in runs["runs"]}
                self.levels = [(rank, spark.read.schema(self.SCHEMA).parquet(self.paths[rank])) for rank in sorted(self.paths, reverse=True)]

    SCHEMA = "gram bigint, region bigint, n bigint, at struct<id:bigint,th:bigint,first:int,count:int,lead:int>"
    LISTED = "version bigint, rank int, path string"

    def _list(self, spark: SparkSession) -> DataFrame:
        spark.createDataFrame([], self.LISTED).write.mode("append").parquet(f"{self.root}/runs")     # an empty family is a family
        return spark.read.schema(self.LISTED).parquet(f"{self.root}/runs")

    def _run(self, entries: DataFrame) -> DataFrame:
        one = entries.select(*self.keys, F.lit(1).cast("bigint").alias("n"), *([] if self.root is None else [F.struct(*self.HOLDER).alias("at")]))
        return one if self.root is None else self._scan(one)

    def _scan(self, runs: DataFrame) -> DataFrame:
        return runs.groupBy(*self.keys).agg(F.sum("n").alias("n"), *([] if self.root is None else [F.min("at").alias("at")]))

    def add(self, entries: DataFrame) -> None:
        """Sort a batch's entries, scan them with the equal-sized levels, and keep the merged run."""
        run, rank = self._run(entries), 0
        while self.levels and self.levels[-1][0] == rank:
            run, rank = run.unionByName(self.levels.pop()[1]), rank + 1
        run = self._scan(run)
        if self.root is None:
            self.levels.append((rank, store(run.sortWithinPartitions("gram"), "level")))
            return
        spark, path = entries.sparkSession, f"{self.root}/run-{uuid.uuid4().hex}"
        run.repartition("gram").sortWithinPartitions("gram", "region").write.parquet(path)
        self.levels.append((rank, spark.read.schema(self.SCHEMA).parquet(path)))
        self.version += 1
        self.paths = {r: p for r, p in self.paths.items() if r > rank} | {rank: path}
        spark.createDataFrame([(self.version, r, p) for r, p in self.paths.items()], self.LISTED).coalesce(1).write.mode("append").parquet(f"{self.root}/runs")

    def _all(self, last: DataFrame | None = None) -> DataFrame | None:
        runs = [level for _, level in self.levels] + ([] if last is None else [self._run(last)])
        out = runs[0] if runs else None
        for r in runs[1:]:
            out = out.unionByName(r)
        return out

    def matches(self, last: DataFrame | None = None) -> DataFrame:
        """(gram, n) of the entries that meet in a scan of all levels and the last batch."""
        return self._all(last).groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1")

    def holders(self, grams: DataFrame) -> DataFrame:
        """(gram, region, n, at): what the kept levels have of ``grams``."""
        return self._scan(self._all().join(grams, "gram"))


def shared_spans(group: list[dict], length: int) -> list[list[tuple[int, int]]]:
    """For each of the different regions around one anchor (lead, count, bytes): the spans of its windows that
    another one holds too, from common bytes to the left and right of the anchor."""
    out: list[list[tuple[int, int]]] = [[] for _ in group]
    parts = [(g["bytes"][:g["lead"]], g["bytes"][g["lead"]:]) for g in group]
    for i, (left, right) in enumerate(parts):
        for j in range(i):
            other = parts[j]
            n = min(len(left), len(other[0]))
            x = int.from_bytes(left[len(left) - n:], "little") ^ int.from_bytes(other[0][len(other[0]) - n:], "little")
            back = n - (x.bit_length() + 7) // 8
            n = min(len(right), len(other[1]))
            x = int.from_bytes(right[:n], "big") ^ int.from_bytes(other[1][:n], "big")
            on = n - (x.bit_length() + 7) // 8
            if back + on >= length:
                for k in (i, j):
                    lead = group[k]["lead"]
                    out[k].append((lead - back, lead + on))
    return out


def _shared_windows(keyed: DataFrame, classes: DataFrame, length: int) -> DataFrame:
    """(gram, region, spans): of regions that occur once, what they share with other regions of their anchor
    (spans from the region's start)."""
    several = store(classes.groupBy("gram").agg(F.count(F.lit(1)).alias("rivals")).where("rivals > 1"), "anchors")
    contested = classes.join(several, "gram")
    place = F.struct("at.first", "at.count", "at.lead", "gram", "region", F.col("rivals") <= GROUP)
    per_document = store(contested.groupBy("at.id", "at.th").agg(F.collect_list(place).alias("places"))
                         .withColumn("n", F.size("places")), "contested")

    def expand(batches):
        digest = xxhash.xxh3_64_intdigest

        def runs(raw, first, count, lead, gram, region):
            """Runs of windows, counted from the anchor and parted by the side on which they hold half of their bytes."""
            for at, n, to, a, b in zip(*(x.tolist() for x in sides(*(np.array([v]) for v in (first, count, lead)), length))):
                side = digest(raw[a:b], gram & MASK ^ int(a < at + to))
                for run in range((to - n + 1) // RUN, to // RUN + 1):
                    x, y = at + max(to - run * RUN - RUN + 1, 0), at + min(to - run * RUN, n - 1)
                    yield (gram, region, None, None, None, side, run, x - first, digest(raw[x:y + length], at + to - x),
                           [digest(raw[k:k + length], side) for k in range(x, y + 1)])

        for batch in batches:
            for part in slices(batch, 0):
                for i in range(part.num_rows):
                    raw = _bytes_of(part.column(0)[i])
                    rows: list[tuple] = []
                    for p in part.column(1)[i].as_py():
                        first, count, lead, gram, region, few = p.values()
                        if few:
                            rows.append((gram, region, lead, count, raw[first:first + count - 1 + length], None, None, None, None, None))
                        else:
                            rows += runs(raw, first, count, lead, gram, region)
                    cols = list(zip(*rows))
                    windows = pa.array([None if w is None else [_signed(x) for x in w] for w in cols[9]], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.int32()),
                         pa.array(cols[4], pa.binary()), pa.array([_signed(x) for x in cols[5]], pa.int64()), pa.array(cols[6], pa.int32()),
                         pa.array(cols[7], pa.int32()), pa.array([_signed(x) for x in cols[8]], pa.int64()), windows],
                        names=["gram", "region", "lead", "count", "bytes", "side", "run", "start", "whole", "windows"])

    same = (keyed["th"] == per_document["th"]) & keyed["id"].eqNullSafe(per_document["id"])
    with bloom_filters(keyed.sparkSession):
        pieces = store(keyed.join(per_document.where("n > 0"), same).select("text", "places").mapInArrow(
            expand, "gram bigint, region bigint, lead int, count int, bytes binary, side bigint, run int, start int, whole bigint, windows array<bigint>"),
            "pieces")

    def compare(batches):
        for batch in batches:
            rows: list[tuple] = []
            for gram, group in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # equal rows of the table give a region twice
                group = list({g["region"]: g for g in group}.values())
                for g, spans in zip(group, shared_spans(group, length)):
                    if spans:
                        rows.append((gram, g["region"], [{"start": a, "end": b} for a, b in merged(spans)]))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                              pa.array([r[2] for r in rows], SPANS)], names=["gram", "region", "spans"])

    few = pieces.where("bytes is not null").groupBy("gram").agg(F.collect_list(F.struct("region", "lead", "count", "bytes")).alias("group")) \
        .mapInArrow(compare, f"gram bigint, region bigint, spans {SPANS_DDL}")
    runs = pieces.where("bytes is null").select("gram", "region", "side", "run", "start", "whole", "windows")
    # equal runs are one content; a content of several regions is shared whole
    contents = store(runs.groupBy("side", "run", "whole").agg(F.min("region").alias("x"), F.max("region").alias("y"), F.first("windows").alias("windows"))
                     .withColumn("shared", F.col("x") != F.col("y")).drop("x", "y"), "contents")
    # single windows are told only where the contents of one run differ
    differ = contents.groupBy("side", "run").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("side", "run")
    windows = contents.join(differ, ["side", "run"]).select("side", "whole", F.explode("windows").alias("window"))
    windows = windows.groupBy("side", "window").agg(F.min("whole").alias("x"), F.max("whole").alias("y")).where("x != y").select("side", "window")
    windows = store(windows, "shared-windows")
    whole = store(contents.where("shared").select("side", "run", "whole"), "shared-runs")
    alone = store(contents.where("not shared").select("side", "run", "whole"), "single-runs")
    shared = runs.join(whole, ["side", "run", "whole"]).select("gram", "region", "start", F.size("windows").alias("n"))
    single = runs.join(alone, ["side", "run", "whole"]).select("gram", "region", "start", "side", F.posexplode("windows").alias("k", "window")) \
        .join(windows, ["side", "window"]).select("gram", "region", (F.col("start") + F.col("k")).alias("start"), F.lit(1).alias("n"))
    span = F.struct("start", (F.col("start") + F.col("n") - 1 + length).alias("end"))
    many = shared.unionByName(single).groupBy("gram", "region").agg(F.collect_set(span).alias("spans"))
    return few.unionByName(many)


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
SPANS_DDL = "array<struct<start:int,end:int>>"


def repeated_spans(keyed: DataFrame, length: int, batches: int, kept: LevelFamily | None = None, earlier: DataFrame | None = None) -> DataFrame:
    """(id, th, spans): what is repeated in each document of ``keyed`` (id, th, text); spans may overlap."""
    spark = keyed.sparkSession
    entries = store(suffix_entries(keyed, length), "suffixes")
    if kept is None:
        family = LevelFamily()
        parts = [entries.where(F.pmod("th", F.lit(batches)) == b) for b in range(batches)]
        for batch in parts[:-1]:
            family.add(batch)
        matches = store(family.matches(parts[-1]).select("gram"), "matches")
    else:
        matches = store(kept.matches(entries).select("gram"), "matches")
    with bloom_filters(spark):
        candidates = store(entries.join(matches, "gram"), "candidates")
    classes = candidates.groupBy("gram", "region").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "th", "first", "count", "lead")).alias("at"))
    if kept is not None and kept.levels:
        classes = classes.unionByName(kept.holders(matches)).groupBy("gram", "region").agg(F.sum("n").alias("n"), F.min("at").alias("at"))
    classes = store(classes, "regions")
    partial = _shared_windows(keyed if earlier is None else keyed.unionByName(earlier), classes, length)
    # a region that occurs twice is covered whole, whatever its windows share with others
    covered = classes.join(partial, ["gram", "region"], "left").where("n > 1 or spans is not null") \
        .select("gram", "region", F.when(F.col("n") == 1, F.col("spans")).alias("spans"))
    covered = store(covered, "covered")     # stored, so that the skew join can split what meets it
    whole = F.array(F.struct(F.lit(0).alias("start"), (F.col("count") - 1 + length).alias("end")))
    moved = F.transform(F.coalesce("spans", whole), lambda x: F.struct((F.col("first") + x["start"]).alias("start"), (F.col("first") + x["end"]).alias("end")))
    spans = candidates.join(covered, ["gram", "region"]).select("id", "th", moved.alias("s")) \
        .groupBy("id", "th").agg(F.flatten(F.collect_set("s")).alias("found"))
    if kept is not None:
        spans = store(spans, "found")
        kept.add(entries)
    return spans


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text, F.col(id_col)).alias("th"), text.alias("text"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, batches: int = BATCHES,
                   keep_text: bool = False, family: str | None = None, earlier: DataFrame | None = None) -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept_sha256, spans array<struct<start,end>>[, kept string]) per row;
    ``kept`` may hold cut characters, so it is binary.

    With ``family``, the folder of a kept index, ``docs`` are its next batch: they are judged against themselves and all
    earlier batches, whose documents are ``earlier`` (only texts that a match has to be told from are read again).
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} or more")
    keyed = _keyed(docs, id_col, text_col)
    kept = None if family is None else LevelFamily(docs.sparkSession, family)
    before = None if earlier is None else _keyed(earlier, id_col, text_col)
    spans = store(repeated_spans(keyed, length, batches, kept, before).withColumn("n", F.size("found")), "spans")
    same = (keyed["th"] == spans["th"]) & keyed["id"].eqNullSafe(spans["id"])

    def start():
        def work(text, found):
            cols: list[list] = [[] for _ in range(6)]
            for i in range(len(text)):
                raw = _bytes_of(text[i])
                cut = merged([(x["start"], x["end"]) for x in found[i].as_py()])
                at, kept = 0, []
                for a, b in cut:
                    kept.append(raw[at:a])
                    at = b
                kept = b"".join([*kept, raw[at:]])
                for c, v in zip(cols, (len(raw), len(raw) - len(kept), len(cut), hashlib.sha256(kept).hexdigest(),
                                       [{"start": a, "end": b} for a, b in cut], kept if keep_text else None)):
                    c.append(v)
            return [*[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string()), pa.array(cols[4], SPANS),
                    *([pa.array(cols[5], pa.binary())] if keep_text else [])]
        return work

    fields = [("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string"),
              ("spans", SPANS_DDL), *([("kept", "binary")] if keep_text else [])]
    with bloom_filters(docs.sparkSession):
        cut = keyed.join(spans.where("n > 0"), same).select(keyed["id"], "text", "found")
        cut = store(append_columns(cut, ["text", "found"], fields, start, "text", keep=["id"]), "cut")
    # the rest is told from the text where it stands; it moves only if its text has to be given back
    raw = F.col("text").cast("binary")
    zero = F.lit(0).cast("bigint")
    plain = keyed.select("id", "th", F.octet_length("text").cast("bigint").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
                         F.sha2(raw, 256).alias("kept_sha256"), F.array().cast(SPANS_DDL).alias("spans"), *([raw.alias("kept")] if keep_text else []))
    rest = plain.join(spans.select(F.col("id").alias("_id"), F.col("th").alias("_th")),
                      (F.col("th") == F.col("_th")) & F.col("id").eqNullSafe(F.col("_id")), "left_anti").drop("th")
    return cut.unionByName(rest).withColumnRenamed("id", id_col)
