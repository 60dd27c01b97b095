"""Chat formatting with collapse of cumulative snapshots.

A log often holds a conversation several times, each time with some more
turns.  Turns are numbered within their conversation; the rolling hash of a
prefix is the exclusive-or of two 64-bit hashes of (place, digest) over its
turns, so prefixes of any length come from running totals.  A conversation
whose whole hash equals a prefix hash of a longer one is a snapshot of it;
anti-joins drop these, and of equal conversations the one with the smallest id
stays.  The maximal conversations are rendered with role markers.

Turns are digested first, and texts come back only to be rendered.  Numbering
and running hashes are computed per block of turn numbers and then
offset by the totals of the blocks before, and long conversations are rendered
in parts of ``part_turns`` turns, so no conversation has to fit in one task.
Prefixes are counted per (length, hash), and a count above that of the
conversations that end there says that a longer one goes on; so a first turn
that very many conversations share is one row in the anti-join.

Defined cases: exactly repeated rows count once; turns that tie are ordered by
the digest of role and text; null role or text is kept apart from the empty
string in hashes and rendered as empty; a null turn comes first.  Rows with
null conversation id are one conversation like any other.  Empty tables give
empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import store

BLOCK_TURNS = 256
PART_TURNS = 256
BEGIN, END = "<|im_start|>", "<|im_end|>"


def _digest(role: str, text: str):
    """128 bits of a turn's role and text; null is not the empty string."""
    def told(c):
        return F.concat(F.when(F.col(c).isNull(), "0").otherwise("1"), F.coalesce(F.col(c), F.lit("")))
    return F.md5(F.concat(told(role), F.lit("\n"), told(text)))


def numbered(turns: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """(conv, turn, d, place, h1, h2) of ``turns`` (conv, turn, d): place from 1; h1 and h2 are the rolling hashes up
    to this turn."""
    rows = turns.select("conv", "turn", "d").distinct().withColumn("block", F.floor(F.col("turn") / block_turns))
    inside = Window.partitionBy("conv", "block")
    rows = rows.withColumn("nth", F.row_number().over(inside.orderBy(F.col("turn").asc_nulls_first(), "d")))
    sizes = rows.groupBy("conv", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy(F.col("block").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0)))
    same = _same(rows, sizes, "conv", "block")
    placed = rows.join(sizes.drop("n"), same).drop(sizes["conv"]).drop(sizes["block"]).withColumn("place", F.col("skip") + F.col("nth"))
    hashed = store(placed.select("conv", "block", "turn", "d", "place", F.xxhash64(F.lit(1), "place", "d").alias("t1"),
                                 F.xxhash64(F.lit(2), "place", "d").alias("t2")), "turns")
    totals = hashed.groupBy("conv", "block").agg(F.bit_xor("t1").alias("b1"), F.bit_xor("t2").alias("b2"))
    for c in ("b1", "b2"):
        totals = totals.withColumn(c, F.coalesce(F.bit_xor(c).over(before), F.lit(0)))
    upto = inside.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rolled = hashed.withColumn("r1", F.bit_xor("t1").over(upto)).withColumn("r2", F.bit_xor("t2").over(upto))
    out = rolled.join(totals, _same(rolled, totals, "conv", "block")).drop(totals["conv"]).drop(totals["block"])
    return out.select("conv", "turn", "d", "place", F.col("r1").bitwiseXOR(F.col("b1")).alias("h1"),
                      F.col("r2").bitwiseXOR(F.col("b2")).alias("h2"))


def _same(a: DataFrame, b: DataFrame, *names: str):
    """Equality of the named columns, null equal to null."""
    on = None
    for n in names:
        one = a[n].eqNullSafe(b[n])
        on = one if on is None else on & one
    return on


def maximal(places: DataFrame) -> DataFrame:
    """(conv, n_turns, n_copies): conversations that no other one continues; ``places`` as from ``numbered``.

    n_copies counts equal conversations, itself included.
    """
    keys = ["n_turns", "h1", "h2"]
    whole = places.groupBy("conv").agg(F.max(F.struct(F.col("place").alias("n_turns"), "h1", "h2")).alias("e"))
    ends = store(whole.groupBy("e").agg(F.min("conv").alias("conv"), F.count("*").alias("n_copies")).select("e.*", "conv", "n_copies"), "conversations")
    prefixes = store(places.groupBy(F.col("place").alias("n_turns"), "h1", "h2").agg(F.count("*").alias("n_with")), "prefixes")
    # prefixes that more conversations have than end with them
    continued = ends.join(prefixes, keys).where("n_with > n_copies").select(*keys)
    return ends.join(continued, keys, "left_anti").select("conv", "n_turns", "n_copies")


def render(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           part_turns: int = PART_TURNS, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """(id_col, part, n_turns, n_copies, text): the maximal conversations; the texts of a conversation's parts in
    order (from 0) make the whole, most have part 0 only."""
    rows = turns.select(F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                        F.col(text_col).alias("text")).withColumn("d", _digest("role", "text"))
    places = store(numbered(rows, block_turns), "places")
    kept = store(maximal(places), "maximal")     # stored, so that the skew join can split a long conversation
    shown = store(places.join(kept, _same(places, kept, "conv")).drop(kept["conv"]).drop("h1", "h2"), "shown")
    line = F.concat(F.lit(BEGIN), F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(END + "\n"))
    rows = rows.join(shown, _same(rows, shown, "conv", "turn", "d")).drop(shown["conv"]).drop(shown["turn"]).drop(shown["d"]) \
        .withColumn("part", F.floor((F.col("place") - 1) / part_turns))
    parts = rows.groupBy("conv", "part").agg(
        F.first("n_turns").alias("n_turns"), F.first("n_copies").alias("n_copies"),
        F.array_sort(F.collect_set(F.struct("place", line.alias("line")))).alias("lines"))
    text = F.array_join(F.transform("lines", lambda x: x["line"]), "")
    return parts.select(F.col("conv").alias(id_col), "part", "n_turns", "n_copies", text.alias("text"))
