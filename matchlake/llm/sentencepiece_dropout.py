"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding.

A piece vocabulary (a ``.model`` file of the sentencepiece library, BPE with
byte fallback, identity normalisation) gives merges ordered by score.  The
agenda of a text holds every pair of neighbouring symbols whose join is a
piece; the best-scored (then leftmost) pair is merged until none is left.  A
candidate is skipped for good when a keyed hash of (seed, document, start,
end of the joined span) falls under ``dropout``, so another seed gives other
segmentations of the same text, and the same seed always the same one on any
number of executors.  ``dropout=0`` equals the library's own encoding.

White space runs never merge with the text before them in such vocabularies
(checked when the tables are built), so a text falls into chunks; the agendas
of all chunks of a batch advance together, one merge per chunk and round, in
numpy.  Chunks over 63 symbols have their own heap.

Defined cases: null or empty text -> no ids, decoded to the empty text.
Characters outside the vocabulary, and U+2581 itself (which the vocabulary
uses for the space), become byte pieces, so every text decodes to itself.
Rows are independent: repeated rows, ties and null ids need nothing special.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .common import append_columns, code_points, mix64, texts_of

SPACE = "▁"
WIDTHS = (4, 8, 12, 16, 24, 32, 63)  # columns of the padded agendas
NONE = np.int32(2**31 - 1)
SLOTS = 1 << 20
STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Tables:
    """Arrays built from a piece model; a few MB, sent to the tasks as one broadcast value."""
    of_char: np.ndarray     # code point -> piece id, or -1
    keys: np.ndarray        # open-addressing table of pairs: left << 32 | right
    joined: np.ndarray      # its values: the joined piece's id
    rank: np.ndarray        # piece id -> place in the order of merges
    by_rank: np.ndarray
    byte_id: np.ndarray     # byte -> piece id
    surface: list           # piece id -> bytes it decodes to


def _slot(key: np.ndarray) -> np.ndarray:
    return ((key.astype(np.uint64) * STEP) >> np.uint64(44)).astype(np.int64)


def load_tables(model_file: str) -> Tables:
    """Read a BPE ``.model`` with the sentencepiece library."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = sp.get_piece_size()
    text = [sp.id_to_piece(i) for i in range(n)]
    special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in range(n)]
    normal = {t: i for i, t in enumerate(text) if not special[i]}
    if any(a != SPACE and b == SPACE for t in normal for a, b in zip(t, t[1:])):
        raise ValueError("a piece holds a space after other text: chunks would not be independent")
    byte_id = np.full(256, -1, dtype=np.int32)
    for i, t in enumerate(text):
        if sp.is_byte(i):
            byte_id[int(t[3:5], 16)] = i
    if (byte_id < 0).any():
        raise ValueError("the vocabulary has no byte fallback")
    of_char = np.full(0x110000, -1, dtype=np.int32)
    for t, i in normal.items():
        if len(t) == 1:
            of_char[ord(t)] = i
    of_char[0x20], of_char[ord(SPACE)] = normal[SPACE], -1
    order = sorted(range(n), key=lambda i: -sp.get_score(i))
    by_rank = np.array(order, dtype=np.int32)
    rank = np.empty(n, dtype=np.int32)
    rank[by_rank] = np.arange(n, dtype=np.int32)
    keys, joined = np.full(SLOTS, -1, dtype=np.int64), np.zeros(SLOTS, dtype=np.int32)
    pairs = [(normal[t[:k]] << 32 | normal[t[k:]], i) for t, i in normal.items() for k in range(1, len(t))
             if t[:k] in normal and t[k:] in normal]
    for at, (key, i) in zip(_slot(np.array([k for k, _ in pairs], dtype=np.int64)).tolist(), pairs):
        while keys[at] != -1:
            at = (at + 1) % SLOTS
        keys[at], joined[at] = key, i
    surface = [bytes([int(t[3:5], 16)]) if sp.is_byte(i) else b"" if special[i] else t.replace(SPACE, " ").encode()
               for i, t in enumerate(text)]
    return Tables(of_char, keys, joined, rank, by_rank, byte_id, surface)


def _join(tab: Tables, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The joined piece of each pair, or -1."""
    key = (left.astype(np.int64) << 32) | right.astype(np.int64)
    at = _slot(key)
    got = tab.keys[at]
    out = np.where(got == key, tab.joined[at], -1)
    todo = np.flatnonzero((got != key) & (got != -1))
    while len(todo):
        at[todo] = (at[todo] + 1) % SLOTS
        got = tab.keys[at[todo]]
        hit = got == key[todo]
        out[todo[hit]] = tab.joined[at[todo[hit]]]
        todo = todo[~hit & (got != -1)]
    return out


def _kept(salt: np.ndarray, start: np.ndarray, end: np.ndarray, threshold: int) -> np.ndarray:
    """Whether candidates (salted span starts and ends inside the text) escape the dropout."""
    h = mix64(salt + start.astype(np.uint64) * STEP + (end - start).astype(np.uint64))
    return (h >> np.uint64(11)) >= np.uint64(threshold)


def encode_texts(texts: list[str], salts: np.ndarray, tab: Tables, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, concatenated, and the n + 1 offsets.  ``salts``: a uint64 of each text (seed and document)."""
    filled = [i for i, t in enumerate(texts) if t]
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    if not filled:
        return np.zeros(0, dtype=np.int32), offsets
    cps, begins = code_points([texts[i] for i in filled], " ")  # the separator is the space that stands before a text
    n = len(cps)
    sym = tab.of_char[cps]
    space, unknown = cps == 0x20, sym < 0
    first = np.zeros(n, dtype=bool)          # of a chunk
    first[begins[:-1]] = True
    first[1:] |= (space[1:] & ~space[:-1]) | unknown[1:] | unknown[:-1]
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, n))
    doc = np.repeat(np.arange(len(filled)), np.diff(begins))
    # the span's start inside the text counts in the hash: position * STEP less what the text's begin adds
    salted = (salts[np.array(filled)] - begins[:-1].astype(np.uint64) * STEP)[doc]
    threshold = int(dropout * 2**53)
    idx = np.arange(n)
    nxt, prv, end = idx + 1, idx - 1, idx + 1
    alive = np.ones(n, dtype=bool)
    key = np.full(n, NONE, dtype=np.int32)   # of the candidate that starts here: rank << 6 | column
    column = np.minimum(idx - np.repeat(starts, lengths), 63).astype(np.int32)
    last = np.append(first[1:], True)        # the last symbol of a chunk has no right neighbour

    def candidates(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        made = _join(tab, sym.take(left), sym.take(right))
        out = np.full(len(left), NONE)
        ok = np.flatnonzero(made >= 0)
        left = left.take(ok)
        if threshold:
            free = _kept(salted.take(left), left, end.take(right.take(ok)), threshold)
            ok, left = ok[free], left[free]
        out[ok] = (tab.rank.take(made.take(ok)) << 6) | column.take(left)
        return out

    pairs = np.flatnonzero(~last)
    for a in range(0, len(pairs), 1 << 20):
        p = pairs[a:a + (1 << 20)]
        key[p] = candidates(p, p + 1)
    low = 1
    for width in WIDTHS:
        of = (lengths > low) & (lengths <= width)
        low = width
        at, size = starts[of], lengths[of]
        if not len(at):
            continue
        cols = np.arange(width)
        grid = np.where(cols < size[:, None], key[np.minimum(at[:, None] + cols, n - 1)], NONE)
        flat, rows = grid.reshape(-1), np.arange(len(at))
        while len(rows):
            best = grid.take(rows, axis=0).min(axis=1)
            go = best < NONE
            rows, best = rows[go], best[go]
            if not len(rows):
                break
            base = at.take(rows)
            p = base + (best & 63)
            q = nxt.take(p)
            sym[p] = tab.by_rank.take(best >> 6)
            alive[q] = False
            end[p] = nxt[p] = r = nxt.take(q)   # where the next symbol starts
            cell = rows * width - base          # + a position: its cell in the flat grid
            flat[cell + p] = NONE
            flat[cell + q] = NONE
            after = np.flatnonzero(r < base + size.take(rows))
            front = np.flatnonzero(p > base)
            prv[r[after]] = p[after]
            left = np.concatenate([p[after], prv.take(p[front])])
            right = np.concatenate([r[after], p[front]])
            flat[np.concatenate([cell[after], cell[front]]) + left] = candidates(left, right)
    for a, size in zip(starts[lengths > WIDTHS[-1]].tolist(), lengths[lengths > WIDTHS[-1]].tolist()):
        _agenda(a, a + size, sym, alive, salted[a], tab, threshold)

    count = alive.astype(np.int64)
    odd = np.flatnonzero(unknown)
    points = cps[odd]
    count[odd] = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    where = np.concatenate([[0], np.cumsum(count)])
    ids = np.repeat(sym, count)
    for point in np.unique(points).tolist():
        for k, byte in enumerate(chr(point).encode("utf-8", "surrogatepass")):
            ids[where[odd[points == point]] + k] = tab.byte_id[byte]
    sizes = np.zeros(len(texts), dtype=np.int64)
    sizes[filled] = np.diff(where[begins])
    offsets[1:] = np.cumsum(sizes)
    return ids, offsets


def _agenda(a: int, b: int, sym, alive, salt, tab: Tables, threshold: int) -> None:
    """The agenda of one long chunk [a, b) as a heap; writes sym and alive."""
    ids = sym[a:b].tolist()
    n = b - a
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    ends = list(range(1, n + 1))

    def push(lefts: list[int]) -> None:
        if not lefts:
            return
        left = np.array(lefts)
        right = np.array([nxt[i] for i in lefts])
        made = _join(tab, np.array([ids[i] for i in lefts]), np.array([ids[nxt[i]] for i in lefts]))
        ok = made >= 0
        if threshold:
            to = np.array([ends[i] for i in right.tolist()])
            ok &= _kept(np.full(len(left), salt, dtype=np.uint64), left + a, to + a, threshold)
        for i, j, m in zip(left[ok].tolist(), right[ok].tolist(), made[ok].tolist()):
            heapq.heappush(heap, (int(tab.rank[m]), i, j, ids[i], ids[j], m))

    heap: list = []
    dead = [False] * n
    push(list(range(n - 1)))
    while heap:
        _, i, j, x, y, m = heapq.heappop(heap)
        if dead[i] or dead[j] or nxt[i] != j or ids[i] != x or ids[j] != y:
            continue
        ids[i], dead[j], ends[i], nxt[i] = m, True, ends[j], nxt[j]
        if nxt[i] < n:
            prv[nxt[i]] = i
        push([k for k in (prv[i], i) if k >= 0 and nxt[k] < n])
    sym[a:b] = ids
    alive[a:b] = ~np.array(dead)


def decode_ids(ids: np.ndarray, tab: Tables) -> str:
    """The text of one encoding: surfaces and bytes joined, without the space put before the text."""
    return b"".join([tab.surface[i] for i in ids.tolist()])[1:].decode("utf-8", "surrogatepass")


def _salts(keys: list, seed: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest("" if k is None else str(k), seed) for k in keys], dtype=np.uint64)


SLICE = 400_000  # bytes of text that advance together: small enough for the cache


def encode(docs: DataFrame, model_file: str, dropout: float = 0.1, seed: int = 1, id_col: str = "doc_id",
           text_col: str = "text", ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``docs`` plus ``ids_col`` array<int>; the id column keys the dropout."""
    tab = docs.sparkSession.sparkContext.broadcast(load_tables(model_file))

    def start():
        def work(key, text):
            texts = texts_of(text)
            ids, offsets = encode_texts(texts, _salts(key.to_pylist(), seed), tab.value, dropout)
            return [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))]
        return work

    return append_columns(docs, [id_col, text_col], [(ids_col, "array<int>")], start, text_col, SLICE, keep)


def decode(encoded: DataFrame, model_file: str, ids_col: str = "ids", text_col: str = "decoded",
           keep: list[str] | None = None) -> DataFrame:
    """``encoded`` plus the decoded text; null ids give the empty text."""
    tab = encoded.sparkSession.sparkContext.broadcast(load_tables(model_file))

    def start():
        def work(ids):
            return [pa.array([decode_ids(np.array(x or [], dtype=np.int64), tab.value) for x in ids.to_pylist()], pa.string())]
        return work

    return append_columns(encoded, [ids_col], [(text_col, "string")], start, ids_col, keep=keep)


def round_trip(docs: DataFrame, model_file: str, dropout: float = 0.1, seed: int = 1, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Encode, decode and compare each text in one pass: id, n_chars, n_tokens, ids_crc32
    (of the ids as little-endian unsigned 32-bit integers), decoded_sha256 and lossless."""
    tab = docs.sparkSession.sparkContext.broadcast(load_tables(model_file))
    fields = [("n_chars", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint"),
              ("decoded_sha256", "string"), ("lossless", "boolean")]

    def start():
        def work(key, text):
            texts = texts_of(text)
            ids, offsets = encode_texts(texts, _salts(key.to_pylist(), seed), tab.value, dropout)
            raw = ids.astype("<u4")
            crc, sha, same = [], [], []
            for i, t in enumerate(texts):
                a, b = offsets[i], offsets[i + 1]
                back = decode_ids(ids[a:b], tab.value)
                crc.append(zlib.crc32(raw[a:b].tobytes()))
                sha.append(hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest())
                same.append(back == t)
            return [pa.array([len(t) for t in texts], pa.int64()), pa.array(np.diff(offsets)),
                    pa.array(crc, pa.int64()), pa.array(sha), pa.array(same)]
        return work

    return append_columns(docs, [id_col, text_col], fields, start, text_col, SLICE, [id_col])
