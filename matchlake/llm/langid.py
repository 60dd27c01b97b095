"""Language identification of mixed-language text.

Learning: letter n-grams (2 and 3 letters, word bounds included) of a bounded
sample of labelled documents are counted by Spark in hashed buckets per
language; the model is a table of smoothed log probabilities.  For each
language the scripts that make up at least ``SCRIPT_SHARE`` of its letters are
kept as well.

Prediction: the script of each word (by code-point ranges) narrows the
languages it can be of; its n-grams give a score per language, bounded to
``WORD_BOUND`` either way; Viterbi over the words with a penalty for every
switch labels the text with spans of one language.  The language that holds
most letters is the prediction.  The score is the share of all letters that
stand in its words and are known: in a script that some learned language uses,
and with n-grams whose log probability in some language is above chance (one
bucket in ``BUCKETS``) by at least ``KNOWN_SHARE`` of what is usual for the text
that was learned from.  So texts in other languages, and noise, get a learned
label and a low score.

Defined cases: null text or text without a letter (Unicode category L) ->
``und``, score 0, no spans.  Ties go to the language that sorts first.  Words
in a script that no learned language uses fit all languages alike.  With no
labelled rows everything is ``und``.  Rows are independent, so repeated rows
and null ids need nothing special (rows with null id or label teach nothing).
"""

from __future__ import annotations

import sys
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import append_columns, code_points, crc_mod, mix64, slices, texts_of

BUCKETS = 1 << 17
SCRIPT_SHARE = 0.01
WORD_BOUND = 8.0
SWITCH_PENALTY = 20.0
KNOWN_SHARE = 0.25
FAR = -1e4  # for a language that the word's script excludes
UNDETERMINED = "und"
SLICE = 1 << 19  # bytes of text that are looked at together; bounds a task's memory

# First and last code point of blocks with letters, by script (Unicode).
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FA1F)],
}


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each code point: is it a letter; its lower case (one letter); its script (0: none of the list)."""
    n = sys.maxunicode + 1
    letter = np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(n)), dtype=bool, count=n)
    lower = np.arange(n, dtype=np.uint32)
    for c in np.flatnonzero(letter).tolist():
        s = chr(c).lower()
        if len(s) == 1:
            lower[c] = ord(s)
    script = np.zeros(n, dtype=np.uint8)
    for k, ranges in enumerate(SCRIPTS.values(), 1):
        for a, b in ranges:
            script[a:b + 1] = k
    return letter, lower, script


@dataclass
class Model:
    languages: list          # sorted
    table: np.ndarray        # bucket x language: log probability less the languages' mean
    allowed: np.ndarray      # script x language; script 0 fits all, a row of False is a script none of them uses
    chance: np.ndarray       # bucket: the languages' mean, less the log probability of a bucket by chance
    usual: np.ndarray        # language: what an n-gram learned from is above chance, on average


@dataclass
class Words:
    """Words of a batch of texts: first and end position, text number, script, and n-gram buckets."""
    first: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    script: np.ndarray
    grams: np.ndarray        # buckets in order of position: two at each letter and two at each word's end
    gram_first: np.ndarray   # of each word
    begins: np.ndarray


def _words(texts: list[str]) -> Words:
    letter, lower, script = _tables()
    cps, begins = code_points(texts, "\n")
    cps = np.append(cps, np.uint32(10))
    is_letter = letter[cps]
    code = np.where(is_letter, lower[cps], 0).astype(np.uint64)
    edge = np.diff(is_letter.astype(np.int8))
    first, end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    at = np.flatnonzero(is_letter[1:] | is_letter[:-1]) + 1     # letters, and the position after each word
    one, two = code[at - 1], code[np.maximum(at - 2, 0)] * is_letter[at - 1]
    pair = (one << np.uint64(21)) | code[at]
    both = np.empty((len(at), 2), dtype=np.int64)
    both[:, 0] = mix64(pair) >> np.uint64(47)
    both[:, 1] = mix64((two << np.uint64(42)) ^ pair ^ np.uint64(1 << 63)) >> np.uint64(47)
    return Words(first, end, np.searchsorted(begins, first, side="right") - 1, script[cps[first]], both.reshape(-1),
                 2 * np.searchsorted(at, first), begins)


def learn(docs: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id",
          sample_docs: int = 3000, seed: int = 7) -> Model:
    """Fit on about ``sample_docs`` documents of each language (all, if there are fewer).

    The sample is a keyed hash of the id column, so it is the same on every
    run; only its n-gram counts (languages x ``BUCKETS`` at most) and one
    count per language reach the driver.
    """
    labelled = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).alias("lang")) \
        .where("id is not null and text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.ones((len(SCRIPTS) + 1, 0), dtype=bool), np.zeros(BUCKETS), np.zeros(0))
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, sample_docs / sizes[k]))])
    taken = labelled.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)
    number = {k: i for i, k in enumerate(languages)}

    def count(batches):
        grams = np.zeros((len(languages), BUCKETS), dtype=np.int64)
        letters = np.zeros((len(languages), len(SCRIPTS) + 1), dtype=np.int64)
        for batch in batches:
            for part in slices(batch, 0, SLICE):
                w = _words(part.column(0).to_pylist())
                if not len(w.first):
                    continue
                lang = np.array([number[k] for k in part.column(1).to_pylist()])
                of_word = lang[w.doc]
                of_gram = np.repeat(of_word, np.diff(np.append(w.gram_first, len(w.grams))))
                np.add.at(grams, (of_gram, w.grams), 1)
                np.add.at(letters, (of_word, w.script), w.end - w.first)
        for kind, counts in enumerate((grams, letters)):
            i, j = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), kind), pa.int32()), pa.array(i, pa.int32()),
                                              pa.array(j, pa.int32()), pa.array(counts[i, j])], names=["kind", "lang", "at", "n"])

    counted = taken.select("text", "lang").mapInArrow(count, "kind int, lang int, at int, n bigint") \
        .groupBy("kind", "lang", "at").agg(F.sum("n").alias("n")).toPandas()
    grams = np.zeros((BUCKETS, len(languages)))
    letters = np.zeros((len(SCRIPTS) + 1, len(languages)))
    for kind, to in ((0, grams), (1, letters)):
        c = counted[counted["kind"] == kind]
        to[c["at"].to_numpy(), c["lang"].to_numpy()] = c["n"].to_numpy()
    log = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * BUCKETS))
    allowed = letters >= np.maximum(1, SCRIPT_SHARE * letters.sum(axis=0))
    allowed[0] = True
    mean = log.mean(axis=1, keepdims=True)
    usual = (grams * (log + np.log(BUCKETS))).sum(axis=0) / np.maximum(grams.sum(axis=0), 1)
    return Model(languages, (log - mean).astype(np.float32), allowed, (mean[:, 0] + np.log(BUCKETS)).astype(np.float32), usual)


def _viterbi(score: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each row of ``score`` (words x languages); a switch costs ``penalty``."""
    n, k = score.shape
    stay = np.empty((n, k), dtype=bool)
    source = np.zeros(n, dtype=np.int64)
    total = score[0].copy()
    for t in range(1, n):
        best = int(total.argmax())
        jump = total[best] - penalty
        np.greater_equal(total, jump, out=stay[t])
        source[t] = best
        np.maximum(total, jump, out=total)
        total += score[t]
    path = np.empty(n, dtype=np.int64)
    at = int(total.argmax())
    for t in range(n - 1, 0, -1):
        path[t] = at
        if not stay[t, at]:
            at = int(source[t])
    path[0] = at
    return path


def label_words(words: Words, model: Model, n_docs: int, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """The language number of every word.

    A text stays in its best language if no run of words gains more than one
    penalty elsewhere (the largest gain of any run, from running sums); only
    the other texts need the dynamic programme.
    """
    score = np.add.reduceat(model.table[words.grams], words.gram_first, axis=0).astype(np.float64)
    np.clip(score, -WORD_BOUND, WORD_BOUND, out=score)
    fits = model.allowed[words.script]
    score[~fits] = FAR
    score[~fits.any(axis=1)] = 0.0
    label = np.empty(len(score), dtype=np.int64)
    cuts = np.searchsorted(words.doc, np.arange(n_docs + 1))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if a == b:
            continue
        s = score[a:b]
        best = int(s.sum(axis=0).argmax())
        label[a:b] = best
        if s.shape[1] > 1:
            gain = np.delete(s, best, axis=1).max(axis=1) - s[:, best]
            run = np.concatenate([[0.0], np.cumsum(gain)])
            if (run - np.minimum.accumulate(run)).max() > penalty:
                label[a:b] = _viterbi(s, penalty)
    return label


def known_words(words: Words, model: Model) -> np.ndarray:
    """Which words some language whose script they are in makes clearly more probable than chance does."""
    score = np.add.reduceat(model.table[words.grams], words.gram_first, axis=0)
    score += np.add.reduceat(model.chance[words.grams], words.gram_first)[:, None]
    size = np.diff(np.append(words.gram_first, len(words.grams)))
    return ((score > KNOWN_SHARE * size[:, None] * model.usual) & model.allowed[words.script]).any(axis=1)


def identify(docs: DataFrame, model: Model, text_col: str = "text", penalty: float = SWITCH_PENALTY,
             keep: list[str] | None = None) -> DataFrame:
    """``docs`` plus lang_pred string, score double and spans array<struct<start,end,lang>> (code points, end
    exclusive; a span runs from its first word's start to its last word's end)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    span = "array<struct<start:int,end:int,lang:string>>"
    arrow_span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def start():
        m = sent.value

        def work(text):
            texts = texts_of(text)
            lang, score, spans = [UNDETERMINED] * len(texts), np.zeros(len(texts)), [[] for _ in texts]
            w = _words(texts)
            if len(w.first) and m.languages:
                label = label_words(w, m, len(texts), penalty)
                letters = np.zeros((len(texts), len(m.languages)), dtype=np.int64)
                np.add.at(letters, (w.doc, label), w.end - w.first)
                some = np.flatnonzero(letters.sum(axis=1))
                top = letters.argmax(axis=1)
                sure = known_words(w, m) & (label == top[w.doc])
                known = np.bincount(w.doc, weights=(w.end - w.first) * sure, minlength=len(texts))
                score[some] = known[some] / letters[some].sum(axis=1)
                for i in some.tolist():
                    lang[i] = m.languages[top[i]]
                new = np.append(True, (np.diff(w.doc) != 0) | (np.diff(label) != 0))
                a = np.flatnonzero(new)
                b = np.append(a[1:], len(label)) - 1
                base = w.begins[w.doc[a]] + 1
                for d, x, y, k in zip(w.doc[a].tolist(), (w.first[a] - base).tolist(), (w.end[b] - base).tolist(), label[a].tolist()):
                    spans[d].append({"start": x, "end": y, "lang": m.languages[k]})
            return [pa.array(lang), pa.array(score), pa.array(spans, arrow_span)]
        return work

    return append_columns(docs, [text_col], [("lang_pred", "string"), ("score", "double"), ("spans", span)], start,
                          text_col, SLICE, keep)


def held_out(id_col: str = "doc_id"):
    """True for the documents that are not learned from (crc32 of the id's text modulo 3 is 1); null id: false."""
    return F.coalesce(crc_mod(F.col(id_col), 3) == 1, F.lit(False))
