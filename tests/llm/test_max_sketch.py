"""Ranked lexical search (operator 11) against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_fixtures import SF, docs_rows, none, odd  # noqa: F401
from pyspark.sql import functions as F

from matchlake.llm import max_sketch as ms
from matchlake.llm import queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return Counter(TERM.findall((text or "").translate(LOWER)))


def brute(docs, items, k=20):
    """(item_id, rank, doc_id, score) of all documents' scores."""
    counts = [(d, terms(t)) for d, t in docs]
    N, L = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, t in set(items):
        asked.setdefault(i, Counter()).update(terms(t))
    out = []
    for i, q in asked.items():
        scores = []
        for d, c in counts:
            m = 75 + 25 * sum(c.values()) * N // L if L else 75
            score = sum(n * math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
                        for t, n in q.items() if t in c)
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out += [(i, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")


def searched(spark, docs, items, **how):
    d, i = frames(spark, docs, items)
    return result(ms.search(ms.build(d), d, i, **how))


def test_documents_of_the_table(spark, docs_rows):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = result(queries.op11_max_sketch(spark, SF))
    assert got == brute(docs_rows, items) and len(got) == 20 * len(items)


@pytest.mark.parametrize("how", [{}, {"block_terms": 8, "block_items": 2}, {"k": 3}])
def test_ties_copies_repeats_and_blocks(spark, how):
    rng = random.Random(11)
    words = [f"t{k}" for k in range(60)] + ["ÉTÉ", "été", "日本", "Ab", "aB", "a_b"]
    docs = [(rng.randrange(300), " ".join(rng.choice(words) for _ in range(rng.randrange(1, 90)))) for _ in range(200)]
    docs += [(500 + k, "tie tie one") for k in range(30)] + [(None, "tie one"), (None, None), (7, ""), (8, "!!! ..."), (9, "tie " * 2000)]
    docs += [docs[3]] * 5
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 25)))) for k in range(12)]
    items += [(50, "tie"), (50, "tie"), (51, "tie tie one"), (52, None), (53, ""), (54, "nowhere"), (55, "t1"), (55, "t2 t1"), (None, "tie t5")]
    assert searched(spark, docs, items, **how) == brute(docs, items, how.get("k", 20))


def test_bounds_are_never_below_scores(monkeypatch):
    """Narrow sketches, so that most terms share cells."""
    monkeypatch.setattr(ms, "LOAD", 0.25)
    rng = random.Random(4)
    words = [f"w{k}".encode() for k in range(400)]
    for _ in range(20):
        count = Counter(rng.choice(words) for _ in range(rng.randrange(1, 3000)))
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in count], dtype=np.uint64)
        raw = ms.sketch(hashes, np.array(list(count.values())))
        rows = np.frombuffer(raw, dtype=np.uint8).reshape(ms.ROWS, -1)
        least = np.min([r[c] for r, c in zip(rows, ms.cells_of(hashes, rows.shape[1]))], axis=0)
        assert all(x >= min(n, 255) for x, n in zip(least, count.values()))


def test_narrow_sketches_find_the_same(spark, docs_rows, monkeypatch):
    items = [(1, docs_rows[5][1][:200]), (2, "the of and")]
    want = brute(docs_rows, items)
    monkeypatch.setattr(ms, "LOAD", 0.125)
    d, i = frames(spark, docs_rows, items)
    assert result(ms.search(ms.build(d), d, i)) == want


def test_other_names_and_types(spark):
    docs = spark.createDataFrame([(1, "alpha beta", "x"), (2, "beta", "y")], "key bigint, body string, item string")
    items = spark.createDataFrame([("q", "Beta alpha")], "item string, words string")
    got = ms.search(ms.build(docs, "key", "body"), docs, items, id_col="key", text_col="body", item_col="item", item_text_col="words").collect()
    assert [(r["item"], r["rank"], r["key"]) for r in got] == [("q", 1, 1), ("q", 2, 2)]


def test_odd_rows_and_no_rows(spark, odd, none):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    items = [(1, "word tail same TEXT"), (2, "日本語")]
    i = spark.createDataFrame(items, "item_id bigint, text string").withColumn("id", F.lit(1)).withColumn("score", F.lit("x"))
    assert result(ms.search(ms.build(odd), odd, i)) == brute(docs, items)
    assert result(ms.search(ms.build(none), none, i)) == []
    assert result(ms.search(ms.build(odd), odd, i.where("false"))) == []
