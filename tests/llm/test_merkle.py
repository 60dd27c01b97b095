"""Merkle manifest (operator 12) against trees built node by node."""

import hashlib
import zlib

import duckdb
import pytest
from llm_fixtures import SF, none, odd  # noqa: F401
from pyspark.sql import functions as F

from matchlake.llm import merkle, queries

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id bigint, source string, lang string, n_chars int, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def told(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(level):
    levels = [level]
    while len(level) > 1:
        level = [h(*level[i:i + 2]) for i in range(0, len(level), 2)]
        levels.append(level)
    return levels


def climb(levels, i, x):
    siblings = []
    for level in levels[:-1]:
        pair = level[i // 2 * 2:i // 2 * 2 + 2]
        others = [p for k, p in enumerate(pair) if k != i % 2]
        siblings += others
        pair[i % 2] = x
        x, i = h(*pair), i // 2
    return siblings, x


def brute(rows):
    groups = {}
    for d, source, lang, n, text in rows:
        leaf = h(*map(told, (d, source, lang, n, text)))
        off = d is not None and n is not None and zlib.crc32(str(d).encode()) % 7 == 0
        claim = h(*map(told, (d, source, lang, n + 1, text))) if off else leaf
        groups.setdefault(lang, []).append((d is not None, d or 0, leaf, claim))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g])]) for g in order}
    top = tree([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, (known, d, leaf, claim) in enumerate(sorted(groups[g])):
            low, x = climb(trees[g], i, claim)
            high, x = climb(top, k, x)
            out.append((d if known else None, leaf, trees[g][-1][0], top[-1][0], h(*low, *high), x, x == top[-1][0]))
    return sorted(out, key=repr)


def audited(spark, rows, tmp_path):
    path = str(tmp_path / "sf")
    spark.createDataFrame(rows, SCHEMA).write.mode("overwrite").parquet(path + "/documents.parquet")
    return sorted((tuple(r) for r in queries.op12_merkle(spark, path).collect()), key=repr)


def test_documents_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(*FIELDS).collect()]
    df = queries.op12_merkle(spark, SF)
    got = sorted((tuple(r) for r in df.collect()), key=repr)
    assert got == brute(rows) and {r[-1] for r in got} == {True, False}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    found = con.execute(queries.ORACLES["op12_merkle"])
    assert [c[0] for c in found.description] == df.columns and sorted(found.fetchall(), key=repr) == got


@pytest.mark.parametrize("band", [1, 3, 8])
def test_groups_of_all_sizes(spark, tmp_path, monkeypatch, band):
    monkeypatch.setattr(merkle, "BAND", band)
    sizes = {None: 5, "": 1, "de": 2, "en": 70, "fr": 3, "日本": 16, "é": 17, "ar": 33, "z": 64}
    rows = [(1000 * k + i, None if i % 5 == 0 else f"s{i}", g, None if i % 4 == 0 else i, None if i % 3 == 0 else "té" * (i % 2) * i)
            for k, (g, n) in enumerate(sizes.items()) for i in range(n)]
    assert audited(spark, rows, tmp_path) == brute(rows)


def test_null_and_shared_ids_and_repeated_rows(spark, tmp_path):
    rows = [(None, "a", "en", 1, "x"), (None, None, None, None, None), (7, "a", "en", 1, "x"), (7, "a", "en", 2, "y"), (7, "a", "en", 1, "x"),
            (-3, "", "en", 0, ""), (13, "a", None, 1, "x")] + [(9, "same", "en", 3, "same")] * 40
    assert audited(spark, rows, tmp_path) == brute(rows)


def test_one_row_and_no_rows(spark, tmp_path):
    rows = [(13, "a", "en", 1, "long " * 100_000)]
    assert audited(spark, rows, tmp_path) == brute(rows)
    assert audited(spark, [], tmp_path) == []


def test_nodes_cover_nested_intervals(spark, odd):
    made = merkle.build(odd, ["doc_id", "lang", "text"], "lang", "doc_id")
    nodes = {}
    for r in made.nodes.collect():
        nodes.setdefault(r["group"], {})[r["level"], r["lo"], r["hi"]] = r["digest"]
    for group, of in nodes.items():
        n = max(hi for _, _, hi in of)
        for (level, lo, hi), digest in of.items():
            assert hi == min(lo + (1 << level), n)
            below = sorted(k for k in of if k[0] == level - 1 and lo <= k[1] and k[2] <= hi)
            assert not level or digest == h(*[of[k] for k in below])
    proofs = made.proofs.select("*", merkle.folded("leaf").alias("back")).collect()
    assert len(proofs) == odd.count() and all(r["back"] == r["root"] for r in proofs)


def test_clashing_names(spark, odd, none):
    extra = odd.select("*", *[F.lit("x").alias(n) for n in ("g", "leaf", "claim", "rank", "root", "n", "h", "level", "salt", "id")])
    claim = merkle.leaf_digest(F.col("doc_id"), F.col("text"))
    got = merkle.audit(extra, claim, ["doc_id", "text"])
    assert got.count() == odd.count() and got.where("not verified").count() == 0
    assert merkle.audit(none, claim, ["doc_id", "text"]).count() == 0
