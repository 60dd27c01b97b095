"""Row-wise and pair operators on documents, against brute force and on odd rows."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from brute import (contamination, dropout_encode, near_duplicates, personal, remove_repeats, simhash, token_rows)
from llm_fixtures import SF, docs_rows, none, odd  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from matchlake.llm import decontaminate, langid, queries, sanitize, sentencepiece_dropout, simhash as sim, substring_dedup, token_orc

PIECES, WORDS = queries.tokenizer_path("piece_bpe_32k.model"), queries.tokenizer_path("word_bpe_49k.json")


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture(scope="module")
def texts(docs_rows):
    random.seed(4)
    odd = ["", "a", "  two  spaces ", "x" * 300, "the" * 60, "日本語 😀 é", "a▁b", "\x00\n\n a", "".join(random.choice("theran ing") for _ in range(400))]
    return odd + [t[:600] for _, t in docs_rows[:40]]


def test_batches_of_python_workers_are_bounded(spark):
    from matchlake.llm.common import BATCH_BYTES, ship
    ship(spark)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])
    got = [r["n"] for r in spark.range(0, 9000, 1, 1).select(F.repeat(F.lit("x"), 4000).alias("text")).mapInArrow(sizes, "n long").collect()]
    assert sum(got) == 9000 and max(got) * 4000 <= BATCH_BYTES + 4000


# -- 1 ---------------------------------------------------------------------

def test_pieces_without_dropout_equal_the_library(texts):
    tab = sentencepiece_dropout.load_tables(PIECES)
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ids, off = sentencepiece_dropout.encode_texts(texts, np.zeros(len(texts), np.uint64), tab, 0.0)
    for i, t in enumerate(texts):
        if "▁" not in t:
            assert ids[off[i]:off[i + 1]].tolist() == sp.encode(t)


@pytest.mark.parametrize("dropout", [0.1, 0.6])
def test_dropout_equals_plain_agenda_and_decodes(texts, dropout):
    tab = sentencepiece_dropout.load_tables(PIECES)
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    salts = np.arange(len(texts), dtype=np.uint64) * np.uint64(977)
    ids, off = sentencepiece_dropout.encode_texts(texts, salts, tab, dropout)
    for i, t in enumerate(texts):
        def kept(a, b):
            return bool(sentencepiece_dropout._kept(salts[i:i + 1], np.array([a]), np.array([b]), int(dropout * 2**53))[0])
        got = ids[off[i]:off[i + 1]]
        assert got.tolist() == dropout_encode(t, salts[i], sp, dropout, kept), t[:40]
        assert sentencepiece_dropout.decode_ids(got, tab) == t


def test_seeds_differ_and_repeat(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one, again, two = (rows_of(sentencepiece_dropout.round_trip(docs, PIECES, 0.1, s), "doc_id", "ids_crc32") for s in (1, 1, 2))
    assert one == again and sum(a != b for a, b in zip(one, two)) > len(one) * 0.9


def test_round_trip_of_odd_rows(spark, odd, none):
    out = queries.round_trip(odd, PIECES).collect()
    assert len(out) == odd.count() and all(r["lossless"] for r in out)
    assert queries.round_trip(none, PIECES).count() == 0
    both = sentencepiece_dropout.decode(sentencepiece_dropout.encode(odd, PIECES), PIECES)
    assert [c for c in odd.columns if c != "ids"] == [c for c in both.columns if c not in ("ids", "decoded")]
    assert all(r["decoded"] == (r["text"] or "") for r in both.collect())


# -- 4 ---------------------------------------------------------------------

def test_language_accuracy_on_held_out(spark):
    d = "/root/testdata/sf0.01"
    out = queries.op4_language_id(spark, d).where("held_out").join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id")
    n, right = out.count(), out.where("lang = lang_pred").count()
    assert n > 200 and right / n >= 0.98
    assert out.where("score < 0 or score > 1").count() == 0


def test_labels_and_ids_are_no_input(spark, odd):
    model = langid.learn(spark.read.parquet(f"{SF}/documents.parquet"))
    a = rows_of(langid.identify(odd, model), "text", "lang_pred", "score")
    b = rows_of(langid.identify(odd.withColumn("lang", F.lit("xx")).withColumn("doc_id", F.lit(0)), model), "text", "lang_pred", "score")
    assert a == b
    for t, lang, score in a:
        assert (lang == "und" and score == 0) == (not any(c.isalpha() for c in t or ""))


def test_mixed_text_has_spans(spark, docs_rows):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.learn(docs)
    first = {r["lang"]: r["text"][:400] for r in docs.where("length(text) > 900 and lang in ('en', 'de')").collect()}
    text = f"{first['en']} {first['de']} {first['en']}"
    spans = langid.identify(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()["spans"]
    assert [s["lang"] for s in spans] == ["en", "de", "en"]
    assert abs(spans[1]["start"] - 400) < 60 and abs(spans[1]["end"] - 800) < 60


def test_viterbi_equals_all_paths():
    import itertools
    rng = np.random.default_rng(1)
    for _ in range(30):
        s = rng.normal(size=(6, 3)) * 3
        best = max(itertools.product(range(3), repeat=6), key=lambda p: sum(s[i, k] for i, k in enumerate(p)) - 2.5 * sum(a != b for a, b in zip(p, p[1:])))
        assert langid._viterbi(s, 2.5).tolist() == list(best)


def test_runs_bound_equals_viterbi(docs_rows, spark):
    model = langid.learn(spark.read.parquet(f"{SF}/documents.parquet"))
    ts = [t for _, t in docs_rows]
    w = langid._words(ts)
    label = langid.label_words(w, model, len(ts))
    assert model.allowed[w.script].all()
    score = np.clip(np.add.reduceat(model.table[w.grams], w.gram_first, axis=0).astype(float), -langid.WORD_BOUND, langid.WORD_BOUND)
    cuts = np.searchsorted(w.doc, np.arange(len(ts) + 1))
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            assert (langid._viterbi(score[a:b], langid.SWITCH_PENALTY) == label[a:b]).all()


def test_no_labels_no_rows(spark, none, odd):
    model = langid.learn(none)
    assert {r["lang_pred"] for r in langid.identify(odd, model).collect()} == {"und"}
    assert langid.identify(none, model).count() == 0


def test_scripts_narrow_languages(spark):
    docs = spark.createDataFrame([(i, t, k) for i, (t, k) in enumerate([("привет мир как дела", "ru"), ("hello world how are you", "en")] * 3)],
                                 "doc_id long, text string, lang string")
    model = langid.learn(docs)
    out = langid.identify(spark.createDataFrame([(1, "жжж ццц"), (2, "qqq zzz"), (3, "漢字")], "doc_id long, text string"), model)
    assert {r["doc_id"]: r["lang_pred"] for r in out.collect()} == {1: "ru", 2: "en", 3: "en"}
    assert {r["doc_id"]: r["score"] for r in out.collect()}[3] < 0.5


def test_other_languages_and_noise_have_low_scores(spark):
    model = langid.learn(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = [(1, "Привет мир это русский текст"), (2, "这是中文文本"), (3, "qwrtp zxcv"), (4, "xqzjk vvwq kkqx jjzq"), (5, "Ελληνικό κείμενο")]
    out = langid.identify(spark.createDataFrame(rows, "doc_id long, text string"), model)
    assert all(r["score"] < 0.5 and r["lang_pred"] != "und" for r in out.collect())
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(regexp_replace(text, '[^A-Za-z]', '')) > 0.6 * length(text)")
    low = langid.identify(table, model).where("score < 0.5")
    assert low.count() <= 0.01 * table.count()


# -- 5 ---------------------------------------------------------------------

def test_simhash_against_all_pairs(spark, docs_rows):
    assert rows_of(queries.op5_simhash(spark, SF), "doc_id", "fingerprint", "component_id") == sorted(near_duplicates(docs_rows), key=repr)


def test_fingerprints_of_odd_texts(odd):
    for t in [r["text"] for r in odd.collect()]:
        assert sim.fingerprint(t or "") & (2**64 - 1) == simhash(t)


@pytest.mark.parametrize("shard_size", [4, 2048])
def test_links_equal_all_pairs(spark, shard_size):
    random.seed(9)
    near = random.getrandbits(64)
    prints = {near ^ sum(1 << b for b in random.sample(range(64), random.randint(0, 5))) for _ in range(150)}
    prints |= {sum(1 << b for b in random.sample(range(12), random.randint(0, 5))) for _ in range(60)} | {random.getrandbits(64) for _ in range(50)}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    from brute import groups
    of = groups(signed, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 2)
    expected = {(signed[i], signed[min(of[i])]) for i in range(len(signed)) if len(of[i]) > 1}
    from matchlake.llm.components import components
    got = components(sim.links(spark.createDataFrame([(p,) for p in signed], "fp long"), 2, shard_size))
    assert {(r["vertex"], r["root"]) for r in got.collect()} == expected


def test_bk_tree_search():
    random.seed(2)
    values = list({random.getrandbits(16) for _ in range(400)})
    tree = sim.BKTree()
    for v in values:
        tree.add(v)
    for q in values[:40]:
        assert sorted(tree.within(q, 2)) == sorted(i for i, v in enumerate(values) if (v ^ q).bit_count() <= 2)


def test_chain_is_one_component(spark):
    from matchlake.llm.components import components
    got = components(spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (201, 200)], "u long, v long")).collect()
    assert {(r["vertex"], r["root"]) for r in got} == {(i, 0) for i in range(61)} | {(200, 200), (201, 200)}


def test_near_duplicates_of_odd_rows(odd, none):
    out = sim.near_duplicates(odd).collect()
    assert len(out) == odd.count()
    zero = [r for r in out if r["fingerprint"] == "0" * 16]
    assert len(zero) == 4 and {r["component_id"] for r in zero} == {1}
    assert sim.near_duplicates(none).count() == 0
    kept = sim.representatives(odd).collect()
    assert len(kept) == len({r["component_id"] if r["component_id"] is not None else "n" for r in out}) + 1  # id 4 leads two groups
    assert sim.representatives(odd).columns == odd.columns


# -- 6 ---------------------------------------------------------------------

def test_repeats_against_all_windows(spark, docs_rows):
    got = rows_of(queries.op6_suffix_dedup(spark, SF), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == sorted(remove_repeats(docs_rows), key=repr)


@pytest.mark.parametrize("seed, group", [(1, 32), (2, 1), (3, 3)])
def test_repeats_of_planted_strings(spark, seed, group, monkeypatch):
    monkeypatch.setattr(substring_dedup, "GROUP", group)     # both ways to compare the regions of an anchor
    random.seed(seed)

    def noise(n, letters="abcdefgh ijé"):
        return "".join(random.choice(letters) for _ in range(n))
    passages = [noise(n) for n in (150, 199, 200, 201, 260, 900)]
    rows = [(i, noise(random.randint(0, 300)) + "".join(random.choice(passages) + noise(random.randint(0, 40)) for _ in range(random.randint(0, 4)))) for i in range(40)]
    rows += [(50, "ab" * 400), (51, "a" * 500), (52, "a" * 199), (53, rows[3][1] + "!"), (54, passages[5][:430] + passages[4][:230] + passages[5][200:]), (55, "")]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(remove_repeats(rows), key=repr)


def test_repeats_of_odd_rows(odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    cols = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    expected = sorted((x[1:] for x in remove_repeats([(i, t) for i, (_, t) in enumerate(rows)])), key=repr)
    assert rows_of(substring_dedup.remove_repeats(odd), *cols) == expected
    assert substring_dedup.remove_repeats(none).count() == 0


def test_segments_join_regions(monkeypatch):
    random.seed(3)
    raw = "".join(random.choice("abcd") for _ in range(5000)).encode()
    whole = substring_dedup.regions(raw)
    monkeypatch.setattr(substring_dedup, "STARTS", 701)
    for a, b in zip(whole, substring_dedup.regions(raw)):
        assert a.tolist() == b.tolist()


def test_levels_are_logarithmic(spark):
    family = substring_dedup.LevelFamily()
    sizes = []
    for k in range(5):
        family.add(spark.createDataFrame([(k,), (7,)], "gram long"))
        sizes.append([r for r, _ in family.levels])
    assert sizes == [[0], [1], [1, 0], [2], [2, 0]]
    last = spark.createDataFrame([(0,), (9,)], "gram long")
    assert {(r["gram"], r["n"]) for r in family.matches(last).collect()} == {(0, 2), (7, 5)}


# -- 7 ---------------------------------------------------------------------

CONT = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_contamination_against_all_windows(spark, docs_rows):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = rows_of(queries.op7_decontaminate(spark, SF), *CONT)
    assert got == sorted(contamination(docs_rows, items), key=repr)
    assert any(r[-1] for r in got)


@pytest.mark.parametrize("block", [3, 200_000])
def test_contamination_small_cases(spark, block):
    items = [(1, "One two THREE"), (2, "a b c d e f g h i j k l"), (10, "a b c d e f g h i j k l"), (3, None), (4, ""), (5, "é1 x"), (2, "q r s")]
    rows = [(1, "zero one, two-three four"), (2, "x a b c d e f g h i j y"), (3, "A B C D E F G H I J K L a b"), (4, None), (5, ""), (6, "two three"), (7, "É1 é1 x"), (8, "q r s q r s")]
    got = decontaminate.contamination(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
                                      block_windows=block)
    assert rows_of(got, *CONT) == sorted(contamination(rows, items), key=repr)


def test_contamination_of_odd_rows(spark, odd, none):
    bench = spark.createDataFrame([(None, "null id here"), (1, None)], "item_id long, text string")
    out = decontaminate.contamination(odd, bench).collect()
    assert len(out) == odd.count() and [(r["n_hit"], r["n_items"]) for r in out if r["contaminated"]] == [(3, 0)]
    assert decontaminate.contamination(odd, bench.where("false")).where("contaminated").count() == 0
    assert decontaminate.contamination(none, bench).count() == 0


# -- 9 ---------------------------------------------------------------------

def test_orc_tokens_against_the_library(spark, docs_rows):
    got = [tuple(r) for r in queries.op9_token_orc(spark, SF).orderBy("doc_id").collect()]
    assert got == token_rows(docs_rows, Tokenizer.from_file(WORDS))


def test_parts_equal_whole_texts():
    random.seed(8)
    tk = Tokenizer.from_file(WORDS)
    enc = token_orc.Encoder(tk.to_str())
    letters = [c for c in map(chr, range(0x3100)) if c.isspace()] + list("abΣσ.'ßİ!é́ 1２<|>t\x01\x00‍") * 3
    texts = ["".join(random.choice(letters) for _ in range(60)) for _ in range(400)] + ["a <|endoftext|>b", "\x01", "", " ", "İstanbul \u0958\u0958 \u1100\u1161 words"]
    flat, n = enc.ids(pa.array(texts))
    cuts = np.concatenate([[0], np.cumsum(n)])
    for i, t in enumerate(texts):
        assert flat[cuts[i]:cuts[i + 1]].tolist() == tk.encode(t, add_special_tokens=False).ids


def test_orc_metadata_and_pruning(spark, odd, none, tmp_path):
    path = str(tmp_path / "t")
    token_orc.write_tokens(odd, path, WORDS, stride=1000)
    import glob

    import pyarrow.orc as orc
    assert sum(orc.ORCFile(f).nrows for f in glob.glob(path + "/*.orc")) == odd.count()
    out = token_orc.token_digests(token_orc.read_tokens(spark, path)).orderBy("start").collect()
    ends = [r["start"] + r["n_tokens"] for r in out]
    assert [r["start"] for r in out] == [0, *ends[:-1]]
    assert [r["doc_id"] for r in out] == sorted([r["doc_id"] for r in out], key=lambda i: (i is not None, i))
    few = token_orc.read_tokens(spark, path, ids=[4])
    assert few.count() == 3
    token_orc.write_tokens(none, str(tmp_path / "e"), WORDS)
    assert token_orc.read_tokens(spark, str(tmp_path / "e")).count() == 0


def rows_scanned(df):
    """Rows that the scan of ``df`` gave to the plan when it ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    leaves = plan.collectLeaves()       # the sums by part, of all rows, are a stage of their own
    scans = [leaf for leaf in (leaves.apply(i) for i in range(leaves.size())) if leaf.nodeName().startswith("Scan orc")]
    assert len(scans) == 1
    return scans[0].metrics().get("numOutputRows").get().value()


def test_row_indexes_and_bloom_filters_skip_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    docs = spark.range(0, 40_000, 2).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    token_orc.write_tokens(docs, path, WORDS, stride=1000)
    every = rows_scanned(token_orc.read_tokens(spark, path))
    one = token_orc.read_tokens(spark, path, ids=[12_346])
    assert one.count() == 1 and rows_scanned(one) <= 1000 < every
    # inside every stripe's range, but of no document: only the Bloom filters can tell
    absent = token_orc.read_tokens(spark, path, ids=[12_345])
    assert absent.count() == 0 and rows_scanned(absent) == 0


def test_the_cache_is_bounded_by_ids(monkeypatch):
    monkeypatch.setattr(token_orc, "CACHE_IDS", 50)
    tk = Tokenizer.from_file(WORDS)
    enc = token_orc.Encoder(tk.to_str())
    for k in range(6):
        texts = [f"{'x' * 300}{k} words {k}", "and words"]
        flat, n = enc.ids(pa.array(texts))
        assert flat.tolist() == [i for t in texts for i in tk.encode(t, add_special_tokens=False).ids]
        assert len(enc.number) <= 10


# -- 10 --------------------------------------------------------------------

def test_base_spans_against_patterns(docs_rows):
    random.seed(6)
    odd = ["".join(random.choice("a1.@-+ ()5%") for _ in range(60)) for _ in range(4000)]
    odd += ["a@b.c%x@d.e@f.g", "1.2.3.4.5.6.7.8", "999.1.1.1.1.1", "0001.002.3.4", "+1 (555) 123-4567", "4111 1111-1111 1111", "x@y", "@a.b", "1.2.3.", "é@a.b"]
    for t in odd + [t for _, t in docs_rows]:
        assert sanitize.base_spans(t) == personal(t), t[:80]


def test_long_runs_take_linear_time():
    import time
    at = time.time()
    for t in ("a" * 10**6, "1" * 10**6, "1." * 10**5, "@" * 10**5, "a@" * 10**5, "+1" * 10**5, "1 " * 10**5, "a@b." * 10**5):
        sanitize.base_spans(t)
    assert time.time() - at < 20


def test_query_equals_patterns(spark, docs_rows):
    import hashlib
    for r in queries.op10_pii(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), "doc_id").collect():
        base = personal(r["text"])
        assert tuple(r[f"n_{k}"] for k in sanitize.KINDS) == tuple(sum(s[0] == k for s in base) for k in sanitize.KINDS)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert r["spans"].startswith(text)


def test_terms_that_reveal_are_changed(spark):
    """A name that stands with one address only gives it away; words that stand with many do not."""
    rows = [(i, f"Report {i}: please write to Zorblax at zx@corp.example about item {i % 3}.") for i in range(8)]
    rows += [(20 + i, f"Report {i}: please write to Person{i} at p{i % 6}@other.example about item {i % 3}.") for i in range(30)]
    rows += [(99, "Zorblax is a clean document without an address.")]
    out = {r["doc_id"]: r for r in sanitize.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "Zorblax" not in out[3]["clean_text"] and "[EMAIL]" in out[3]["clean_text"] and "please write to" in out[3]["clean_text"]
    assert out[3]["spans"].startswith("email:") and ("term:" in out[3]["spans"] or "gone:" in out[3]["spans"])
    assert out[99]["clean_text"] == rows[-1][1] and out[99]["spans"] == ""
    assert "Person4" in out[24]["clean_text"]      # one text is no evidence


@pytest.mark.parametrize("more", [0, 400])
def test_disclosure_against_counts(spark, more):
    """All pairs by the definition, over whole different texts; texts without entities and terms of theirs change nothing."""
    import math
    random.seed(1)
    rows = [(i, " ".join(random.choice("abcdefg") + "w" for _ in range(3)) + f" e{random.randint(0, 3)}@x.yz " + random.choice(["kk", "ll", f"n{i % 9}"])
             + f" far {i % 2}") for i in range(60)]
    rows += [(100, "own1 a1@b.cd e5@f.gh"), (101, "own2 own1 a1@b.cd e5@f.gh z@z.zz"), (102, rows[4][1]), (103, None), (104, "aw kk")]
    rows += [(1000 + i, f"plain text {i} without any") for i in range(more)]
    held = {t: ({t[a:b] for _, a, b in personal(t)}, set(re.findall(r"[^\W_]+", re.sub(r"\S+@\S+", " ", t.lower())))) for t in {t or "" for _, t in rows}}
    expected = {}
    for e in {e for es, _ in held.values() for e in es}:
        n_e = sum(e in es for es, _ in held.values())
        for w in {w for _, ws in held.values() for w in ws}:
            n_t, n_et = sum(w in ws for _, ws in held.values()), sum(e in es and w in ws for es, ws in held.values())
            share = n_et / math.sqrt((n_e + 1) * (n_t + 1))
            if share >= 0.3:
                expected[f"email:{e}", w] = share >= 0.6
    got = sanitize.revealing_terms(sanitize.contexts(spark.createDataFrame(rows, "doc_id long, text string")), generalise_at=0.3, remove_at=0.6)
    assert {(r["entity"], r["term"]): r["gone"] for r in got.collect()} == expected and set(expected.values()) == {True, False}


def test_very_many_entities_of_one_text_are_one_class(spark, monkeypatch):
    text = " ".join(f"u{i}@x{i}.example" for i in range(2000)) + " " + " ".join(f"word{i}" for i in range(500))
    rows = [(1, text), (2, "word3 only u5@x5.example"), (3, "plain")]
    made, plain = {}, sanitize.store

    def counted(df, name, **options):
        made[name] = (out := plain(df, name, **options)).count()
        return out
    monkeypatch.setattr(sanitize, "store", counted)
    out = {r["doc_id"]: r["clean_text"] for r in sanitize.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert made["pairs"] <= 3 * 502 and out[3] == "plain" and "word7" not in out[1]


def test_terms_of_too_many_texts_do_not_move(spark, monkeypatch):
    """Words that stand in too many texts with entities for any of them are not counted or carried to their texts."""
    common = " ".join(f"common{i}" for i in range(50))
    rows = [(i, f"{common} own{i} u{i}@x.example") for i in range(40)] + [(100 + i, f"own{i} in a plain text") for i in range(10)]
    made, plain = {}, sanitize.store

    def counted(df, name, **options):
        made[name] = (out := plain(df, name, **options)).count()
        return out
    monkeypatch.setattr(sanitize, "store", counted)
    out = {r["doc_id"]: r["clean_text"] for r in sanitize.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert made["asked-terms"] == 40 and made["term-counts"] == made["context-terms"] == made["pairs"] == 30
    assert out[3] == f"{common} own3 [EMAIL]" and out[30] == f"{common} [WORD] [EMAIL]" and out[103] == rows[43][1]


def test_sanitise_of_odd_rows(odd, none):
    out = sanitize.sanitise(odd)
    assert out.count() == odd.count() and sanitize.sanitise(none).count() == 0
    assert {c for c in odd.columns if c != "spans"} <= set(out.columns)
    # "word" stands in the text of the address and in no other
    said = {None: "", **{r["text"]: r["text"].replace("word ", "[WORD] ").replace("tail@example.org", "[EMAIL]") if r["text"] and "@" in r["text"]
                         else r["text"] for r in odd.collect() if r["text"] is not None}}
    assert all(r["clean_text"] == said[r["text"]] for r in out.collect())


def test_entities_of_one_text_are_judged(spark):
    """A rare word beside an address of one text is generalised, also when the text has copies; common words stay."""
    rows = [(i, f"please write to u{i}@x.example now") for i in range(60)]
    rows += [(100 + k, "please write to Zorblax zx@corp.example now") for k in range(4)]
    out = {r["doc_id"]: r["clean_text"] for r in sanitize.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[100] == out[103] == "please write to [NAME] [EMAIL] now"
    assert out[5] == "please write to [EMAIL] now"


def test_terms_are_counted_and_changed_in_whole_texts(spark):
    """A name far from the address goes; a word rare near addresses but common in the corpus stays."""
    far = " ".join(["please", "write", "about", "it"] * 10)
    rows = [(i, f"please write about it often u{i}@x.example") for i in range(60)]
    rows += [(100 + i, f"please write about it seldom, number {i} of the plain texts") for i in range(60)]
    rows += [(300 + k, f"Dear Zorblax, {far} seldom zx@corp.example") for k in range(2)]
    out = {r["doc_id"]: r for r in sanitize.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[300]["clean_text"] == out[301]["clean_text"] == f"[NAME] [NAME], {far} seldom [EMAIL]"
    assert out[300]["spans"] == f"email:{len(f'Dear Zorblax, {far} seldom ')}:{len(rows[-1][1])},term:0:4,term:5:12"
    assert out[103]["clean_text"] == rows[63][1]
