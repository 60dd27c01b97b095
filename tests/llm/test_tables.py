"""Operators on pages, conversations and embeddings, and the pipeline."""

import hashlib
import html as html_lib
import re

import numpy as np
import pytest
from brute import contamination, near_duplicates, personal
from llm_fixtures import SF, docs_rows, none, odd  # noqa: F401

import corpus_pipeline
from matchlake.llm import ann, chat, html_extract, queries

# -- 2 ---------------------------------------------------------------------


def brute_chat(rows):
    """rows: (conv, turn, role, text) -> {conv: (n_turns, n_copies, text)}."""
    convs = {}
    for r in set(rows):
        convs.setdefault(r[0], []).append(r[1:])

    def told(x):
        return "0" if x is None else "1" + x

    def key(r):
        return r[0] is not None, r[0] or 0, hashlib.md5(f"{told(r[1])}\n{told(r[2])}".encode()).hexdigest()
    turns = {c: tuple(x[1:] for x in sorted(v, key=key)) for c, v in convs.items()}
    out = {}
    for c, t in turns.items():
        same = [d for d, u in turns.items() if u == t]
        if any(len(u) > len(t) and u[:len(t)] == t for u in turns.values()):
            continue
        if c != min(same, key=lambda d: (d is None, d or 0)):
            continue
        out[c] = (len(t), len(same), "".join(f"<|im_start|>{r or ''}\n{x or ''}<|im_end|>\n" for r, x in t))
    return out


def assembled(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["part"]):
        n, c, t = out.get(r["conv_id"], (r["n_turns"], r["n_copies"], ""))
        out[r["conv_id"]] = (n, c, t + r["text"])
    return out


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_chat_against_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert assembled(queries.op2_chat_format(spark, SF)) == brute_chat(rows)


@pytest.mark.parametrize("block", [2, 256])
def test_snapshots_copies_ties_and_nulls(spark, block):
    full = [(k, "user" if k % 2 else "bot", f"t{k}") for k in range(7)]
    rows = [(1, *t) for t in full] + [(2, *t) for t in full[:3]] + [(3, *t) for t in full] + [(4, *t) for t in full[:3]] + [(4, 3, "bot", "else")]
    rows += [(5, None, "user", "x"), (5, 0, None, "y"), (6, None, "user", "x"), (7, 0, "user", ""), (8, 0, "user", None), (8, 1, "bot", "z")]
    rows += [(9, 1, "b", "tie"), (9, 1, "a", "tie"), (9, 1, "a", "tie"), (None, 0, "user", "lost"), (10, 5, "user", "t0"), (11, -3, "bot", "t0")]
    got = chat.render(conversations(spark, rows), part_turns=3, block_turns=block)
    assert assembled(got) == brute_chat(rows)


def test_one_long_conversation_comes_in_parts(spark):
    rows = [(1, k * 7, "user", f"turn {k}") for k in range(1200)] + [(2, k * 7, "user", f"turn {k}") for k in range(700)]
    df = chat.render(conversations(spark, rows))
    assert df.count() == 5 and assembled(df) == brute_chat(rows)
    assert chat.render(conversations(spark, rows).where("false")).count() == 0


# -- 3 ---------------------------------------------------------------------

def test_pages_of_the_table(spark):
    rows = {r["page_id"]: r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    got = queries.op3_html_extract(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(rows)
    for r in got:
        article = re.search(r"<article>(.*)</article>", rows[r["page_id"]]["html"], re.S)[1]
        text = " ".join(html_lib.unescape(re.sub(r"</?(p|h1|br)>", " ", article).replace("<b>", "")).split())
        assert (r["text"], r["n_chars"]) == (text, len(text))


def page(body, head=""):
    return f"<html><head><title>no</title>{head}</head><body>{body}</body></html>"


def test_templates_are_deleted_without_rules(spark):
    """Containers without telling tags or classes go once they recur on a host; content that recurs once stays."""
    def site(k, host):
        return (k, f"https://{host}/p{k}", page(f"<div><span>Top stories</span><span>About us</span></div><div><p>Story {k} tells it. Quote.</p>"
                                                f"<p>The common sentence.</p><div><b>Follow {host}</b></div></div><div>All rights</div>"))
    rows = [site(k, "a.example") for k in range(6)] + [site(9, "lone.example")]
    out = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out[3] == "Story 3 tells it. Quote."
    assert out[9] == "Top storiesAbout us Story 9 tells it. Quote. The common sentence. Follow lone.example All rights"


def test_articles_and_their_copies_stay(spark):
    story = "<article><h1>Title</h1><div><p>One &amp; the same</p><p>text</p></div></article>"
    rows = [(k, "http://x.example/", page(f"<nav>{k % 2}</nav>{story}")) for k in range(9)]
    rows += [(20 + k, "http://y.example/", page(f"<article><p>Own {k}</p><p>Shared sentence.</p><div>Read more</div></article>")) for k in range(5)]
    out = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out[4] == "Title One & the same text" and out[22] == "Own 2 Shared sentence."


def test_rules_and_broken_markup():
    text = html_extract.Page("""<header><h1>Site</h1></header><div class="site-menu"><a>m</a></div><div id=main-wrap><article><h1>T&amp;U</h1>
      <p>a <i>b</i>c<p>d<div class="share-bar">tweet</div><ul><li>1<li>2</ul><form>in<input></form><!-- no <p>no</p> -->
      <section class=comments><article class=comment>rubbish</article></section><script>if (a<b) "</p>"</script></article></div>
      <aside>side</aside><footer>f</footer>""").text
    assert text == "T&U a bc d 1 2"
    for raw, plain in (("", ""), ("a < b <3 <p class='x>y'>z</p>", "a < b <3 z"), ("x&nbsp;&lt;y&gt; &#233;", "x <y> é"), ("<p>x<script>y", "x"),
                       ("<!-- open", ""), ("<div>" * 3000 + "x", "x"), ("</p></div>t", "t"), ("<P>A</P><P>B", "A B"), ("<p", "")):
        assert html_extract.Page(raw).text == plain


def test_odd_pages(spark):
    rows = [(1, None, None, 1), (1, None, page("<p>x</p>"), 2), (None, "not a url", "", 3), (2, "http://h.example", page("<p>x</p>"), 4), (2, "http://h.example", page("<p>x</p>"), 4)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, template int").withColumnRenamed("template", "_host")
    out = html_extract.extract(df)
    assert out.columns == ["page_id", "url", "html", "_host", "text", "n_chars", "n_templates"]
    assert sorted(r["text"] for r in out.collect()) == ["", "", "x", "x", "x"]
    assert html_extract.extract(df.where("false")).count() == 0


# -- 8 ---------------------------------------------------------------------

def exact(rows, k):
    """(query, [(vec_id, score)]) by all inner products."""
    rows = [(i, v) for i, v in rows if i is not None and v is not None and len(v) and None not in v and np.isfinite(v).all() and np.any(v)]
    rows = list(dict.fromkeys((i, tuple(v)) for i, v in rows))
    out = {}
    for i, v in rows:
        if i % 20 == 0:
            near = [(-float(np.dot(np.array(v, dtype=float), np.array(w, dtype=float))), j) for j, w in rows if j != i]
            out[i] = [(j, -s) for s, j in sorted(near)[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


@pytest.mark.parametrize("options", [{}, {"leaf_size": 40, "trees": 6, "probe_share": 0.5}])
def test_recall(spark, options):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    truth = exact([(r["vec_id"], r["embedding"]) for r in table.collect()], 20)
    got = found(ann.search(table, lambda i: i % 20 == 0, 20, **options))
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in truth[q]}) for q in truth)
    assert set(got) == set(truth) and hits / sum(map(len, truth.values())) >= 0.9
    for q, near in got.items():
        assert [s for _, s in near] == sorted((s for _, s in near), reverse=True) and q not in {j for j, _ in near}


def test_small_groups_find_the_same(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    a, b = (found(ann.search(table, lambda i: i % 20 == 0, 20, leaf_size=60, group_rows=g)) for g in (8, 4096))
    assert {q: [j for j, _ in n] for q, n in a.items()} == {q: [j for j, _ in n] for q, n in b.items()}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (20, [3.0, 1.0]),
            (21, [3.0, 1.0]), (None, [1.0, 1.0]), (22, [3.0, 1.0]), (22, [3.0, 1.0]), (40, [1.0, 2.0, 3.0]), (60, [-1.0, -1.0])] + [(100 + k, [2.0, 2.0]) for k in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    two = [r for r in rows if r[1] is None or len(r[1]) != 3]
    assert found(ann.search(df, lambda i: i % 20 == 0, 20)) == exact(two, 20)
    assert ann.search(df.where("false"), lambda i: i % 20 == 0).count() == 0
    assert ann.search(df.where("vec_id = 0"), lambda i: i % 20 == 0).count() == 0


# -- pipeline ----------------------------------------------------------------

def test_pipeline_stages_against_brute_force(spark, docs_rows):
    docs, known = spark.read.parquet(f"{SF}/documents.parquet"), dict(docs_rows)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language id", "simhash near-dedup", "benchmark decontamination", "pii", "sentencepiece"]
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in now.collect()]
        out = stage(spark, now, SF).cache()
        ids = sorted(r["doc_id"] for r in out.collect())
        if name != "sentencepiece":
            assert out.columns == docs.columns
        if name == "language id":
            assert set(ids) >= {d for d, t in before if sum(c.isalpha() for c in t) > 0.5 * len(t)} and len(ids) >= 0.95 * len(before)
        elif name == "simhash near-dedup":
            assert ids == sorted({c for _, _, c in near_duplicates(before)})
        elif name == "benchmark decontamination":
            assert ids == sorted(r[0] for r in contamination(before, items) if not r[-1])
        elif name == "pii":
            assert ids == sorted(d for d, _ in before)
            for r in out.collect():
                assert r["n_chars"] == len(r["text"]) and (personal(known[r["doc_id"]]) or r["text"] == known[r["doc_id"]])
                assert not any(k == "email" for k, _, _ in personal(r["text"]))
        else:
            assert ids == sorted(d for d, _ in before) and out.where("not lossless").count() == 0
        now = out
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, now.collect()))


def test_pipeline_on_odd_rows(spark, odd, none):
    for rows in (odd, none):
        now = rows
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, SF).cache()
            if name != "sentencepiece":
                assert now.columns == odd.columns
    assert now.count() == 0


# -- registration ------------------------------------------------------------

def test_queries_and_oracles(spark):
    import __spark_entry__ as entry
    from oracle_compare import compare, duck
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert len(names) == 14 and [n.split("_")[0] for n in names[:-1]] == [f"op{k}" for k in range(1, 14)]
    con = duck(SF)
    for name in set(names) & set(entry.oracle_sql()):
        r = compare(spark, SF, name, con, entry.queries(), entry.oracle_sql())
        assert r["cols_match"] and r["values_match"] and r["types_match"], r
