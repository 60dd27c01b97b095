"""Personal data: pattern spans, and terms that reveal them by corpus co-occurrence.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers,
found by their patterns and checks, leftmost and non-overlapping per kind.

The method then looks at terms: the words of a text outside its base spans.
Spark counts over all different texts of the corpus how many hold entity e
(n_e), how many hold term t (n_t) and how many of e's hold t (n_et).  The
pointwise mutual information of e and t, less the information content of their
standing together, is log(n_et^2 / (n_e n_t)): minus the bits that are still
missing of e when t is known, and of t when e is.  The size of the corpus has no
part in it, so the same evidence gives the same verdict in a corpus of any size.
Half of it as a share, n_et / sqrt(n_e n_t), is the disclosure, with ``prior``
texts more in both n_e and n_t, so that entities and terms of one text are
judged too, with less disclosure the fewer the texts.  A term of
``generalise_at`` or more gives e away: it is generalised to its shape class, and
at ``remove_at`` (it all but names e) removed, wherever it stands in the texts
that hold e.  Texts without personal data stay as they are, and base spans stay
whatever the terms do.

Entities that stand in the same texts have the same counts with every term, so
one class stands for them: a text with very many addresses of its own meets its
terms once, not once an address.  Texts are told apart by 128 bits.

Defined cases: null text is empty; empty text has no spans.  Rows with null id
and repeated rows each give their row; equal texts count once as evidence.
Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import append_columns, bloom_filters, slices, store, texts_of

KINDS = ("email", "ip", "card", "phone")
TERM, GONE = "term", "gone"     # what the method adds: generalised, removed
PRIOR, GENERALISE_AT, REMOVE_AT = 1.0, 0.5, 0.95
LEXICON = 1 << 18       # terms that a task adds up before it gives them away

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP_REST = re.compile(r"\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
WORD = re.compile(r"[^\W_]+")
DIGITS = frozenset("0123456789")


def _emails(text: str):
    """From each @ to the left over its local part, to the right by pattern: linear in long runs."""
    done, at = 0, text.find("@")
    while at >= 0:
        a = at
        while a > done and text[a - 1] in LOCAL:
            a -= 1
        m = DOMAIN.match(text, at) if a < at else None
        if m:
            yield a, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str):
    done = pos = 0
    while m := IP_REST.search(text, pos):
        a = m.start()
        while a > done and text[a - 1] in DIGITS:
            a -= 1
        if a < m.start():
            done = pos = m.end()
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text[a:done].split(".")):
                yield a, done
        else:
            pos = m.start() + 1


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _cards(text: str):
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            yield m.span()


def _phones(text: str):
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                yield m.span()


FINDERS = dict(zip(KINDS, (_emails, _ips, _cards, _phones)))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start."""
    return [(k, a, b) for k, find in FINDERS.items() for a, b in find(text)]


def entity_key(kind: str, surface: str) -> str:
    """Spellings of one entity that count together: digits of numbers, lower case of the rest."""
    return f"{kind}:{NOT_DIGIT.sub('', surface) if kind in ('card', 'phone') else surface.lower()}"


def words_outside(text: str, spans: list[tuple[int, int]]):
    """(term, start, end) of the words that overlap none of ``spans`` (sorted)."""
    ends, most = [], 0
    for _, b in spans:
        most = max(most, b)
        ends.append(most)
    k = 0
    for m in WORD.finditer(text):
        x, y = m.span()
        while k < len(spans) and ends[k] <= x:
            k += 1
        if k == len(spans) or spans[k][0] >= y:
            yield m[0].lower(), x, y


def text_key(col: Column) -> Column:
    return F.md5(F.coalesce(col, F.lit("")))


def copied_texts(keyed: DataFrame) -> DataFrame:
    """(doc, text, weight) of one row, or the rows of one id, of each text that has copies: the copies that count too
    much, as a negative weight.  ``keyed`` is (doc, id, text); only these rows move."""
    of_id = keyed.groupBy("doc", "id").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "n"))
    copies = of_id.groupBy("doc").agg(F.sum("n").alias("copies"), first.alias("first")).where("copies > 1")
    copies = store(copies.select(F.xxhash64("doc", "first.id").alias("at"), "doc", "first.id", ((1 - F.col("copies")) / F.col("first.n")).alias("weight")),
                   "copied-texts").where("weight < 0")      # all; a filter lets the runtime Bloom filter be made of them
    rows = keyed.withColumn("at", F.xxhash64("doc", "id"))
    same = (rows["at"] == copies["at"]) & (rows["doc"] == copies["doc"]) & rows["id"].eqNullSafe(copies["id"])
    return rows.join(copies, same).select(rows["doc"], "text", "weight")


def contexts(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One pass over all texts: (doc, entities, terms) of each row whose text holds entities, doc being the text's key,
    and (term, weight), added up in the task: 1 for each row, less what copies of a text count too much."""
    keyed = docs.select(text_key(F.col(text_col)).alias("doc"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    weighed = keyed.select("doc", "text", F.lit(1.0).alias("weight")).unionByName(copied_texts(keyed))
    names = ["doc", "entities", "terms", "term", "weight"]
    strings = pa.list_(pa.string())

    def run(batches):
        lexicon: dict[str, float] = {}

        def told():
            n = len(lexicon)
            return pa.RecordBatch.from_arrays([pa.nulls(n, pa.string()), pa.nulls(n, strings), pa.nulls(n, strings),
                                               pa.array(list(lexicon), pa.string()), pa.array(list(lexicon.values()), pa.float64())], names=names)
        for batch in batches:
            for part in slices(batch, 1):
                docs, entities, terms = [], [], []
                for k, (t, weight) in enumerate(zip(texts_of(part.column(1)), part.column(2).to_pylist())):
                    spans = base_spans(t)
                    if spans:
                        words = {w for w, _, _ in words_outside(t, sorted({(a, b) for _, a, b in spans}))}
                    else:
                        words = {w.lower() for w in set(WORD.findall(t))}
                    if spans and weight > 0:
                        docs.append(k)
                        entities.append(sorted({entity_key(k, t[a:b]) for k, a, b in spans}))
                        terms.append(sorted(words))
                    for w in words:
                        lexicon[w] = lexicon.get(w, 0.0) + weight
                n = len(docs)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(docs, pa.int64())), pa.array(entities, strings), pa.array(terms, strings),
                                                  pa.nulls(n, pa.string()), pa.nulls(n, pa.float64())], names=names)
                if len(lexicon) > LEXICON:
                    yield told()
                    lexicon = {}
        yield told()

    return weighed.mapInArrow(run, "doc string, entities array<string>, terms array<string>, term string, weight double")


def revealing_terms(seen: DataFrame, prior: float = PRIOR, generalise_at: float = GENERALISE_AT,
                    remove_at: float = REMOVE_AT) -> DataFrame:
    """(entity, term, gone boolean) above the disclosure thresholds; ``seen`` as from ``contexts``."""
    classes, _, both = judged(store(seen, "contexts", compression="zstd"), prior, generalise_at)
    return classes.join(revealing(both, remove_at), "class").select("entity", "term", "gone")


def judged(seen: DataFrame, prior: float, generalise_at: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entity, class) of all entities; (doc, class, term) of the terms that can give a class of entities away, and
    (class, term, share) of those that do.  ``seen`` is stored.

    A term in so many texts that it would not reveal e if it stood in all of e's meets e nowhere.  Most terms of a text
    stand in too many texts for any of its entities (``most``: the largest n_e there), so they are left out before counts
    and texts move: on the texts with entities alone first, then on n_t.
    """
    held = seen.where("doc is not null")
    units = held.select("doc", F.explode("entities").alias("entity")).distinct()
    # which texts an entity stands in, in 128 bits: the exclusive-or of the texts' hashes
    of = units.groupBy("entity").agg(F.count("*").alias("n_e"), *[F.bit_xor(F.xxhash64("doc", F.lit(k))).alias(f"x{k}") for k in (1, 2)])
    classes = store(of.select("entity", "n_e", F.struct("n_e", "x1", "x2").alias("class")), "entity-classes")
    units = store(units.join(classes, "entity").select("doc", "class", "n_e").distinct(), "units")
    words = held.select("doc", "terms").dropDuplicates(["doc"]).join(units.groupBy("doc").agg(F.max("n_e").alias("most")), "doc") \
        .select("doc", "most", F.explode("terms").alias("term"))
    words = store(words, "context-words")
    asked = words.groupBy("term").agg(F.count("*").alias("n"), F.max("most").alias("most")).where(may_reveal(prior, generalise_at, "n"))
    asked = store(asked, "asked-terms").where("n > 0")      # all; a filter lets the runtime Bloom filter be made of them
    with bloom_filters(seen.sparkSession):
        n_term = seen.where("term is not null").select("term", "weight").join(asked.select("term", "most"), "term") \
            .groupBy("term").agg(F.round(F.sum("weight")).cast("bigint").alias("n_t"), F.first("most").alias("most"))
        n_term = store(n_term.where(may_reveal(prior, generalise_at, "n_t")).select("term", "n_t"), "term-counts").where("n_t > 0")
        terms = words.join(n_term, "term").where(may_reveal(prior, generalise_at, "n_t"))
        terms = store(terms.select("doc", "term", "n_t"), "context-terms")
    best = disclosure(prior, F.least("n_e", "n_t"))     # were all of e's texts to hold t
    pairs = store(units.join(terms, "doc").where(best >= generalise_at), "pairs")
    both = pairs.groupBy("class", "term").agg(F.count("*").alias("n_et"), *[F.first(c).alias(c) for c in ("n_e", "n_t")]) \
        .withColumn("share", disclosure(prior, F.col("n_et"))).where(F.col("share") >= generalise_at)
    return classes.select("entity", "class"), pairs.select("doc", "class", "term"), both.select("class", "term", "share")


def revealing(both: DataFrame, remove_at: float) -> DataFrame:
    return both.select("class", "term", (F.col("share") >= remove_at).alias("gone"))


def disclosure(prior: float, n_et: Column):
    """How nearly entity and term stand in the same texts, from n_e, n_t and ``n_et``: exp of half their mutual
    information less the information content of both together, smoothed by ``prior`` texts."""
    return n_et / F.sqrt((F.col("n_e") + prior) * (F.col("n_t") + prior))


def may_reveal(prior: float, generalise_at: float, n: str) -> Column:
    """Whether a term in at least ``n`` texts can reach the threshold with an entity in at most ``most``."""
    return (F.col(n) <= F.col("most")) | (F.col("most") / F.sqrt((F.col("most") + prior) * (F.col(n) + prior)) >= generalise_at)


def shape(term: str) -> str:
    """The class that stands for a generalised term."""
    return "[NUMBER]" if term.isdigit() else "[NAME]" if term[:1].isupper() else "[WORD]"


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prior: float = PRIOR,
             generalise_at: float = GENERALISE_AT, remove_at: float = REMOVE_AT, keep: list[str] | None = None) -> DataFrame:
    """``docs`` plus n_email, n_ip, n_card, n_phone, base_sha256, spans string and clean_text.

    Terms reach their documents by a join on the text's hash; only texts with
    revealing terms have rows there.
    """
    with bloom_filters(docs.sparkSession):
        seen = store(contexts(docs, text_col, id_col), "contexts", compression="zstd")
    _, pairs, both = judged(seen, prior, generalise_at)
    # stored tables meet in joins, so that the skew join can split entities and texts with very many copies
    places = pairs.join(store(revealing(both, remove_at), "terms"), ["class", "term"]) \
        .groupBy("doc", "term").agg(F.max("gone").alias("gone")) \
        .groupBy("doc").agg(F.collect_list(F.struct("term", "gone")).alias("_terms"))
    places = store(places, "places")
    names = docs.columns
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = f"c{names.index(text_col)}"
    keyed = append_columns(inner, [text], [("_held", "boolean")], lambda: lambda t: [
        pa.array([bool(base_spans(x)) for x in texts_of(t)], pa.bool_())], text)
    # only texts with personal data are moved
    without = keyed.where("not _held").withColumn("_terms", F.lit(None).cast(places.schema["_terms"].dataType))
    held = keyed.where("_held").withColumn("_doc", text_key(F.col(text)))
    joined = held.join(places.withColumnRenamed("doc", "_doc"), "_doc", "left").drop("_doc").unionByName(without)
    fields = [*[(f"n_{k}", "bigint") for k in KINDS], ("base_sha256", "string"), ("spans", "string"), ("clean_text", "string")]

    def start():
        def work(text, terms):
            cols: list[list] = [[] for _ in fields]
            for t, extra in zip(texts_of(text), terms.to_pylist()):
                base = base_spans(t)
                kinds = {x["term"]: GONE if x["gone"] else TERM for x in extra or []}
                outside = words_outside(t, sorted({(a, b) for _, a, b in base})) if kinds else []
                added = [(kinds[w], a, b) for w, a, b in outside if w in kinds]
                for c, k in zip(cols, KINDS):
                    c.append(sum(s[0] == k for s in base))
                cols[4].append(hashlib.sha256(joined_spans(base).encode()).hexdigest())
                cols[5].append(joined_spans(base + sorted(added, key=lambda s: (s[0] == GONE, s[1]))))
                cols[6].append(replaced(t, base, added))
            return [pa.array(c, pa.int64()) for c in cols[:4]] + [pa.array(c, pa.string()) for c in cols[4:]]
        return work

    kept = [c for c in joined.columns if c not in ("_held", "_terms")]
    out = append_columns(joined, [text, "_terms"], fields, start, text, keep=kept)
    new = [f for f, _ in fields]
    take = [i for i, n in enumerate(names) if n.lower() not in new and (keep is None or n in keep)]
    return out.select(*[F.col(f"c{i}").alias(names[i]) for i in take], *new)


def joined_spans(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def replaced(text: str, base, added) -> str:
    """The text with base spans as [KIND], generalised terms as their class, removed ones left out.

    Of overlapping spans the one that starts first stands for all they cover.
    """
    out, at = [], 0
    for a, b, k in sorted([(a, b, k) for k, a, b in base] + [(a, b, k) for k, a, b in added], key=lambda s: (s[0], -s[1])):
        if a >= at:
            out += [text[at:a], "" if k == GONE else shape(text[a:b]) if k == TERM else f"[{k.upper()}]"]
            at = b
        elif b > at:
            at = b
    return "".join(out) + text[at:]
