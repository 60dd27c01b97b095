"""The operators' queries over the given tables, with SQL where it can express them.

Each applies one operator with its production parameters to its whole table.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table, scratch_path
from . import max_sketch, merkle, oracles, recompression
from .ann import search
from .chat import BEGIN, END, PART_TURNS, render
from .common import crc_mod, ship
from .decontaminate import contamination
from .html_extract import extract
from .langid import held_out, identify, learn
from .sanitize import KINDS, sanitise
from .sentencepiece_dropout import round_trip
from .simhash import near_duplicates
from .substring_dedup import remove_repeats
from .token_orc import read_tokens, token_digests, write_tokens

#: Folder of the public vocabularies; a parameter of the environment.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def tokenizer_path(name: str) -> str:
    """A vocabulary's place: the parameter's folder, or where the package that ships them says."""
    path = os.path.join(TOKENIZERS, name)
    if os.path.exists(path):
        return path
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return round_trip(read_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), dropout=0.1, seed=1)


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render(read_table(spark, sf_dir, "conversations"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return extract(read_table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = read_table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out()))
    out = identify(docs.select("doc_id", "text", held_out().alias("held_out")), model, keep=["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").cast("bigint").alias("n_spans"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, radius=2)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return remove_repeats(read_table(spark, sf_dir, "documents"), length=200).drop("spans")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    out = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), window=10, keep=["doc_id"])
    return out.drop("hits")


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return search(read_table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0, k=20)


def op9_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    path = scratch_path(spark, "token-orc")
    write_tokens(read_table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"))
    return token_digests(read_tokens(spark, path))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return sanitise(read_table(spark, sf_dir, "documents"), keep=["doc_id"]) \
        .select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans")


def op11_max_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = read_table(spark, sf_dir, "documents")
    return max_sketch.search(max_sketch.build(docs), docs, read_table(spark, sf_dir, "benchmark"), k=20)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = merkle.leaf_digest(*[F.col(c).cast("bigint") + 1 if c == "n_chars" else F.col(c) for c in fields])
    claim = F.when(crc_mod(F.col("doc_id"), 7) == 0, tampered).otherwise(merkle.leaf_digest(*[F.col(c) for c in fields]))
    return merkle.audit(read_table(spark, sf_dir, "documents"), claim, fields)


def op13_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return recompression.remove_repeats(read_table(spark, sf_dir, "documents"), window=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_sentencepiece_dropout, op2_chat_format, op3_html_extract, op4_language_id, op5_simhash,
                            op6_suffix_dedup, op7_decontaminate, op8_nearest, op9_token_orc, op10_pii, op11_max_sketch,
                            op12_merkle, op13_recompression)}

ORACLES: dict[str, str] = {
    # Prefixes are compared as lists of whole turns, not by hash.
    "op2_chat_format": f"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
  md5(IF(role IS NULL, '0', '1') || COALESCE(role, '') || chr(10) || IF(text IS NULL, '0', '1') || COALESCE(text, ''))) AS place FROM t),
whole AS (SELECT conv_id, COUNT(*) AS n_turns, list({{'r': role, 't': text}} ORDER BY place) AS turns FROM n GROUP BY conv_id),
distinct_convs AS (SELECT turns, n_turns, MIN(conv_id) AS conv_id, COUNT(*) AS n_copies FROM whole GROUP BY turns, n_turns),
prefixes AS (SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, UNNEST(range(1, n_turns)) AS k FROM distinct_convs)),
kept AS (SELECT * FROM distinct_convs d WHERE NOT EXISTS (SELECT 1 FROM prefixes p WHERE p.turns = d.turns))
SELECT k.conv_id, CAST(FLOOR((n.place - 1) / {PART_TURNS}) AS BIGINT) AS part, k.n_turns, k.n_copies,
       string_agg('{BEGIN}' || COALESCE(n.role, '') || chr(10) || COALESCE(n.text, '') || '{END}' || chr(10), '' ORDER BY n.place) AS text
FROM kept k JOIN n USING (conv_id) GROUP BY ALL
""".strip(),
    "op11_max_sketch": oracles.RANKED,
    "op12_merkle": oracles.MERKLE,
}
