"""A corpus pipeline of the training-data operators, stage by stage.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet in the shared checkpoint folder and reread as the next one's ``docs``.
All but the last return the columns of ``docs``, extra ones included, whatever
their names: operators see the columns under other names.

Defined cases are those of the operators; rows with null ids or repeated rows
pass like others, except that near-duplicate removal leaves one row of a group.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import ship, store
from matchlake.llm.decontaminate import contamination
from matchlake.llm.langid import held_out, identify, learn
from matchlake.llm.queries import tokenizer_path
from matchlake.llm.sanitize import sanitise
from matchlake.llm.sentencepiece_dropout import round_trip
from matchlake.llm.simhash import representatives
from matchlake.session import read_table

#: A document stays if one language holds at least this share of its letters.
LEAST_SHARE = 0.5


def _apart(docs: DataFrame):
    """``docs`` with positional names, a lookup of them, and the way back."""
    names = docs.columns
    inner = [f"_{i}" for i in range(len(names))]

    def back(df: DataFrame) -> DataFrame:
        return df.select(*inner).toDF(*names)

    return docs.toDF(*inner), lambda n: inner[names.index(n)], back


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those in which no language holds ``LEAST_SHARE`` of the letters; without a
    labelled document to learn from there is nothing to judge by, and all stay."""
    model = learn(docs.where(~held_out()))
    if not model.languages:
        return docs
    inner, at, back = _apart(docs)
    return back(identify(inner, model, text_col=at("text")).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates (the smallest id)."""
    return representatives(docs, shingle=3, radius=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    inner, at, back = _apart(docs)
    return back(contamination(inner, read_table(spark, sf_dir, "benchmark"), window=10, text_col=at("text")).where(~F.col("contaminated")))


def privacy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data, and terms that reveal it, in the text; n_chars follows."""
    inner, at, back = _apart(docs)
    clean = sanitise(inner, id_col=at("doc_id"), text_col=at("text")).withColumn(at("text"), F.col("clean_text"))
    if "n_chars" in docs.columns:
        clean = clean.withColumn(at("n_chars"), F.char_length("clean_text").cast(docs.schema["n_chars"].dataType))
    return back(clean)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes with merge-dropout, decodes, and returns the operator's digests per document."""
    return round_trip(docs, tokenizer_path("piece_bpe_32k.model"), dropout=0.1, seed=1)


def _ready(stage):
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return stage(spark, docs, sf_dir)
    return run_stage


STAGES = [
    ("language id", _ready(language_stage)),
    ("simhash near-dedup", _ready(near_duplicate_stage)),
    ("benchmark decontamination", _ready(decontamination_stage)),
    ("pii", _ready(privacy_stage)),
    ("sentencepiece", _ready(token_stage)),
]

#: Language models, fingerprints and merges are beyond SQL; the query is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
