"""Fixtures of these tests (not a conftest, whose name the tests above use)."""

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_rows(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, an empty and a long text, repeated rows, tied ids, and extra columns whose names clash."""
    long = "word " * 30_000 + "tail@example.org"
    same = "The same text, twice over, with more than three words. " * 8
    rows = [(None, None, "en"), (None, "null id here with words", None), (1, "", "en"), (2, None, None), (3, long, "en"), (4, same, "en"),
            (4, same, "en"), (4, "another text under a tied id", "de"), (5, same, "en"), (6, "\t \n", "en"), (7, "日本語 ▁ text \x00 é", "fr"), (8, "12345 !!", None)]
    names = ("ids", "fp", "fingerprint", "hits", "spans", "score", "key", "th", "found", "text_key")
    return spark.createDataFrame([(*r, *[k] * len(names)) for k, r in enumerate(rows)],
                                 "doc_id bigint, text string, lang string, " + ", ".join(f"{n} int" for n in names))


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
