import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
FIXTURES = os.path.join(ROOT, "tests", "fixtures")

A, B, X, Y, Z = ("aaaaaaaa-0000-5000-8000-00000000000a", "bbbbbbbb-0000-5000-8000-00000000000b",
                 "cccccccc-0000-5000-8000-00000000000c", "dddddddd-0000-5000-8000-00000000000d",
                 "eeeeeeee-0000-5000-8000-00000000000e")
M1, M2, M3 = ("11111111-1111-4111-8111-111111111111", "22222222-2222-4222-8222-222222222222",
              "33333333-3333-4333-8333-333333333333")
ROSTER = [A, B]


@pytest.fixture(scope="session")
def spark():
    from matchlake.session import build_session, checkpoint_root
    s = build_session("local[4]", shuffle_partitions=8)
    checkpoint_root(s)  # tests: a private folder only if the session names none
    yield s


@pytest.fixture(scope="session")
def docs(spark):
    from matchlake.sources import read_documents
    return read_documents(spark, os.path.join(FIXTURES, "matches"), multi_line=True, with_path=True)


@pytest.fixture(scope="session")
def star(docs):
    from matchlake.plans.star import build_star
    return {k: v.cache() for k, v in build_star(docs.drop("source_path")).items()}


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
