"""The kept index family of operator 6, call by call, and hot sides, against all windows."""

import hashlib
import random
from collections import Counter

import pytest
from brute import remove_repeats
from llm_fixtures import docs_rows, none, odd  # noqa: F401

from matchlake.llm import substring_dedup as sd

COLS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def result(df):
    return sorted((tuple(r) for r in df.select(*COLS).collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def brute(rows, earlier, n=200):
    """What the batch ``rows`` loses, judged against itself and all rows before."""
    count = Counter(t[i:i + n] for t in ((t or "").encode() for _, t in rows + earlier) for i in range(len(t) - n + 1))
    out = []
    for d, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - n + 1):
            if count[raw[i:i + n]] > 1:
                gone[i:i + n] = b"\x01" * n
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def noise(rng, n):
    return "".join(rng.choice("abcdefgh ijé") for _ in range(n))


def test_batches_of_several_calls(spark, tmp_path):
    rng = random.Random(6)
    passages = [noise(rng, n) for n in (201, 260, 500, 900)]
    rows = [(i, noise(rng, rng.randrange(200)) + "".join(rng.choice(passages)[rng.randrange(60):] + noise(rng, 30) for _ in range(rng.randrange(3))))
            for i in range(40)] + [(None, passages[2]), (41, None), (41, ""), (42, "ab" * 300)]
    root, before = str(tmp_path / "family"), []
    for call in range(4):
        batch = rows[call::4]
        got = sd.remove_repeats(frame(spark, batch), family=root, earlier=frame(spark, before))
        assert result(got) == brute(batch, before)
        before += batch
    family = sd.LevelFamily(spark, root)
    assert [rank for rank, _ in family.levels] == [2] and family.version == 4


def test_a_call_that_dies_leaves_the_family(spark, tmp_path, monkeypatch):
    rng = random.Random(1)
    a, b = [(1, noise(rng, 400))], [(2, noise(rng, 400))]
    root = str(tmp_path / "family")
    sd.remove_repeats(frame(spark, a), family=root).count()
    with monkeypatch.context() as m:
        m.setattr(sd.uuid, "uuid4", lambda: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sd.LevelFamily(spark, root).add(sd.suffix_entries(sd._keyed(frame(spark, b), "doc_id", "text")))
    family = sd.LevelFamily(spark, root)
    assert family.version == 1 and len(family.levels) == 1
    both = a + [(3, a[0][1] + "!")]
    assert result(sd.remove_repeats(frame(spark, both[1:]), family=root, earlier=frame(spark, a))) == brute(both[1:], a)


def test_many_near_copies_give_few_rows(spark, monkeypatch):
    """1,000 copies of a passage, each with an edit of its own: rows joined at their sides stay a few a region."""
    rng = random.Random(2)
    body, rows = noise(rng, 700), []
    for d in range(1000):
        k = rng.randrange(700)
        rows.append((d, f"start {d} " + body[:k] + f"<{d}>" + body[k + 1:]))
    made = {}
    plain = sd.store

    def counted(df, name, **options):
        out = plain(df, name, **options)
        made[name] = made.get(name, 0) + out.count()
        return out
    monkeypatch.setattr(sd, "store", counted)
    assert result(sd.remove_repeats(frame(spark, rows))) == sorted(remove_repeats(rows), key=repr)
    # the windows of a region are up to 153
    assert made["pieces"] <= 16 * made["regions"] and made["single-runs"] <= 6 * made["regions"]


def test_sides_part_every_region(odd, none):
    rng = random.Random(9)
    raw = noise(rng, 3000).encode()
    first, count, lead, _ = sd.regions(raw)
    at, n, to, a, b = sd.sides(first, count, lead)
    assert n.sum() == count.sum() == len(raw) - 199 and (at[1:] == at[:-1] + n[:-1]).all()
    # what tells a side is inside all of its windows
    assert (a >= at + n - 1).all() and (b <= at + 200).all()
    assert sd.remove_repeats(none).count() == 0
