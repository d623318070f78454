"""Periodic runs against a version that tries every period."""

import os
import random
import time
from collections import Counter

import duckdb
import numpy as np
import pytest

from rowloom.llm import runs
from rowloom.llm.queries import LLM_QUERIES
from tests.helpers import frame
from tests.llm import brute

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def periodic_text(rng: random.Random, longest: int = 300) -> list[bytes]:
    letters = rng.choice([1, 2, 3, 8, 50])
    words = [b"%d" % rng.randrange(letters) for _ in range(rng.randint(0, longest))]
    for _ in range(rng.randint(0, 3)):
        if words:
            at, period, turns = rng.randrange(len(words)), rng.randint(1, 40), rng.randint(1, 8)
            words[at:at] = (words[at : at + period] * turns)[: rng.randint(1, period * turns)]
    return words


def test_transforms_give_the_squared_differences():
    rng = random.Random(1)
    words = [rng.randrange(5) for _ in range(400)]
    for block, nearest in ((8, 0), (8, 8), (16, 16), (64, 64)):
        starts = [0, 5, 17, 200]
        found = runs.mismatches(np.array(words, np.uint64), np.array(starts), block, nearest)
        for column, s in enumerate(starts):
            for t in range(block):
                expected = sum((words[s + i] - words[s + nearest + t + i]) ** 2 for i in range(block))
                assert int(found[t, column]) == expected


def test_every_run_is_found_among_neighbouring_texts():
    rng = random.Random(2)
    for _ in range(150):
        texts = [periodic_text(rng) for _ in range(rng.randint(1, 6))]
        assert [list(map(tuple, r.tolist())) for r in runs.runs_of(texts)] == [brute.periodic_runs(t) for t in texts]


def test_long_periods_and_the_shortest_runs():
    rng = random.Random(3)
    word = lambda: b"%d" % rng.randrange(10**6)
    for period in (1, 7, 8, 15, 16, 31, 32, 100, 127, 128, 700):
        own = [word() for _ in range(period)]
        for length in (max(24, 3 * period) - 1, max(24, 3 * period), 4 * period + 30):
            for lead in (0, 1, 7, 13):
                text = [word() for _ in range(lead)] + (own * 70)[:length] + [word() for _ in range(5)]
                expected = [(lead, length, period)] if length >= max(24, 3 * period) else []
                assert list(map(tuple, runs.runs_of([text])[0].tolist())) == expected


def test_long_texts_take_seconds():
    began = time.time()
    n, a, b = 300_000, [b"a"], [b"a", b"b"]
    while len(b) < n:
        a, b = b, b + a
    texts = [[b"x"] * n, [b"x"] * (n // 2) + [b"%d" % i for i in range(n // 2)], ([b"x"] * 999 + [b"y"]) * (n // 1000), b[:n]]
    assert [len(runs.runs_of([t])[0]) for t in texts[:3]] == [1, 1, 301]
    assert len(runs.runs_of([texts[3]])[0]) > 1000
    assert time.time() - began < 60


def test_odd_rows(spark):
    schema = "doc_id long, text string, runs string, n_words long, collapsed string"
    odd = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (None, "a " * 24), (None, "a " * 24), (5, "a\x1ca a\xa0a " * 30), (6, "x" * 50_000)]
    docs = frame(spark, schema, *[(*r, "r", 1, "c") for r in odd])
    got = Counter((r.doc_id, tuple(map(tuple, r.runs)), r.collapsed) for r in runs.find_periodic_runs(docs).collect())
    plain = lambda t: brute.blank_words(t or "")
    cut = lambda t, found: " ".join(w for i, w in enumerate(t) if not any(s + p <= i < s + n for s, n, p in found))
    assert got == Counter(
        (d, tuple(brute.periodic_runs(plain(t))), cut(plain(t), brute.periodic_runs(plain(t)))) for d, t in odd
    )
    assert runs.find_periodic_runs(docs.limit(0)).count() == 0


def test_planted_rows(spark, tmp_path):
    """Every tenth id or so repeats its own words, from lengths of one word on."""
    rng = random.Random(4)
    texts = [" ".join("%d" % rng.randrange(9) for _ in range(rng.choice([0, 1, 2, 30, 120]))) for _ in range(300)] + [None]
    frame(spark, "doc_id long, text string", *enumerate(texts)).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(map(tuple, LLM_QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()))
    assert got == Counter(brute.run_row(*r) for r in enumerate(texts))
    assert sum(r[1] > 0 for r in got) > 5


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
def test_whole_table(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall()
    got = Counter(map(tuple, LLM_QUERIES["op11_periodic_runs"](spark, SF_DIR).collect()))
    assert got == Counter(brute.run_row(*r) for r in rows)
