"""Mined phrases against plain counting, whatever the sample holds."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowloom.llm import phrases
from tests.helpers import frame
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, phrase string, n long, words string, slot int"


def rows(spark, texts):
    return frame(spark, SCHEMA, *[(i, t, lang, "p", 1, "w", 2) for i, (lang, t) in enumerate(texts)])


def random_texts(rng: random.Random, docs: int):
    for _ in range(docs):
        lang = rng.choice(["en", "de", None, "und"])
        words = [rng.choice("abcdefghijklmnop")[: rng.randint(0, 1)] or rng.choice(["The", "OF", "É"]) for _ in range(rng.randint(0, 60))]
        yield lang, "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "-", "!? "]) for w in words)


def got(df):
    return [tuple(r) for r in df.orderBy("lang", "rank").collect()]


@pytest.mark.parametrize("sampled, proposed", [(1, 1), (3, 1), (4, 3), (2, 10**9)])
def test_any_sample_gives_the_same_phrases(spark, sampled, proposed):
    """From a sample that holds everything to one that proposes nothing, so that the border fails twice."""
    texts = list(random_texts(random.Random(5), 400))
    found = phrases.mine_collocations(rows(spark, texts), sampled=sampled, proposed=proposed)
    assert got(found) == brute.collocations(texts)


def test_a_full_filter_changes_nothing(spark):
    """With 128 bits nearly every phrase meets a foreign bit."""
    texts = list(random_texts(random.Random(6), 200))
    assert got(phrases.mine_collocations(rows(spark, texts), proposed=3, filter_bits=128)) == brute.collocations(texts)


def test_parts_of_a_long_text(spark):
    texts = list(random_texts(random.Random(7), 60)) + [("en", "a b c " * 300)]
    assert got(phrases.mine_collocations(rows(spark, texts), best=5, portion=7)) == brute.collocations(texts, best=5)


def test_odd_rows(spark):
    same = [("en", "x y")] * 12 + [(None, "x y")] * 6 + [("und", "X Y")] * 6
    odd = [("en", None), ("en", ""), ("en", " ,. \n"), ("", "a" * 100_000), (None, None), ("en", "..." * 20_000)]
    expected = [("en", 1, "x y", 12, 12, 12, 24, 1_000_000), ("und", 1, "x y", 12, 12, 12, 24, 1_000_000)]
    assert got(phrases.mine_collocations(rows(spark, same + odd))) == expected == brute.collocations(same + odd)
    assert got(phrases.mine_collocations(rows(spark, same).limit(0))) == []
    assert got(phrases.mine_collocations(rows(spark, odd))) == []


def test_equal_scores_go_by_count_and_bytes(spark):
    texts = [("en", f"{a} {b}") for a, b, n in [("é", "x", 10), ("z", "y", 10), ("b", "a", 11), ("ａ", "q", 10)] for _ in range(n)]
    assert [r[2] for r in got(phrases.mine_collocations(rows(spark, texts)))] == ["b a", "z y", "é x", "ａ q"]


def test_no_task_ranks_a_whole_language(spark):
    scored = spark.range(2_000).select(F.lit("en").alias("lang"), F.col("id").cast("string").alias("phrase"), (F.col("id") % 7).alias("score"), F.col("id").alias("a"))
    found = phrases.top_phrases(scored, 5)
    assert [r.phrase for r in found.orderBy("rank").collect()] == ["1994", "1987", "1980", "1973", "1966"]
    assert found._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 2


def test_counts_past_64_bits(spark):
    """Products of counts near 10**12 are exact."""
    a = 999_999_999_989
    row = spark.createDataFrame([(a, a + 1, a + 2)], "a long, l long, r long")
    wide = lambda c: F.col(c).cast("decimal(15,0)")
    ratio = F.lit(1_000_000).cast("decimal(7,0)") * (wide("a") * wide("a"))
    score = row.select(F.call_function("div", ratio, wide("l") * wide("r"))).first()[0]
    assert score == 1_000_000 * a * a // ((a + 1) * (a + 2))


def test_brute_force_counts_overlaps():
    assert brute.collocations([("en", "a a a a a a a a a a a")])[0][3:5] == (10, 11)
    assert Counter(r[0] for r in brute.collocations([("en", "p q. " * 10), (None, "p q. " * 10)])) == Counter(en=1, und=1)
