"""The corpus pipeline, stage by stage, against plain versions of its stages."""

import os

import duckdb
import pytest

import corpus_pipeline
from rowloom.llm import toxicity
from tests.helpers import frame
from tests.llm import brute

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")
def test_each_stage_matches_its_plain_version(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, ends = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        ends[name] = (docs, spark.read.parquet(f"{tmp_path}/{name}"))
        docs = ends[name][1]
        assert name == "bpe" or docs.columns == columns

    texts = lambda df: {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}
    before, after = map(texts, ends["toxicity"])
    grammar = toxicity.learn(toxicity.labelled_texts(ends["toxicity"][0], spark.read.parquet(f"{SF_DIR}/labels.parquet")))
    weights = [grammar.bias, *grammar.weights]
    score = lambda t: sum(w * x for w, x in zip(weights, [1.0, *toxicity.features(t, grammar)]))
    assert set(after) == {i for i, t in before.items() if score(t) < 0}

    before, after = map(texts, ends["near_duplicates"])
    ids = brute.component_ids(list(before.items()))
    assert set(after) == set(ids)

    before, after = map(texts, ends["decontamination"])
    items = duckdb.sql(f"SELECT text FROM '{SF_DIR}/benchmark.parquet'").fetchall()
    assert set(after) <= set(before)
    for i, text in before.items():
        if i not in after or len(text) < 4000:
            assert (i not in after) == any(brute.contaminated(text, item) for (item,) in items)

    before, after = map(texts, ends["secrets"])
    assert set(after) == set(before)
    for i, text in before.items():
        assert (after[i] != text) >= bool(brute.secret_base(text))
        assert not brute.secret_base(after[i])

    coded = ends["bpe"][1]
    assert {r.doc_id for r in coded.collect()} == set(after)
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, coded.collect()))


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "bpe"]


def test_odd_rows_pass_through(spark, tmp_path):
    """Nulls in any column, repeated rows, clashing columns and an empty table."""
    for folder, rows in (("odd", [(None, None, None, None, None, "x")] * 2 + [(1, "a", "en", "s", 1, None), (1, "a", "en", "s", 1, None), (2, "token = abcdefghijklmnop", None, None, None, "x")]), ("empty", [])):
        path = f"{tmp_path}/{folder}"
        docs = frame(spark, "doc_id long, text string, lang string, source string, n_chars long, blob string", *rows)
        docs.write.parquet(f"{path}/documents.parquet")
        frame(spark, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
        frame(spark, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
        kept = spark.read.parquet(f"{path}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            stage(spark, kept, path).write.parquet(f"{path}/{name}")
            kept = spark.read.parquet(f"{path}/{name}")
            assert kept.columns == docs.columns
        assert kept.count() == (3 if rows else 0)
        if rows:
            changed = kept.where("doc_id = 2").first()
            assert changed.text == "[SECRET]" and changed.n_chars == 8
        assert corpus_pipeline.run(spark, path).count() == kept.count()
