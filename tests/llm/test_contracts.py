"""The registered text queries against brute force, round trips and held-out accuracy."""

import os
import zlib

import duckdb
import pytest

import __spark_entry__ as entry
from rowloom.llm import licenses
from rowloom.llm.queries import LLM_QUERIES, vocabulary
from rowloom.llm.oracles import LLM_ORACLES
from tests.check_oracles import compare, connect
from tests.llm import brute

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def sql():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def texts():
    return duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF_DIR}/documents.parquet'").fetchall()


def rows(spark, name):
    return [r.asDict() for r in LLM_QUERIES[name](spark, SF_DIR).collect()]


def by_id(spark, name, n):
    found = rows(spark, name)
    assert len(found) == n
    return {r["doc_id"]: r for r in found}


def test_all_are_registered():
    assert [int(n[2:].split("_")[0]) for n in LLM_QUERIES] == list(range(1, len(LLM_QUERIES) + 1))
    assert set(LLM_QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(LLM_ORACLES) <= set(LLM_QUERIES)


@pytest.mark.parametrize("name", list(LLM_ORACLES))
def test_against_sql(spark, sql, name):
    assert compare(LLM_QUERIES[name](spark, SF_DIR), sql, LLM_ORACLES[name]) is None


def test_licenses(spark, texts):
    found = by_id(spark, "op1_license_scan", len(texts))
    phrases = {t.label: t.words for t in licenses.PHRASES}
    for doc_id, text in texts:
        n_words, places = brute.license_places(text, phrases)
        r, starts = found[doc_id], [w for _, w in places]
        assert (r["n_words"], r["n_base"]) == (n_words, len(places))
        assert (r["first_word"], r["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted({label for label, _ in places}))
        labels = {label for label, _ in places}
        labels |= {label for label, _, _ in brute.license_matches(text, licenses.NOTICES + licenses.WHOLE)}
        assert r["labels"] == ",".join(sorted(labels))


def test_bpe(spark, texts):
    tokenizers = pytest.importorskip("tokenizers")
    tokenizer = tokenizers.Tokenizer.from_file(vocabulary())
    found = by_id(spark, "op2_bpe", len(texts))
    for doc_id, text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert found[doc_id] == {
            "doc_id": doc_id,
            "n_tokens": len(ids),
            "ids_sha256": brute.sha256(" ".join(map(str, ids))),
            "decoded_sha256": brute.sha256(tokenizer.decode(ids, skip_special_tokens=False)),
        }


def test_toxicity_on_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"  # enough held-out labels to judge
    if not os.path.isdir(sf_dir):
        pytest.skip("driver tables not present")
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf_dir}/labels.parquet'").fetchall())
    held = []
    for r in LLM_QUERIES["op3_toxicity"](spark, sf_dir).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        if r["held_out"] and r["doc_id"] in labels:
            held.append((labels[r["doc_id"]], r["predicted"], r["score"]))
    assert sum(t == p for t, p, _ in held) / len(held) >= 0.95
    toxic, fine = [s for t, _, s in held if t], [s for t, _, s in held if not t]
    wins = sum((a > b) + (a == b) / 2 for a in toxic for b in fine)
    assert wins / (len(toxic) * len(fine)) >= 0.95


def test_simhash(spark, texts):
    found = by_id(spark, "op4_simhash", len(texts))
    expected = brute.component_ids(texts)
    for (doc_id, text), component in zip(texts, expected):
        assert found[doc_id]["fingerprint"] == f"{brute.fingerprint(text):016x}"
        assert found[doc_id]["component_id"] == component


def test_secrets(spark, texts):
    found = by_id(spark, "op5_secret_scan", len(texts))
    for doc_id, text in texts:
        base = brute.secret_base(text)
        r = found[doc_id]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [
            sum(k == kind for k, _, _ in base) for kind in ("assign", "access", "hex")
        ]
        joined = [f"{k}:{a}:{b}" for k, a, b in base]
        assert r["base_sha256"] == brute.sha256(",".join(joined))
        assert set(joined) <= set(r["spans"].split(",")) or not joined


def test_personal_data(spark, texts):
    found = by_id(spark, "op6_personal_data", len(texts))
    lost = brute.disclosing_terms([t for _, t in texts], 0.9, 3, 4)
    for (doc_id, text), terms in zip(texts, lost):
        base = brute.personal_base(text)
        r = found[doc_id]
        assert [r[f"n_{k}"] for k in base] == [len(v) for v in base.values()]
        spans = [s for v in base.values() for s in v]
        assert r["base_sha256"] == brute.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans))
        own = [
            ("term", m.start(), m.end())
            for m in brute.TERM.finditer(text)
            if m[0].lower() in terms and not any(a < m.end() and m.start() < b for _, a, b in spans)
        ]
        assert r["spans"] == ",".join(f"{k}:{a}:{b}" for k, a, b in spans + own)


def test_quality(spark, texts):
    found = by_id(spark, "op7_quality", len(texts))
    for doc_id, text in texts:
        r = found[doc_id]
        m = brute.measures(text)
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == m
        assert r["base_failed"] == (m[0] < 50 or 100 * m[4] > 50 * m[0])
        assert not (r["base_failed"] and r["kept"])


def test_decontamination(spark, texts):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF_DIR}/benchmark.parquet'").fetchall()
    found = {(r["doc_id"], r["item_id"]) for r in rows(spark, "op8_decontamination")}
    short = [(d, t) for d, t in texts if len(t) < 6000 or any(d == x for x, _ in found)]
    expected = {(d, i) for d, t in short for i, b in items if brute.contaminated(t, b)}
    assert expected == {(d, i) for d, i in found if d in {x for x, _ in short}}
    assert expected


def test_warc(spark):
    pages = duckdb.sql(f"SELECT page_id, html FROM '{SF_DIR}/pages.parquet'").fetchall()
    found = {tuple(r.values()) for r in rows(spark, "op9_warc")}
    assert found == brute.archived(pages)


def test_sharding(spark, texts):
    found = by_id(spark, "op10_sharding", len(texts))
    sources = dict(duckdb.sql(f"SELECT doc_id, source FROM '{SF_DIR}/documents.parquet'").fetchall())
    for doc_id, text in texts:
        assert found[doc_id]["size"] == len(text.encode()) + 16
        assert found[doc_id]["text_crc32"] == brute.crc(text)
    slots: dict[int, list[int]] = {s: [] for s in range(40)}
    mixture: dict[tuple, int] = {}
    for doc_id, r in found.items():
        slots[r["shard"]].append(r["slot"])
        key = (r["shard"], sources[doc_id])
        mixture[key] = mixture.get(key, 0) + 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    for source in set(sources.values()):
        share = sum(s == source for s in sources.values()) / 40
        assert all(abs(mixture.get((s, source), 0) - share) <= 2 for s in range(40))
