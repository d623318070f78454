"""Terms that give protected entities away, in a table that holds some, against brute force and SQL."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from rowloom.llm import pii
from rowloom.llm.oracles import LLM_ORACLES
from rowloom.llm.queries import LLM_QUERIES
from tests.helpers import frame
from tests.llm import brute


def documents() -> list[str]:
    rng = random.Random(31)
    filler = lambda n: " ".join(rng.choice(["lorem", "ipsum", "dolor", "amet", "sit", "elit"]) for _ in range(n))
    texts = [filler(12) for _ in range(60)]
    texts += [f"{filler(5)} Zephyrine writes from anna@mail.example {filler(i)}" for i in range(4)]
    texts += [f"{filler(4)} call corvidae at +49 30 1234567 {filler(i)}" for i in range(9)] + ["corvidae alone"]
    texts += [f"once only: quokka and bob{i}@mail.example" for i in range(3)]
    texts += ["anna@mail.example and joanna@mail.example share mail, Zephyrine", texts[62], texts[62]]
    texts += ["x-4111-1111-1111-1111 of +41 1111 1111 11a@b.example", "4111 1111 1111 1111 1.2.3.4@b.example, Zephyrine"]
    return texts


def test_terms_are_found_and_treated(spark, tmp_path):
    texts = documents()
    frame(spark, "doc_id long, text string", *enumerate(texts)).write.parquet(f"{tmp_path}/documents.parquet")
    found = LLM_QUERIES["op6_personal_data"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    expected = con.execute(f"SELECT {', '.join(found.columns)} FROM ({LLM_ORACLES['op6_personal_data']})").fetchall()
    got = sorted(map(tuple, found.collect()))
    assert got == sorted(expected)
    assert sum("term:" in r[-1] for r in got) >= 10
    treated = pii.find_personal_data(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    lost = brute.disclosing_terms(texts, 0.9, 3, 4)
    for r in treated.collect():
        own = {texts[r.doc_id][s.start : s.end].lower(): s.found for s in r.term}
        assert own == {t: how for t, how in lost[r.doc_id].items()}, r.doc_id
    assert {how for own in lost for how in own.values()} == {"remove", "generalise"}


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_many_addresses_and_terms_in_one_text(spark, monkeypatch, broadcast):
    """3,000 addresses beside 3,000 terms: none of them stands in other texts, so none is paired."""
    monkeypatch.setattr(pii, "BROADCAST_TERMS", broadcast)
    text = " ".join(f"user{i}@mail.example term{i}x" for i in range(3_000))
    docs = frame(spark, "doc_id long, text string", (1, text), (2, text), *[(3 + i, t) for i, t in enumerate(documents())])
    found = pii.find_personal_data(docs)
    sizes = {r.doc_id: (r.n, r.t) for r in found.select("doc_id", F.size("email").alias("n"), F.size("term").alias("t")).collect()}
    assert sizes[1] == sizes[2] == (3_000, 0)
    assert sum(t > 0 for _, t in sizes.values()) >= 10
