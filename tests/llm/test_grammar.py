"""The toxicity grammar against all paths through its transducers one after the other, and what its context changes."""

import random
import time
from dataclasses import replace
from functools import lru_cache

from pyspark.sql import functions as F

from rowloom.llm import toxicity
from tests.helpers import frame

SYMBOLS = ["insult", "threat", "word", "word", "word", "target", "negation", "report", "break"]
FACTORS = (1.25, 0.25, 0.4)


@lru_cache(maxsize=4)
def tables(factors):
    return [(t.table(), t.start, t.ends) for t in toxicity.cascade(*factors)]


def outputs(table, start, ends, reads):
    """Every (factors, writings) of one transducer over one sequence."""
    paths = [(start, (), ())]
    for symbol in reads:
        paths = [(a.to, (*f, a.factor), (*w, a.writes)) for s, f, w in paths for a in table.get((s, symbol), ())]
    return [(f, w) for s, f, w in paths if s in ends]


def all_paths(symbols, factors=FACTORS):
    """Weight and writings of the best of all paths through the transducers, applied one after the other."""
    reading = [((1.0,) * len(symbols), tuple(s for s, _ in symbols))]
    for transducer in tables(factors):
        reading = [
            (tuple(x * y for x, y in zip(f, g)), w) for f, reads in reading for g, w in outputs(*transducer, reads)
        ]
    weigh = lambda f: sum(w * x for (_, w), x in zip(symbols, f))
    scored = [(weigh(f), sum(m.count(" ") for m, (_, x) in zip(w, symbols) if x), [m for m, (_, x) in zip(w, symbols) if x]) for f, w in reading]
    return max(scored, key=lambda r: (round(r[0], 9), r[1]))


def weighted(symbols, rng):
    return [(s, {"insult": rng.choice([0.6, 1.0]), "threat": 0.5}.get(s, 0.0)) for s in symbols]


def test_the_composed_transducer_finds_the_best_of_all_paths():
    rng = random.Random(8)
    for _ in range(250):
        symbols = weighted([rng.choice(SYMBOLS) for _ in range(rng.randint(0, 9))], rng)
        weight, marks = toxicity.best_path(symbols, *toxicity.context(*FACTORS))
        expected = all_paths(symbols)
        assert abs(weight - expected[0]) < 1e-9 and len(marks) == len(expected[2])
        assert sum(m.count(" ") for m in marks) == expected[1]


def test_long_runs_of_plain_words_change_nothing():
    rng, lexicon = random.Random(9), toxicity.Lexicon({"idiot$": 1.0, "moro": 0.7})
    words = ["idiot", "morons", "kill", "you", "not", "said", ",", "plain", "plain"]
    for _ in range(100):
        text = " ".join(rng.choice(words) if rng.random() < 0.6 else "plain " * rng.randint(1, 20) for _ in range(12))
        ((_, cut),) = toxicity.clauses(text, lexicon)
        whole = [("break", 0.0) if w == "," else lexicon.read(w)[:2] for w in text.split()]
        if cut:
            table = toxicity.context(*FACTORS)
            a, b = (toxicity.best_path(s, *table) for s in ([s[:2] for s in cut], whole))
            assert abs(a[0] - b[0]) < 1e-9 and a[1] == b[1]


def marks_of(text, stems=("idiot$", "moron$")):
    lexicon = toxicity.Lexicon(dict.fromkeys(stems, 1.0))
    ((_, symbols),) = toxicity.clauses(text, lexicon)
    return toxicity.best_path([s[:2] for s in symbols], *toxicity.context(*FACTORS)) if symbols else (0.0, [])


def test_what_the_context_marks():
    assert marks_of("what an idiot") == (1.0, ["insult"])
    assert marks_of("you idiot") == (1.25, ["insult aimed"])
    assert marks_of("an idiot is what all of you") == (1.0, ["insult"])  # out of reach
    assert marks_of("an idiot like you") == (1.25, ["insult aimed"])
    assert marks_of("it is not an idiot") == (0.25, ["insult negated"])
    assert marks_of("not now, an idiot") == (1.0, ["insult"])
    assert marks_of("the paper called it, idiot") == (0.4, ["insult reported"])
    assert marks_of("a kill switch") == (0.0, ["threat"])
    assert marks_of("we will kill you") == (0.625, ["threat aimed"])
    _, marks = marks_of("she said you are not an idiot or moron")
    assert marks == ["insult negated reported aimed", "insult negated reported"]


def learned(spark):
    rng = random.Random(10)
    word = lambda: rng.choice(["lo", "mi", "ra", "suvel", "dino", "terka", "of", "and"]) + rng.choice(["", "en", "or"])
    rows = []
    for i in range(300):
        words = [word() for _ in range(rng.randint(30, 120))]
        if i % 3 == 0:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron", "scum", "loser"]))
        rows.append((" ".join(words) + ".", int(i % 3 == 0)))
    return toxicity.learn(frame(spark, "text string, label int", *rows))


def test_context_decides_over_negated_and_reported_clauses(spark):
    """With the factors of context switched off, clauses that deny or quote an insult are taken for insults."""
    grammar = learned(spark)
    loose = replace(grammar, aimed=1.0, negated=1.0, reported=1.0)
    filler = "lo mien ra and dino of suvelor terka. " * 4
    said = ["you are an idiot.", "what a moron.", "these people are scum.", "you loser."]
    denied = ["it is not an idiot.", "they were never scum.", "it is no moron.", "nor is it a loser."]
    quoted = ["the paper called it an idiot.", "they wrote that it is a moron.", "it says scum.", "the note said a loser."]
    score = lambda texts, g: [r.s for r in frame(spark, "n int, text string", *enumerate(texts)).select("n", toxicity.score(F.col("text"), g).alias("s")).orderBy("n").collect()]
    context = lambda t: filler + t + " " + filler
    assert min(score(map(context, said), grammar)) >= 0.5
    assert max(score(map(context, denied + quoted), grammar)) < 0.5

    def unmarked(text):
        """The features when marks are not looked at either."""
        found = toxicity.features(text, loose)
        return found[toxicity.FEATURES.index("largest")]

    assert all(unmarked(context(t)) >= 0.9 * unmarked(context("what an idiot.")) for t in denied[:1])
    assert all(toxicity.features(context(t), grammar)[2] < 0.5 * unmarked(context(t)) for t in denied + quoted)


def test_long_texts_take_seconds(spark):
    grammar = toxicity.Grammar({"idiot$": 1.0}, 0.0, (0.0,) * len(toxicity.FEATURES))
    for text in ("idiot " * 150_000, "you not said idiot kill, " * 40_000, "x" * 1_000_000, "idiot plain " * 80_000):
        began = time.time()
        assert len(toxicity.features(text, grammar)) == len(toxicity.FEATURES)
        assert time.time() - began < 30
