from __future__ import annotations

import random

import numpy as np
import pytest

from civicmart.llm import quality

SHORT = "the of and to in is it for on with".split()
LONG = [a + b + c for a in ("ba", "ke", "mi", "sol") for b in ("ran", "tel", "ver", "dor", "lis") for c in ("a", "en", "ing", "ous")]
WORDS = SHORT * 4 + LONG


def good(rng):
    return " ".join(rng.choice(WORDS) + ("." if i % 9 == 8 else "") for i in range(rng.randint(60, 120)))


def junk(rng):
    kind = rng.randrange(3)
    words = good(rng).split()
    if kind == 0:
        return " ".join(w.upper() + "!!" for w in words)
    if kind == 1:
        return " ".join(w + rng.choice(["***", "%%%", "$$$"]) for w in words)
    return " ".join(w for w in words[:12] for _ in range(8))


@pytest.fixture(scope="module")
def made():
    rng = random.Random(8)
    rows = []
    for i in range(600):
        bad, toxic = i % 6 == 0, i % 10 == 1
        text = junk(rng) if bad else good(rng)
        if toxic:
            words = text.split()
            for _ in range(8):
                words.insert(rng.randrange(len(words)), "zurka" + rng.choice("abc"))
            text = " ".join(words)
        rows.append((i, text, int(not bad), int(toxic)))
    return rows


def test_held_out_accuracy(spark, docs, made):
    labels = spark.createDataFrame([(i, q, t) for i, _, q, t in made if i % 2], "doc_id long, quality int, toxic int")
    judged = quality.judged(docs([(i, x) for i, x, _, _ in made]), labels).select("doc_id", "__p.*").collect()
    truth = {i: (q, t) for i, _, q, t in made}
    held = [r for r in judged if r.doc_id % 2 == 0]
    assert sum((r.low_quality >= 0.5) == (truth[r.doc_id][0] == 0) for r in held) / len(held) > 0.97
    clean = [r for r in judged if truth[r.doc_id] == (1, 0)]
    assert sum(r.low_quality < 0.5 and r.toxic < 0.5 for r in clean) / len(clean) > 0.97
    toxic = [r for r in judged if truth[r.doc_id] == (1, 1)]
    assert sum(r.toxic >= 0.5 for r in toxic) / len(toxic) > 0.8


def test_without_labels_the_heuristics_decide(spark, docs, made):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    frame = docs([(i, x) for i, x, _, _ in made])
    kept = quality.accepted(frame, none)
    assert kept.columns == frame.columns
    ids = {r.doc_id for r in kept.collect()}
    assert sum(i in ids for i, _, q, _ in made if q) / sum(q for *_, q, _ in made) > 0.97
    assert sum(i not in ids for i, _, q, _ in made if not q) / sum(not q for *_, q, _ in made) > 0.9


def test_nulls_blanks_repeats_long_texts_and_empty(spark, docs, made):
    labels = spark.createDataFrame(
        [(1, 1, None), (1, 0, 1), (None, 0, 0), (2, None, None)], "doc_id long, quality int, toxic int"
    )
    rows = [(1, None), (2, " \n"), (3, made[1][1]), (3, made[1][1]), (None, made[2][1]), (4, "word " * 50000)]
    out = quality.judged(docs(rows), labels).select("doc_id", "__p.*").collect()
    assert len(out) == 6
    assert {r.doc_id: r.low_quality for r in out if r.doc_id in (1, 2)} == {1: 1.0, 2: 1.0}
    assert quality.judged(docs([]), labels).count() == 0


def test_expectation_maximisation_finds_accurate_labelers():
    patterns = [("000", 500.0), ("111", 150.0), ("11-", 50.0), ("001", 100.0), ("110", 60.0), ("-00", 100.0)]
    share, given = quality.accuracies(patterns)
    assert 0.15 < share < 0.45
    assert given[0][1]["1"] > 0.9 and given[1][1]["1"] > 0.9 > given[2][1]["1"]


def test_scores_do_not_depend_on_what_a_worker_keeps(monkeypatch):
    rng = np.random.default_rng(1)
    weights, bias = rng.normal(size=(2, quality.DIMENSIONS)).astype(np.float32), np.array([0.1, -0.2])
    texts = ["one two two three", None, "four one five!!", "two two"]
    whole = quality.Scorer(weights, bias).probabilities(texts)
    monkeypatch.setattr(quality, "_WEIGHTS_KEPT", 2)
    scorer = quality.Scorer(weights, bias)
    assert np.allclose([scorer.probabilities([t])[0] for t in texts], whole)
    places, values = quality.features(texts[0])
    assert np.isclose(quality._sigmoid(float(weights[0, places] @ values) + 0.1), whole[0][0], atol=1e-4)


def test_held_out_toxic_texts_among_words_met_once(spark, docs, made):
    """Every text has many words of its own, which must not stand for its label; another alphabet's insults are met."""
    rng = random.Random(9)
    rows = []
    for i, (_, text, _, _) in enumerate([m for m in made if (m[2], m[3]) == (1, 0)]):
        words = text.split() + ["".join(rng.choices("aeioulmnrst", k=7)) for _ in range(120)]
        if i % 8 < 2:
            marks = ["idiot", "moron", "scum"] if i % 8 else ["žebrák" + rng.choice("aeiou") + rng.choice("mnr")]
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(marks))
        rows.append((i, " ".join(words), int(i % 8 < 2)))
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows if i % 16 < 8], "doc_id long, quality int, toxic int")
    judged = quality.judged(docs([(i, x) for i, x, _ in rows]), labels).select("doc_id", "__p.toxic").collect()
    held = {r.doc_id: r.toxic >= 0.5 for r in judged if r.doc_id % 16 >= 8}
    toxic = [held[i] for i, _, t in rows if i in held and t]
    clean = [held[i] for i, _, t in rows if i in held and not t]
    assert len(toxic) > 40 and sum(toxic) / len(toxic) >= 0.9, sum(toxic) / len(toxic)
    assert sum(clean) / len(clean) <= 0.02, sum(clean) / len(clean)


def test_the_classifier_drops_what_packing_left_in_its_workers(spark, docs):
    """Both together passed an executor's limit when the pipeline ran again in one session."""
    from civicmart.llm import packing
    from civicmart.llm.queries import tokenizer_path

    rows = docs([(1, "some words of a text"), (2, "and of another")]).coalesce(1)

    def kept(batches):
        from civicmart.llm import common

        for batch in batches:
            batch["n"] = len(common._held)
            yield batch[["n"]]

    def holding():
        return {r.n for _ in range(3) for r in rows.mapInPandas(kept, "n long").collect()}

    packing.tokenized(rows, tokenizer_path()).count()
    assert holding() <= {0, 1}
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    quality.judged(rows.select("doc_id", "text"), labels).collect()
    assert 0 in holding()


def test_a_worker_holds_one_thing():
    import weakref

    from civicmart.llm import common

    class Loaded:
        def __init__(self):
            self.me = self

    first = common.held("a", Loaded)
    assert common.held("a", Loaded) is first
    seen = weakref.ref(first)
    del first
    common.held("b", Loaded)
    assert seen() is None
    common.drop_held()
    assert common._held == {}
