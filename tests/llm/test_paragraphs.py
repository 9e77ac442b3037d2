from __future__ import annotations

import random

from civicmart.llm import paragraphs as par


def text_of(rng, n):
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(n)]
    return " ".join(w + ("." if i % 7 == 6 else "") for i, w in enumerate(words))


def flagged(found):
    return {r.doc_id for r in found.collect() if r.removed}


def test_an_inserted_passage_is_found_and_clean_documents_are_not(spark, docs):
    rng = random.Random(1)
    passage = text_of(rng, 70)
    rows = [(i, f"{text_of(rng, 60)} {passage} {text_of(rng, 60)}") for i in range(10)]
    rows += [(100 + i, text_of(rng, 200)) for i in range(20)]
    found = par.repeated_passages(docs(rows))
    assert flagged(found) == set(range(1, 10))
    assert {r.first_doc_id for r in found.collect()} == {0}


def test_near_copies_are_verified_by_their_sets(spark, docs):
    rng = random.Random(2)
    base = [f"u{i}" for i in range(60)]
    near, far = list(base), list(base)
    near[30] = "changed"
    for i in range(0, 60, 6):
        far[i] = f"other{i}"
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far)), (4, text_of(rng, 40))]
    assert len(par.shingles(base) & par.shingles(near)) / len(par.shingles(base) | par.shingles(near)) >= 0.8
    assert flagged(par.repeated_passages(docs(rows))) == {2}


def test_tiles_give_the_same_classes(spark, docs):
    rng = random.Random(3)
    base = [f"v{i}" for i in range(50)]
    rows = []
    for i in range(40):
        copy = list(base)
        copy[rng.randrange(50)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    found = par.occurrences(docs(rows)).select("text_id", "said", "bands")
    small, large = ({(r.a, r.b) for r in par.links(found, tile_rows=n).collect()} for n in (7, 1000))
    from civicmart.llm.components import forest

    assert {n for n, _ in forest(small)} == {n for n, _ in forest(large)}
    assert len(small) < 40 * par.tuned_bands()[0] * 21


def test_short_lines_nulls_repeats_and_empty(spark, docs):
    line = "a short common line that everyone has here."
    rng = random.Random(4)
    rows = [(i, f"{text_of(rng, 30)}\n{line}") for i in range(8)] + [(50, None), (51, ""), (None, text_of(rng, 40))]
    assert flagged(par.repeated_passages(docs(rows))) == set()
    twice = text_of(rng, 60)
    again = par.repeated_passages(docs([(7, twice), (7, twice)])).collect()
    assert len({r.row_id for r in again if r.removed}) == 1
    assert par.repeated_passages(docs([])).count() == 0


def test_very_long_text(spark, docs):
    rng = random.Random(6)
    long = text_of(rng, 20000)
    assert flagged(par.repeated_passages(docs([(1, long), (2, long)]))) == {2}


def test_every_word_lies_in_one_paragraph():
    rng = random.Random(7)
    lines = [text_of(rng, rng.choice([1, 3, 7, 8, 9, 30, 100])) for _ in range(200)]
    text = "\n".join(lines)
    cut = list(par.paragraphs(text))
    assert [n for n, _ in cut] == list(range(len(cut)))
    assert [w for _, words in cut for w in words] == text.lower().split()
    short = [words for _, words in cut if len(words) < par.LEAST_WORDS]
    assert sorted(" ".join(w) for w in short) == sorted(line.lower() for line in lines if len(line.split()) < par.LEAST_WORDS)


def test_tuned_bands():
    assert par.tuned_bands(0.8, 0.99) == (5, 2)
    assert par.tuned_bands(0.8, 0.98) == (4, 2)
    assert par.tuned_bands(0.95, 0.8) == (1, 4)


def test_short_lines_are_compared_by_equality_and_removed_in_long_runs(spark, docs):
    rng = random.Random(8)
    menu = "\n".join(text_of(rng, 5) for _ in range(6))
    rows = [(i, f"{text_of(rng, 30)}\n{menu}") for i in range(4)]
    assert flagged(par.repeated_passages(docs(rows))) == {1, 2, 3}
    assert flagged(par.repeated_passages(docs(rows), least_run=31)) == set()
    one = [(i, f"{text_of(rng, 30)}\nonly five words stand here") for i in range(3)]
    assert flagged(par.repeated_passages(docs(one))) == set()
    assert flagged(par.repeated_passages(docs(one), least_run=5)) == {1, 2}


def test_recall_of_links_against_brute_force(spark):
    """All pairs by exact Jaccard; similarities lie between 0.8 and 1, many close to 0.8."""
    rng = random.Random(9)
    said = []
    for _ in range(400):
        words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(rng.randint(52, 62))]
        said += [list(words), list(words)]
        said[-1][rng.randrange(5, 40)] = "changed"
        said[-1] = said[-1][: len(words) - rng.randint(0, 1)]
    sets = [par.shingles(w) for w in said]
    # The words differ from base to base, so only a base and its copy can be alike.
    true = {(i, i + 1) for i in range(0, len(said), 2) if len(sets[i] & sets[i + 1]) >= 0.8 * len(sets[i] | sets[i + 1])}
    assert len(true) > 200
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(said)], "doc_id long, text string")
    found = par.occurrences(docs)
    name = {r.text_id: r.doc_id for r in found.collect()}
    linked = {tuple(sorted((name[r.a], name[r.b]))) for r in par.links(found.select("text_id", "said", "bands")).collect()}
    assert linked <= true
    assert len(linked) >= 0.97 * len(true)


def test_classes_equal_brute_force(spark, docs):
    """Every paragraph against every other by exact Jaccard; unlike texts never join a class."""
    rng = random.Random(10)
    base = [text_of(rng, 40) for _ in range(12)]
    rows = []
    for i in range(60):
        words = rng.choice(base).split()
        words[rng.randrange(10, 30)] = rng.choice(["one", "two", words[0]])
        rows.append((i, " ".join(words)))
    cut = [(i, n, tuple(words)) for i, text in rows for n, words in par.paragraphs(text)]
    from civicmart.llm.components import forest

    sets = [par.shingles(list(w)) for _, _, w in cut]
    pairs = [
        (a, b) for a in range(len(cut)) for b in range(a)
        if cut[a][2] == cut[b][2] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    head = dict(forest(pairs))
    expected = {(cut[a][0], cut[a][1], *cut[h][:2]) for a, h in head.items()}
    got = {(r.doc_id, r.paragraph, r.first_doc_id, r.first_paragraph) for r in par.repeated_passages(docs(rows), least_run=1).collect() if r.removed}
    assert got <= expected
    assert len(got) >= 0.97 * len(expected)


def test_passages_that_begin_and_end_inside_sentences_are_found(spark, docs):
    """Of a passage whose only whole paragraph is short, nothing was found."""
    rng = random.Random(11)
    rows, passages = [], [text_of(rng, 52) for _ in range(40)]
    for i in range(80):
        rows.append((i, f"{text_of(rng, 40).rstrip('.')} {passages[i % 40]} {text_of(rng, 40)}"))
    clean = [(100 + i, text_of(rng, 150)) for i in range(40)]
    got = par.repeated_passages(docs(rows + clean)).collect()
    assert not {r.doc_id for r in got} & {i for i, _ in clean}
    cut = {i: [tuple(w) for _, w in par.paragraphs(t)] for i, t in rows}
    whole = {i for i in range(80) if set(cut[i]) & set(cut[(i + 40) % 80])}
    alone = {i for i in whole if sum(map(len, set(cut[i]) & set(cut[(i + 40) % 80]))) < par.LEAST_RUN}
    assert alone and whole <= {r.doc_id for r in got}


def test_across_tells_repeats_of_other_documents_from_those_of_its_own(spark, docs):
    rng = random.Random(12)
    own, common = text_of(rng, 40), text_of(rng, 60)
    rows = [(1, f"{own}\n{own}"), (2, common), (3, common), (4, text_of(rng, 60))]
    got = par.repeated_passages(docs(rows)).collect()
    assert {(r.doc_id, r.across) for r in got} == {(1, False), (2, True), (3, True)}
    assert {r.doc_id for r in got if r.removed} == {1, 3}
