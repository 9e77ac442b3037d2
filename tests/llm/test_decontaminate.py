from __future__ import annotations

import random
import re

from civicmart.llm import decontaminate as dec


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    out = []
    for doc, text in docs:
        ws, hit, found = words(text), set(), set()
        for item, said in items:
            iw = words(said)
            size = min(13, len(iw))
            windows = {tuple(iw[i : i + size]) for i in range(len(iw) - size + 1)} if size else set()
            for i in range(len(ws) - size + 1 if size else 0):
                if tuple(ws[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    if item is not None:
                        found.add(str(item))
        out.append((doc, len(ws), len(hit), sorted(found)))
    return sorted(out, key=repr)


def spark_rows(spark, docs, items):
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, shingle int")
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, words int")
    found = dec.contamination(frame, bench).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in found), key=repr)


def test_equals_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "été", "x9"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 4, 5, 12, 13, 14, 30])))) for i in range(25)]
    items += [(7, items[0][1]), (None, " ".join(rng.choices(vocabulary, k=20))), (90, None), (91, " ,. ")]
    docs = []
    for i in range(40):
        text = rng.choices(vocabulary, k=rng.choice([0, 1, 4, 13, 60, 200]))
        if i % 3 == 0:
            at = rng.randint(0, len(text))
            text[at:at] = (items[rng.randrange(26)][1] or "").split()
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(text)))
    docs += [(3, docs[3][1]), (None, items[5][1]), (41, None), (42, ""), (43, (items[9][1] + "!? ").upper() * 40)]
    assert spark_rows(spark, docs, items) == brute(docs, items)


def test_a_passage_in_most_documents(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = [(i, f"own{i} {passage} end{i}") for i in range(60)] + [(99, "clean words only")]
    assert spark_rows(spark, docs, [(1, passage)]) == brute(docs, [(1, passage)])


def test_empty_tables(spark):
    assert spark_rows(spark, [], [(1, "a b")]) == []
    assert spark_rows(spark, [(1, "a b")], []) == [(1, 2, 0, [])]


def test_decontaminated_keeps_rows_and_columns(spark, docs):
    passage = " ".join(f"p{i}" for i in range(13))
    frame = docs([(1, passage), (1, passage), (2, "x " * 400 + passage), (3, None), (None, passage), (None, "clean")])
    bench = spark.createDataFrame([(5, passage)], "item_id long, text string")
    kept = dec.decontaminated(frame, bench)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 3]


def test_no_python_in_the_plan(spark, docs):
    frame = docs([(1, "a b c")])
    bench = spark.createDataFrame([(5, "a b")], "item_id long, text string")
    plan = dec.contamination(frame, bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", plan)
