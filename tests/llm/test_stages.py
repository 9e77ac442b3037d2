"""Clashing columns in every stage, and the corpus pipeline stage by stage."""

from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from civicmart.llm import decontaminate, packing, pii, quality, simhash  # noqa: E402
from civicmart.llm.queries import tokenizer_path  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
NAMES = (
    "__id __hash __known __none __cuts __p fp text_hash kept_hash component_id words at spans base n_hit n_words row_id "
    "kept_0 kept_6 h bands label votes features"
).split()


@pytest.fixture
def clashing(docs):
    rows = [(i, f"document number {i} says some ordinary words about the house and the garden {i}") for i in range(12)]
    rows += [(12, "mail me at ann@example.org please"), (13, None), (None, "no id"), (None, None), (14, "")]
    return docs(rows).withColumns({c: F.lit(f"value of {c}") for c in NAMES})


def stages(spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(6)], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([("b1", "a benchmark item of a few words that no document holds at all")], "item_id string, text string")
    return {
        "quality": lambda d: quality.accepted(d, labels),
        "simhash": simhash.deduplicated,
        "decontaminate": lambda d: decontaminate.decontaminated(d, benchmark),
        "pii": pii.redacted,
    }


@pytest.mark.parametrize("name", ["quality", "simhash", "decontaminate", "pii"])
def test_columns_of_the_caller_come_back_whatever_their_names(spark, clashing, name):
    out = stages(spark)[name](clashing)
    assert out.columns == clashing.columns
    rows = out.collect()
    assert rows and all(r[c] == f"value of {c}" for r in rows for c in set(NAMES) - {"fp"})


@pytest.mark.parametrize("name", ["quality", "simhash", "decontaminate", "pii"])
def test_empty_tables(spark, clashing, name):
    assert stages(spark)[name](clashing.limit(0)).count() == 0


def test_repeated_rows_without_id_are_packed_in_chunks_of_their_own(spark, docs):
    rows = docs([(None, "same words")] * 2000).repartition(4)
    tokens = packing.tokenized(rows, tokenizer_path())
    queued = packing.queue_positions(tokens)
    assert sorted(r.before for r in queued.collect()) == [r * tokens.first().doc_tokens for r in range(2000)]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_every_stage_keeps_what_it_should_and_the_end_equals_plain_tokenizing(spark):
    from tokenizers import Tokenizer

    before = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = before.columns, before
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, SF_DIR)
        assert out.columns == columns, name
        path = f"{spark.conf.get('spark.checkpoint.dir')}/test-{name.replace(' ', '-')}"
        out.write.mode("overwrite").parquet(path)
        out = spark.read.parquet(path)
        assert out.count() > 0.5 * kept.count(), name
        assert out.select("doc_id").exceptAll(kept.select("doc_id")).count() == 0, name
        if name == "simhash near-dedup":
            found = {r.doc_id: r.component_id for r in simhash.near_duplicates(kept).collect()}
            assert {r.doc_id for r in out.collect()} == {d for d, c in found.items() if d == c}
        if name == "benchmark decontamination":
            bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
            left = decontaminate.contamination(out, bench)
            assert left.where(decontaminate.is_contaminated(F.col("n_hit"), F.col("n_words"))).count() == 0
        if name == "personal data":
            assert out.count() == kept.count()
            assert out.where(F.col("text").rlike(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9-]+")).count() == 0
        kept = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, SF_DIR).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    expected = {r.doc_id: len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in kept.collect()}
    total = {}
    for p in pieces:
        total[p.doc_id] = total.get(p.doc_id, 0) + p.length
    assert total == expected
