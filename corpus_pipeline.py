"""From raw documents to packed training sequences.

Each stage takes what the stage before has written and read again; all but the last
return the columns of ``documents``, further ones of the caller included, whatever their names.

Defined results, in every stage: a null text is an empty one, a null id stays null; rows with
equal id and text share one verdict and one redaction, and deduplication keeps one of
them; texts without words are near-duplicates of each other; an empty table gives no rows.
Without labels nothing is rejected on their account, without benchmark nothing is contaminated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from civicmart.llm import decontaminate, packing, pii, quality, simhash
from civicmart.llm.common import table
from civicmart.llm.queries import tokenizer_path
from civicmart.session import scratch_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, that with the smallest id."""
    return simhash.deduplicated(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows hit less than a twentieth."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redacted(docs)


def mixture_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all sequences."""
    return packing.pack(docs, tokenizer_path()).drop("ids")


STAGES = [
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("personal data", personal_data),
    ("mixture packing", mixture_packing),
]

# A trained classifier and the packing order are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
