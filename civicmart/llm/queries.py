"""The registered queries of this folder: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicmart.llm import decontaminate, hosts, negatives, packing, paragraphs, pii, quality, quotes, simhash, tokenfiles, topk, trie, warc
from civicmart.llm.common import staged, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

URL_RULES = [
    hosts.Rule("org", "/", "allow"),
    hosts.Rule("example.org", "/es/", "block"),
    hosts.Rule("example.org", "/en/1", "block"),
    hosts.Rule("com", "/fr/", "allow"),
    hosts.Rule("com", "/de/", "block"),
]


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


@registered
def op1_warc_bundles(spark: SparkSession, sf: str) -> DataFrame:
    """Pages written as seekable bundles and read back."""
    pages = table(spark, sf, "pages").select(
        F.col("page_id").alias("record_key"), "url", F.encode("html", "UTF-8").alias("payload")
    )
    index = warc.write_archives(warc.with_revisits(pages))
    return warc.read_archives(index).select(
        F.col("record_key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@registered
def warc_contents(spark: SparkSession, sf: str) -> DataFrame:
    """The record that holds each page's content, fetched from the bundles by its identifier."""
    pages = table(spark, sf, "pages").select(
        F.col("page_id").alias("record_key"), "url", F.encode("html", "UTF-8").alias("payload")
    )
    records = warc.with_revisits(pages)
    index = warc.write_archives(records)
    holder = F.coalesce("refers_to", "record_key")
    wanted = records.select(warc.identifier(holder, F.col("payload_digest")).alias("record_id"))
    return warc.fetch(index, wanted).select(F.col("record_key").alias("page_id"), "url", "payload_bytes", "payload_digest")


@registered
def op2_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with the words that benchmark windows hit."""
    found = decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


@registered
def op3_paragraph_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every passage that occurs again, with the first occurrence of its class."""
    found = paragraphs.repeated_passages(table(spark, sf, "documents"))
    return found.select("doc_id", "paragraph", "n_words", "first_doc_id", "first_paragraph", "removed", "across")


def bad_pages(labels: DataFrame) -> DataFrame:
    """Labelled outcomes of pages: low quality or toxic is bad."""
    bad = (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("int")
    known = F.col("quality").isNotNull() | F.col("toxic").isNotNull()
    return labels.where(known).select(F.col("doc_id").alias("page_id"), bad.alias("bad"))


@registered
def op4_host_reputation(spark: SparkSession, sf: str) -> DataFrame:
    """Every page's url judged by rules, else by its host's reputation."""
    judged = hosts.judge_urls(table(spark, sf, "pages"), bad_pages(table(spark, sf, "labels")), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@registered
def op5_simhash_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate components of all documents by fingerprint."""
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@registered
def op6_weak_label_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Probabilities and verdict for every document."""
    judged = quality.judged(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels"))
    return judged.select(
        "doc_id",
        F.round("__p.low_quality", 4).alias("p_low_quality"),
        F.round("__p.toxic", 4).alias("p_toxic"),
        (~quality.is_rejected()).alias("keep"),
    )


@registered
def op7_mixture_packing(spark: SparkSession, sf: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens at the corpus's proportions."""
    return packing.pack(table(spark, sf, "documents"), tokenizer_path()).drop("ids")


@registered
def op8_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    """Spans of personal data in every document."""
    found = pii.spans(table(spark, sf, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, pii.KINDS),
        F.sha2(pii.span_text("base"), 256).alias("base_sha256"),
        pii.span_text("spans").alias("spans"),
    )


@registered
def op9_sorted_list_search(spark: SparkSession, sf: str) -> DataFrame:
    """The five best of all other vectors for every fiftieth vector."""
    vectors = staged(topk.quantised(table(spark, sf, "embeddings")), "quantised")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


@registered
def op10_quotation_links(spark: SparkSession, sf: str) -> DataFrame:
    """All conversations in reply order, without quotations."""
    return quotes.reply_ordered(table(spark, sf, "conversations"))


def byte_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@registered
def op11_token_files(spark: SparkSession, sf: str) -> DataFrame:
    """All documents written as token files with directly addressable codes, and read back."""
    index = tokenfiles.write_tokens(table(spark, sf, "documents"), byte_tokenizer_path())
    return tokenfiles.with_crc32(tokenfiles.read_documents(index))


@registered
def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    """All nodes of the trie of conversations that begin with the turns of every fifth one."""
    turns = staged(trie.ordered_turns(table(spark, sf, "conversations")), "turns")
    members = turns.where("pos = 1").select("conv_id")
    bases = members.select(
        "conv_id",
        (F.col("conv_id") - F.col("conv_id") % 5).alias("base_id"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).alias("h"),
    )
    return trie.prefix_trie(trie.grafted(turns, bases), members)


@registered
def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    """Hard negatives for every hundredth vector, some labels of which are changed."""
    vectors = staged(negatives.labelled_vectors(table(spark, sf, "embeddings")), "labelled")
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.withColumn("label", changed)
    return negatives.mined(vectors, vectors.where(F.col("vec_id") % 100 == 0))
