"""Corpus pipeline: toxic documents go, duplicate lines go, one document of each group of near copies stays, documents with benchmark passages go, the rest is encoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.llm import bpe, decontaminate, line_dedup, ngram_join, toxicity
from tremor.llm.common import cut, row_hash, table, unwrapped, wrapped
from tremor.llm.queries import VOCABULARY

#: Near copies are documents whose sets of five-word shingles are this similar, in percent.
SHINGLE_WORDS, NEAR_PERCENT = 5, 80


def _rows(docs: DataFrame) -> DataFrame:
    """row (a struct of the columns of ``docs``), doc_id and text: no other name of the input is looked at."""
    return wrapped(docs, F.col("`doc_id`"), F.col("`text`"))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below its threshold; it is fitted on the labelled ones among ``docs``. Null and empty texts stay."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return unwrapped(toxicity.score(_rows(docs), model).where(F.col("toxicity.score") < toxicity.THRESHOLD), docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand in an earlier document or earlier in their own; n_chars is that of the new text; of a null text it stays. A document that loses all goes."""
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.coalesce(F.length("`text`").cast("long"), F.col("`n_chars`"))) if "n_chars" in docs.columns else kept


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of similar documents: that of its least doc_id, null ids last. Rows without words stay.

    Rows are told apart by a 64-bit hash of id and text, so rows that only repeat an id are documents of their own, and of rows that repeat both one stays.
    """
    rows = _rows(docs).withColumn("key", row_hash("doc_id", "text"))
    found = ngram_join.join_components(rows.select(F.col("key").alias("doc_id"), "text"), SHINGLE_WORDS, NEAR_PERCENT).where("n_shingles > 0")
    found = cut(found.groupBy(F.col("doc_id").alias("key")).agg(F.min("component_id").alias("root"), F.count("*").alias("n")))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")
    least = found.join(rows.select("key", "doc_id"), "key").groupBy("root").agg(F.min(place)["key"].alias("first"))
    marked = cut(found.join(least, "root").where("key <> first or n > 1").select("key", (F.col("key") != F.col("first")).alias("lost")))
    repeated = rows.join(marked.where("not lost"), "key", "left_semi").dropDuplicates(["key"])
    kept = rows.join(marked.select("key"), "key", "left_anti").unionByName(repeated)
    return unwrapped(kept, docs.columns)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item. Null and empty texts stay."""
    found = decontaminate.search_columns(_rows(docs), table(spark, sf_dir, "benchmark"))
    return unwrapped(found.where(~F.col("found.contaminated")), docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and hashes of the ids and of the bytes that they decode to."""
    import public_tokenizers

    return bpe.round_trip(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", toxic),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_free),
    ("byte-level BPE encoding and decoding", tokens),
]

#: SQL can express neither the classifier nor the tokenizer; tests look at what the stages do to small tables, and hold the operators that they call against brute force or libraries where there is such a test.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs)
    return docs
