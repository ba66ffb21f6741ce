"""One registered query per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import (
    bpe, chosen_path, decontaminate, importance, katz, language, max_sketch, pii, quality, stripes, token_files, toxicity, warc,
)
from wattline.llm.common import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the benchmark item that covers it best, its coverage, and whether it is contaminated."""
    return decontaminate.scored(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids by the rank file, and back to bytes, as digests."""
    return bpe.round_trip(table(spark, folder, "documents"), RANKS, PATTERN)


def op3_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's importance weight towards the texts labelled good, and whether it is drawn."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    good = labels.filter("quality = 1").select(F.col("doc_id").alias("good_id")).distinct()
    # Good ids grow with the texts, so these are dealt by id at any size, once: where no label is asked for, no join is left.
    marked = docs.join(good.hint("merge"), docs["doc_id"] == good["good_id"], "left")
    return importance.resampled(marked, F.col("good_id").isNotNull())


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's probabilities of low quality and, given that, of toxicity."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    categories = {"low_quality": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
    chain = toxicity.fit(docs, labels, categories)
    return toxicity.predicted(docs, chain, list(categories))


def op5_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's base counts, its distances to the nearest language, and the verdict."""
    return quality.ruled(table(spark, folder, "documents"))


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's language; learned from the rows that are not held out."""
    docs = table(spark, folder, "documents")
    model = language.fit(docs.filter(~language.held_out()))
    return language.predicted(docs.withColumn("held_out", language.held_out()), model, carry=("doc_id", "held_out"))


def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's personal data: base spans, and all spans."""
    return pii.personal_data(table(spark, folder, "documents"))


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page, written to archives, normalised, and read back by the offset index."""
    read = warc.archived(table(spark, folder, "pages"))
    return read.select(
        F.col("id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"),
        F.col("refers").alias("refers_to"),
    )


def op9_orc_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids, written to ORC files in id order and read back."""
    return token_files.round_trip(table(spark, folder, "documents"), VOCABULARY)


def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's component of near copies over three-word shingles, similarity 0.85."""
    return chosen_path.near_duplicates(table(spark, folder, "documents"), k=3, percent=85)


def op11_katz_backoff(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's log probability by the model of the training documents, and by single words."""
    return katz.scored(table(spark, folder, "documents"))


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    return max_sketch.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """How far the sources of each language are from each other, and the terms that set them apart."""
    return stripes.divergences(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_byte_bpe, op3_importance, op4_toxicity, op5_divergence, op6_language, op7_personal_data, op8_warc,
        op9_orc_tokens, op10_near_duplicates, op11_katz_backoff, op12_lexical_search, op13_source_divergence,
    )
}

#: The others have no SQL: learned models, tokenizers, random trees; tests hold them against brute force.
SQL: dict[str, str] = {
    "op8_warc": warc.oracle(),
    "op11_katz_backoff": katz.oracle(),
    "op12_lexical_search": max_sketch.oracle(),
    "op13_source_divergence": stripes.oracle(),
}
