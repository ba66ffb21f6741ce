"""Raw documents to token ids: language, near duplicates, decontamination, personal data, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import bpe, chosen_path, decontaminate, language, pii
from wattline.llm.common import table
from wattline.llm.queries import PATTERN, RANKS
from wattline.session import settled, sized


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without a letter or too far from every language go.

    Null and empty texts go. Repeated rows share one verdict. Other columns are kept as they are.
    """
    model = language.fit(docs.filter(~language.held_out()))
    judged = language.predicted(docs, model, carry=tuple(docs.columns))
    return judged.filter(~F.col("rejected")).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies (five-word shingles, similarity 0.8): the one with the smallest id.

    Rows of one id are one document, and one of them stays. Rows without an id stay unless they copy one with an id.
    """
    found = chosen_path.near_duplicates(docs)
    gone = sized(found.filter("NOT kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("gone_id")).distinct())
    twice = sized(docs.groupBy(F.col("doc_id").alias("twice_id")).count().filter("count > 1 AND twice_id IS NOT NULL").select("twice_id"))
    kept = docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
    single = kept.join(twice, kept["doc_id"] == twice["twice_id"], "left_anti")
    repeated = kept.join(twice, kept["doc_id"] == twice["twice_id"], "left_semi").dropDuplicates(["doc_id"])
    return single.unionByName(repeated)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item to half or more. Null and empty texts stay."""
    judged = decontaminate.scored(docs, table(spark, sf_dir, "benchmark"), carry=tuple(docs.columns))
    return judged.filter(~F.col("contaminated")).select(*docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by the name of its kind; ``n_chars`` counts the new text."""
    masked = pii.masked(docs)
    counts = F.when(F.col("text").isNotNull(), F.length("text").cast(masked.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", counts).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The id, the number of token ids, and the digests of the ids and of the bytes they decode to, per document."""
    return bpe.round_trip(docs, RANKS, PATTERN)


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", decontaminated),
    ("personal_data", without_personal_data),
    ("token_ids", token_ids),
]

#: Learned models, random trees and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
