"""The stages of the corpus pipeline: each applies one operator and, but for the last, returns documents.

All of them take and return rows with the columns of documents (doc_id, text, lang, source, n_chars), whatever else
the input has; how null, empty, long and repeated rows are treated is stated by each operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import bpe, mixing, near_dedup, pii, quality_model
from tillstar.llm.common import columns_of, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps."""
    return quality_model.keep_good(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8 or more).

    The one with the smallest doc_id stays; of rows that share it the first by text. Documents without words are no
    duplicates of each other but of rows with their own doc_id and text. Rows without doc_id all stay.
    """
    found = near_dedup.near_duplicates(docs, k=5, percent=80)
    kept = found.where("kept and doc_id is not null").select("doc_id").distinct()
    named = columns_of(docs, COLUMNS).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    rows = named.join(kept, "doc_id", "left_semi")
    first = rows.groupBy("doc_id").agg(F.min(F.struct("text", "lang", "source", "n_chars")).alias("row")).select("doc_id", "row.*")
    return first.select(*COLUMNS).union(named.where("doc_id is null").select(*COLUMNS))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every span of personal data replaced by its kind."""
    return pii.mask(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as often as the mixture takes them; those that it does not take go."""
    repeats = mixing.mix(docs).where("repeats > 0").select("doc_id", "source", "size", "repeats").distinct()
    named = columns_of(docs, COLUMNS).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    sized = named.withColumn("size", mixing.word_count())
    same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & F.col("d.source").eqNullSafe(F.col("r.source")) & (F.col("d.size") == F.col("r.size"))
    joined = sized.alias("d").join(repeats.alias("r"), same)
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("r.repeats")))
    return joined.select(*[f"d.{c}" for c in COLUMNS], copies.alias("copy")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number and digest of the ids, digest of the bytes that they decode to; a row per row."""
    return bpe.encoding_digests(docs)
