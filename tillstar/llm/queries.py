"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import bpe, chat, forest, html_text, licenses, mixing, near_dedup, nearest, pii, prefix_trie, quality_model, quality_rules, ranked_search
from tillstar.llm.common import table


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = conversations.union(spark.createDataFrame(extra, conversations.schema))
    return chat.read_back(chat.format_branches(chat.conversation_messages(rows)))


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_chat_formatting": op1_chat_formatting,
        "op2_personal_data": op2_personal_data,
        "op3_minhash_near_dedup": op3_minhash_near_dedup,
        "op4_source_mixing": op4_source_mixing,
        "op5_byte_bpe": op5_byte_bpe,
        "op6_html_extraction": op6_html_extraction,
        "op7_quality_classifier": op7_quality_classifier,
        "op8_license_scan": op8_license_scan,
        "op9_nearest_neighbours": op9_nearest_neighbours,
        "op10_quality_rules": op10_quality_rules,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_embedding_near_dedup": op12_embedding_near_dedup,
        "op13_ranked_search": op13_ranked_search,
    }
