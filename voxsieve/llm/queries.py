"""Queries p2, p3, p6, p7 and p8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxsieve.llm import leakage, mixing, plaintext, reading, topn
from voxsieve.sources.tables import table


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    scores = topn.distinct_scores(table(spark, root, "scored_candidates"), "group_key", "candidate_id", "cer_route", "deleted_at")
    return topn.top_n(scores, 3).select(F.col("item").alias("candidate_id"), "rank_no")


def _texts(spark: SparkSession, root: str) -> DataFrame:
    hyps = table(spark, root, "sidecar").select(F.lit("sidecar").alias("table_name"), "row_id", F.col("hyp").alias("text"))
    return hyps.unionByName(table(spark, root, "arm_index").select(F.lit("arm_index").alias("table_name"), "row_id", F.col("wake_text").alias("text")))


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    return plaintext.changed_rows(_texts(spark, root), "text").select("table_name", "row_id")


def p3_plain(spark: SparkSession, root: str) -> DataFrame:
    texts = _texts(spark, root)
    changed = plaintext.changed_rows(texts, "text")
    kept = texts.join(changed.select("table_name", "row_id"), ["table_name", "row_id"], "left_anti")
    return kept.withColumn("plain", F.col("text")).unionByName(changed)


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    return leakage.leaks(table(spark, root, "documents"), table(spark, root, "eval_items")).select("doc_id", "item_id")


def p6_items(spark: SparkSession, root: str) -> DataFrame:
    return leakage.item_report(leakage.leaks(table(spark, root, "documents"), table(spark, root, "eval_items")))


def p6_kept(spark: SparkSession, root: str) -> DataFrame:
    documents = table(spark, root, "documents")
    return leakage.without_leaks(documents, leakage.leaks(documents, table(spark, root, "eval_items"))).select("doc_id", "n_chars")


def p6_cleaned(spark: SparkSession, root: str) -> DataFrame:
    return leakage.cleaned(table(spark, root, "documents"), table(spark, root, "eval_items"))


def p7_mix(spark: SparkSession, root: str) -> DataFrame:
    return mixing.mix(table(spark, root, "documents"), table(spark, root, "mix_targets"))[0]


def p7_shares(spark: SparkSession, root: str) -> DataFrame:
    return mixing.mix(table(spark, root, "documents"), table(spark, root, "mix_targets"))[1]


def p8_levels(spark: SparkSession, root: str) -> DataFrame:
    levels = reading.reading_levels(table(spark, root, "documents"), table(spark, root, "level_labels"))
    return levels.select("doc_id", "script", "score", "level_estimate", "level")


def p8_profile(spark: SparkSession, root: str) -> DataFrame:
    documents = table(spark, root, "documents").withColumn("plain_source", F.coalesce(mixing.plain_source(F.col("source")), F.lit("unknown")))
    return reading.profile(reading.reading_levels(documents, table(spark, root, "level_labels")), ["plain_source", "script"])


QUERIES = {f.__name__: f for f in (p2_found, p3_found, p3_plain, p6_found, p6_items, p6_kept, p6_cleaned, p7_mix, p7_shares, p8_levels, p8_profile)}

ORACLES = {
    "p2_found": """
    SELECT candidate_id, rank_no FROM (
      SELECT *, row_number() OVER (PARTITION BY group_key ORDER BY cer, candidate_id) AS rank_no
      FROM (SELECT group_key, candidate_id, min(cer_route) AS cer FROM scored_candidates
            WHERE deleted_at IS NULL AND group_key IS NOT NULL AND candidate_id IS NOT NULL AND isfinite(cer_route) GROUP BY ALL))
    WHERE rank_no <= 3""",
}
