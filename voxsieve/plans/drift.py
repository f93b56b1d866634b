"""Queries p1: schemas that drift between files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxsieve.operators import drift
from voxsieve.sources.tables import table


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return drift.changes(drift.materialised_cells(table(spark, root, "raw_lines")))


def p1_lifespans(spark: SparkSession, root: str) -> DataFrame:
    return drift.lifespans(drift.catalogue(drift.materialised_cells(table(spark, root, "raw_lines")))[1]).drop("retyped", "next_no")


def p1_index_table(spark: SparkSession, root: str) -> DataFrame:
    return drift.consistent_table(table(spark, root, "raw_lines"), "index")


def p1_sidecar_table(spark: SparkSession, root: str) -> DataFrame:
    return drift.consistent_table(table(spark, root, "raw_lines"), "sidecar")


QUERIES = {f.__name__: f for f in (p1_found, p1_lifespans, p1_index_table, p1_sidecar_table)}
ORACLES: dict[str, str] = {}
