"""References to records that do not exist: missing, deleted or late parents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxsieve.operators.skew import heavy_keys, salted_left_join


def parent_intervals(parents: DataFrame, keys: list[str], loaded: str = "loaded_at", deleted: str = "deleted_at") -> DataFrame:
    """One row per (key column, value): whether a live row has it and from when on.

    All key columns are stacked in one scan and aggregated together; partial aggregation before the shuffle keeps
    a value that fills a third of the table from reaching one task as rows.
    """
    stacked = parents.select(F.explode(F.array(*[F.struct(F.concat(F.lit(f"{k}:"), F.col(k)).alias("key"), (F.col(k) != "").alias("used")) for k in keys])).alias("k"), F.col(deleted).isNull().alias("live"), F.col(loaded).alias("at"))
    return stacked.where("k.used").groupBy(F.col("k.key").alias("key")).agg(F.max("live").alias("is_live"), F.min(F.when(F.col("live"), F.col("at"))).alias("valid_from"))


def references(df: DataFrame, table_name: str, row_id: str, ref: str, parent_key: str, at: str) -> DataFrame:
    """The rows of ``df`` that refer to ``parent_key``; null and '' are no reference."""
    return df.where(F.col(ref) != "").select(F.lit(table_name).alias("table_name"), F.col(row_id).alias("row_id"), F.concat(F.lit(f"{parent_key}:"), F.col(ref)).alias("key"), F.col(at).alias("at"))


def orphans(refs: DataFrame, intervals: DataFrame, hot: list | None = None, salts: int = 64) -> DataFrame:
    """The referring rows without a valid parent: ``table_name, row_id, kind, at``.

    Both sides are hashed on the key, sorted and merged once; keys with very many references are salted. ``missing``: no
    row has the key. ``deleted``: only deleted rows have it. ``late``: the first live row was loaded after ``at``. A null ``at`` is
    never late, nor is a parent whose live rows all lack a load time. Keys are compared byte by byte. Empty tables
    give no orphans (no references) or only ``missing`` ones (no parents).
    """
    if hot is None:
        hot = heavy_keys(refs, F.col("key"))
    merged = salted_left_join(refs, intervals, "key", "row_id", hot, salts)
    kind = F.when(F.col("is_live").isNull(), "missing").when(~F.col("is_live"), "deleted").when(F.col("valid_from") > F.col("at"), "late")
    return merged.select("table_name", "row_id", kind.alias("kind"), "at").where("kind is not null")


def orphan_report(found: DataFrame) -> DataFrame:
    """Orphans per table, month of the referring row ('unknown' without a time) and kind."""
    month = F.coalesce(F.date_format("at", "yyyy-MM"), F.lit("unknown"))
    return found.groupBy("table_name", month.alias("month"), "kind").agg(F.count(F.lit(1)).alias("n_rows"))
