"""Lookups that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def heavy_keys(df: DataFrame, key: Column, share: float = 1 / 1024, min_rows: int = 200_000, tracked: int = 4096) -> list:
    """Keys that hold at least ``share`` of the non-null rows and at least ``min_rows`` rows.

    A frequent-items sketch finds them in one scan without a shuffle of the keys, so the list has at most
    ``1 / share`` entries whatever the input. It only steers salting: a key that the sketch over- or
    underestimates changes the balance of the work, never a result. Keys below ``share`` that still exceed a partition's size are left to the
    adaptive execution, which splits them in sort-merge joins. Empty input gives an empty list.
    """
    k = int(1 / share)
    # a task's sketch has a fixed size; they are merged in two levels, so that no task gets those of all tasks
    some = df.where(key.isNotNull()).select(key.alias("_key"), F.pmod(F.spark_partition_id(), F.lit(64)).alias("_bucket"))
    parts = some.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"), F.call_function("approx_top_k_accumulate", F.col("_key"), F.lit(tracked)).alias("s"))
    # grouped, as the function can't combine nothing
    whole = parts.groupBy((F.col("_bucket") * 0).alias("_all")).agg(F.sum("n").alias("n"), F.call_function("approx_top_k_combine", F.col("s"), F.lit(tracked)).alias("s"))
    row = whole.select("n", F.call_function("approx_top_k_estimate", F.col("s"), F.lit(k)).alias("top")).first()
    if not row or not row["n"]:
        return []
    least = max(min_rows, share * row["n"])
    return [x["item"] for x in row["top"] or [] if x["item"] is not None and x["count"] >= least]


def salt_of(key: Column, spread_by: Column, hot: list, salts: int) -> Column:
    """0 for ordinary keys, a value in 0..salts-1 drawn from ``spread_by`` for hot ones."""
    return F.when(key.isin(hot), F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")).otherwise(F.lit(0)) if hot else F.lit(0)


def salts_for(key: Column, hot: list, salts: int) -> Column:
    """The salts under which a lookup row has to be present."""
    return F.when(key.isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))) if hot else F.array(F.lit(0))


def salted_left_join(refs: DataFrame, lookup: DataFrame, key: str, spread_by: str, hot: list, salts: int = 64) -> DataFrame:
    """Left join of many ``refs`` to ``lookup`` (one row per ``key``) by co-partitioning, sorting and merging.

    Rows of hot keys are spread over ``salts`` partitions and the one lookup row of such a key is repeated there,
    so no task gets all rows of a key. The lookup is never broadcast, as it grows with the data.
    """
    if not hot:
        return refs.hint("merge").join(lookup, key, "left")
    left = refs.withColumn("_salt", salt_of(F.col(key), F.col(spread_by), hot, salts))
    right = lookup.withColumn("_salt", F.explode(salts_for(F.col(key), hot, salts)))
    return left.hint("merge").join(right, [key, "_salt"], "left").drop("_salt")
