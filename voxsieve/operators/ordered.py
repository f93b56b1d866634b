"""Order-dependent operators on groups of any size: numbering, running totals, the last value before a row.

A plain window sends a whole group to one task. Here a group is cut into blocks of its order; the window runs
inside a block, and a table with one row per block carries what goes over a block's edge.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxsieve.session import settled

#: Buckets of the hash order used by :func:`running_total`; the per-group edge table has at most so many rows.
HASH_BUCKETS = 1 << 16


def numbered(df: DataFrame, keys: list[str], by_time: str, ties: list[str], out: str, rows_per_block: int = 100_000) -> DataFrame:
    """Add ``out``: 1, 2, ... within ``keys`` in the order ``by_time, *ties``.

    Groups above ``rows_per_block`` are range-partitioned on the whole order and written with their partition; a row's number is its place there plus the
    rows of the group's earlier partitions, so bunched or equal times are spread by ``ties``. Other groups are numbered by a window. Null times come first; null keys form a group. Rows that
    agree in all order columns get their numbers in an arbitrary order, and only they can't be spread. An empty table stays empty.
    """
    order = [F.col(by_time).asc_nulls_first(), *ties]
    big = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_block).select(*[F.col(k).alias(f"_g_{k}") for k in keys], "_n")
    sizes = settled(big, "big-groups").agg(F.count(F.lit(1)).alias("groups"), F.sum("_n").alias("rows")).first()
    inside = Window.partitionBy(*keys).orderBy(*order)
    if not sizes["groups"]:
        return df.withColumn(out, F.row_number().over(inside))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys])
    usual = df.join(big, same, "left_anti").withColumn(out, F.row_number().over(inside))
    # a range partition never holds much more than a block, however large its group; the number of parts follows from the rows
    parts = int(min(100_000, sizes["rows"] // rows_per_block + sizes["groups"]))
    ranged = settled(df.join(big, same, "left_semi").repartitionByRange(parts, *keys, *order).withColumn("_part", F.spark_partition_id()), "numbered")
    counts = ranged.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_c"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_c").over(earlier), F.lit(0))).select(*[F.col(k).alias(f"_g_{k}") for k in keys], F.col("_part").alias("_g_part"), "_before")
    placed = ranged.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order)))
    joined = placed.join(counts, same & (F.col("_part") == F.col("_g_part")))
    return usual.unionByName(joined.withColumn(out, (F.col("_before") + F.col("_rn")).cast("int")).select(*df.columns, out))


def running_total(df: DataFrame, keys: list[str], hash_col: str, ties: list[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before this one, within ``keys``, in the order ``hash_col, *ties``.

    ``hash_col`` is a 64-bit hash; its top 16 bits cut a group into buckets. Sums per bucket are taken before the
    shuffle, the window over buckets sees at most 65,536 rows of a group, the one inside a bucket a 65,536th of it.
    """
    d = df.withColumn("_b", F.shiftrightunsigned(F.col(hash_col), 48).cast("int"))
    sums = d.groupBy(*keys, "_b").agg(F.sum(value).alias("_s"))
    prior = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_base", F.coalesce(F.sum("_s").over(prior), F.lit(0))).drop("_s")
    inside = Window.partitionBy(*keys, "_b").orderBy(F.shiftleft(F.col(hash_col), 16), *ties).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return d.join(sums, [*keys, "_b"], "inner").withColumn(out, F.col("_base") + F.col("_in")).drop("_b", "_base", "_in")


def neighbours(df: DataFrame, keys: list[str], index: str, carried: str, rows_per_block: int = 4096) -> DataFrame:
    """Add ``prev_{index}``, ``next_{index}`` and ``last_{carried}``, the last non-null ``carried`` before the row.

    ``index`` numbers the rows of a group upwards (gaps are allowed, repeats are not). Blocks are ranges of it.
    """
    d = df.withColumn("_blk", F.floor(F.col(index) / F.lit(rows_per_block)))
    w = Window.partitionBy(*keys, "_blk").orderBy(index)
    upto = w.rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumns({"_p": F.lag(index).over(w), "_q": F.lead(index).over(w), "_c": F.last(carried, ignorenulls=True).over(upto)})
    edge = df.where(F.col(index) >= 0).withColumn("_blk", F.floor(F.col(index) / F.lit(rows_per_block)))
    edge = edge.groupBy(*keys, "_blk").agg(F.min(index).alias("_first"), F.max(index).alias("_last"), F.max_by(carried, F.when(F.col(carried).isNotNull(), F.col(index))).alias("_type"))
    over = Window.partitionBy(*keys).orderBy("_blk")
    edge = edge.withColumns({"_ep": F.lag("_last").over(over), "_eq": F.lead("_first").over(over), "_ec": F.last("_type", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1))})
    edge = edge.where("_ep is not null or _eq is not null").select(*keys, "_blk", "_ep", "_eq", "_ec")
    d = d.join(edge, [*keys, "_blk"], "left")
    return d.withColumns({f"prev_{index}": F.coalesce("_p", "_ep"), f"next_{index}": F.coalesce("_q", "_eq"), f"last_{carried}": F.coalesce("_c", "_ec")}).drop("_blk", "_p", "_q", "_c", "_ep", "_eq", "_ec")


def exact_quantile(df: DataFrame, keys: list[str], value: str, q: float, out: str) -> DataFrame:
    """``keys, out``: the ``q`` quantile per group, linear between neighbours, from numbered rows; nulls don't count.

    No group's values meet in one task, unlike in the exact percentile aggregate.
    """
    d = numbered(df.where(F.col(value).isNotNull()).select(*keys, value), keys, value, [], "_no")
    sizes = d.groupBy(*keys).agg(F.max("_no").alias("_n"))
    at = (F.col("_n") - 1) * q + 1
    weight = F.greatest(F.lit(0.0), 1 - F.abs(F.col("_no") - at))
    return d.join(sizes, keys).where(F.abs(F.col("_no") - at) < 1).groupBy(*keys).agg(F.sum(F.col(value) * weight).alias(out))
