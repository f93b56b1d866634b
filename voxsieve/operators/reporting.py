"""Orders, slots, names, summaries and checks of a selection's results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxsieve.functions.scalars import natural_key, slug
from voxsieve.operators.selection import TIE, stream_order
from voxsieve.operators.skew import heavy_keys, salted_left_join
from voxsieve.session import settled


def global_rank(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Add ``out``: 1, 2, ... over the whole table in ``order``, without sending it to one task.

    Rows are range-partitioned on the order and written with their partition; a row's rank is its place there plus the rows of
    earlier partitions. Ties are broken arbitrarily, so ``order`` should be total.
    """
    names = [f"_o{i}" for i in range(len(order))]
    keyed = df.withColumns(dict(zip(names, order, strict=True)))
    ranged = settled(keyed.repartitionByRange(*names).withColumn("_part", F.spark_partition_id()), "ranked")
    inside = Window.partitionBy("_part").orderBy(*names)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return ranged.withColumn("_rn", F.row_number().over(inside)).join(counts, "_part").withColumn(out, F.col("_base") + F.col("_rn")).drop("_part", "_rn", "_base", *names)


def group_orders(groups: DataFrame) -> DataFrame:
    """Distinct ``group_key`` with ``group_order``: split 'pos' first, then by the uid with numbers compared as numbers, then by key."""
    uid = F.element_at(F.split("group_key", "\0"), -1)
    first = F.when(F.element_at(F.split("group_key", "\0"), 1) == "pos", 0).otherwise(1)
    return global_rank(groups.select("group_key").distinct(), [first, natural_key(uid), F.col("group_key")], "group_order")


def slots(selected: Column) -> Column:
    """A candidate's place in its group's listing: 0 if selected, else its kind's base plus the stream's slot."""
    base = F.when(F.col("role") == "s1", F.when(F.col("view") == "raw", 1000).otherwise(2000)).otherwise(F.when(F.col("view") == "raw", 3000).otherwise(4000))
    return F.when(selected, 0).otherwise(base + stream_order(F.coalesce("stream", F.lit("")), 900))


def failed_slots() -> Column:
    """The place of a candidate that couldn't be decoded."""
    offset = F.when(F.col("role") == "s1", F.when(F.col("view") == "raw", 0).otherwise(20)).otherwise(F.when(F.col("view") == "raw", 40).otherwise(60))
    return 8000 + offset + stream_order(F.coalesce("stream", F.lit("")), 900)


def uid_digest() -> Column:
    return F.substring(F.sha2(F.concat(F.col("split"), F.lit("\0"), F.col("uid")), 256), 1, 8)


def file_names(order: Column, slot: Column, marker: Column) -> Column:
    """The name under which a listing keeps a candidate's audio."""
    digest = F.substring(F.coalesce("pcm_sha256", F.lit("undec")), 1, 8)
    padded = lambda n, width: F.lpad(n.cast("string"), F.greatest(F.lit(width), F.length(n.cast("string"))), F.lit("0"))
    parts = [padded(order, 6), uid_digest(), padded(slot, 4), marker, F.col("role"), F.col("view"), slug(F.col("stream"), 24), F.concat(F.lit("P-"), digest)]
    return F.array_join(F.array(*parts), "__", "none")


def loss_reasons(c: DataFrame, selected: DataFrame, hot: list | None = None) -> DataFrame:
    """``candidate_id, loss_reason`` of every candidate that its group's selected one beat; large groups are salted."""
    hot = heavy_keys(c, F.col("group_key")) if hot is None else hot
    s = selected.select("group_key", *[F.col(x).alias(f"s_{x}") for x in ("candidate_id", "view", "pcm_sha256", "cer_route", "q_kw", "qkw_calibrated")])
    both = salted_left_join(c, s, "group_key", "candidate_id", hot).where(F.col("candidate_id") != F.col("s_candidate_id"))
    gap = F.col("cer_route") - F.col("s_cer_route")
    reason = (
        F.when(F.coalesce(F.col("validity"), F.lit("")) != "rankable", F.coalesce("validity", F.lit("fatal_invalid")))
        .when((F.col("pcm_sha256") != "") & (F.col("pcm_sha256") == F.col("s_pcm_sha256")), "same_pcm_prefer_s1")
        .when(gap > TIE, "higher_cer")
        .when((F.abs(gap) <= TIE) & F.col("qkw_calibrated") & F.col("s_qkw_calibrated") & (F.col("q_kw") < F.col("s_q_kw")), "equal_cer_lower_qkw")
        .when((F.abs(gap) <= TIE) & (F.col("view") != "raw") & (F.col("s_view") == "raw"), "deterministic_raw_tie")
        .otherwise("deterministic_tie_or_stage_policy")
    )
    return both.select("candidate_id", reason.alias("loss_reason"))


def set_fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row ``n, fingerprint`` that tells whether two tables hold the same set of rows, in whatever order.

    The digests of the distinct rows are added up and combined by exclusive or, so partial results merge and nothing is collected.
    """
    d = df.select(F.sha2(F.concat_ws("\0", *[F.coalesce(F.col(c).cast("string"), F.lit("\1")) for c in columns]), 256).alias("h")).distinct()
    low = F.conv(F.substring("h", 1, 12), 16, 10).cast("decimal(20,0)")
    high = F.conv(F.substring("h", 13, 15), 16, 10).cast("bigint")
    sums = d.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(low), F.lit(0)).cast("decimal(38,0)").alias("s"), F.coalesce(F.bit_xor(high), F.lit(0)).alias("x"))
    return sums.select("n", F.sha2(F.concat_ws(":", "n", "s", "x"), 256).alias("fingerprint"))


def paired(new: DataFrame, base: DataFrame) -> DataFrame:
    """``group_key, cer, base_cer, delta`` of the groups that both have with a finite error."""
    n, b = new.select("group_key", "cer").where("cer is not null"), base.select("group_key", F.col("cer").alias("base_cer")).where("base_cer is not null")
    return n.join(b, "group_key").withColumn("delta", F.col("cer") - F.col("base_cer"))


def paired_summary(pairs: DataFrame) -> DataFrame:
    """Means, shares of zero error, and the numbers of groups that got better, worse or stayed."""
    d = F.col("delta")
    return pairs.agg(
        F.count(F.lit(1)).alias("n_paired"), F.avg("cer").alias("mean_cer"), F.avg("base_cer").alias("base_mean_cer"), F.avg((F.col("cer") <= TIE).cast("int")).alias("zero_share"), F.avg((F.col("base_cer") <= TIE).cast("int")).alias("base_zero_share"),
        F.count_if(d < -TIE).alias("n_better"), F.count_if(d > TIE).alias("n_worse"), F.count_if(F.abs(d) <= TIE).alias("n_same"),
    )


def listing_faults(index: DataFrame) -> DataFrame:
    """Faults of a listing (``group_key, group_order, slot, marker``), counted by kind.

    Each group needs exactly one selected entry and that first; one order per group and one group per order; orders without gaps; no slot twice.
    """
    g = index.groupBy("group_key").agg(F.count_if(F.col("marker") == "SELECTED").alias("chosen"), F.min_by("marker", "slot").alias("first"), F.min("group_order").alias("lo"), F.max("group_order").alias("hi"))
    per_group = g.agg(F.count_if(F.col("chosen") != 1).alias("not_one_selected"), F.count_if(F.col("first") != "SELECTED").alias("selected_not_first"), F.count_if(F.col("lo") != F.col("hi")).alias("split_groups"), (F.max("hi") - F.count_distinct("lo")).alias("gaps"))
    twice = index.groupBy("group_key", "slot").agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("slots_twice"))
    return per_group.join(F.broadcast(twice))


def runs(df: DataFrame, keys: list[str], index: str, active: Column) -> DataFrame:
    """``keys, start, length`` of each unbroken run of active rows; ``index`` numbers a group's rows without gaps."""
    from voxsieve.operators.ordered import neighbours

    on = df.where(active).select(*keys, index).withColumn("mark", F.lit(None).cast("long"))
    seen = neighbours(on, keys, index, "mark")
    starts = seen.select(*keys, index, F.when(F.coalesce(F.col(f"prev_{index}") != F.col(index) - 1, F.lit(True)), F.col(index)).alias("start"))
    tied = neighbours(starts, keys, index, "start").withColumn("start", F.coalesce("start", "last_start"))
    return tied.groupBy(*keys, "start").agg(F.count(F.lit(1)).alias("length"))


def false_accepts(far: Column, rr: Column) -> Column:
    """The false-accept rate, given as such or as the rejection rate."""
    return F.coalesce(far, 1 - rr)


def pair_improved(frr: Column, far: Column, base_frr: Column, base_far: Column) -> Column:
    """One of both rates better and none worse; false where a rate is missing."""
    worse, better = (frr > base_frr + TIE) | (far > base_far + TIE), (frr < base_frr - TIE) | (far < base_far - TIE)
    return F.coalesce(better & ~worse, F.lit(False))
