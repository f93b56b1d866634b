import datetime
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from voxsieve.operators.ordered import exact_quantile, neighbours, numbered, running_total
from voxsieve.operators.reporting import global_rank, runs
from voxsieve.operators.skew import heavy_keys, salted_left_join


def timed(spark, n=900):
    rng = random.Random(3)
    t0 = datetime.datetime(2025, 1, 1)
    return spark.createDataFrame([("hot" if i % 3 else f"k{i % 7}" if i % 11 else None, None if i % 50 == 0 else t0 + datetime.timedelta(seconds=rng.randrange(400)), i) for i in range(n)], "k string, t timestamp, i int")


def test_numbering_in_blocks_equals_one_window(spark):
    got = numbered(timed(spark), ["k"], "t", ["i"], "no", rows_per_block=40).toPandas()
    want = got.sort_values(["t", "i"], na_position="first").groupby("k", dropna=False).cumcount() + 1
    assert (got.no == want.reindex(got.index)).all() and len(got) == 900
    assert numbered(timed(spark).limit(0), ["k"], "t", ["i"], "no").count() == 0


def test_running_total(spark):
    d = spark.range(2000).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("h"), "id", (F.col("id") % 17).alias("v"))
    got = running_total(d, ["g"], "h", ["id"], "v", "total").toPandas()
    got["u"] = got.h.astype("uint64")
    got = got.sort_values(["g", "u", "id"])
    # the order is that of the top 16 bits, then of the rest; each row gets the sum before it
    got["b"], got["rest"] = (got.u >> np.uint64(48)).astype(int), (got.u << np.uint64(16)).astype("int64")
    got = got.sort_values(["g", "b", "rest", "id"])
    assert (got.groupby("g").v.cumsum() - got.v == got.total).all()


def test_neighbours_over_block_edges(spark):
    rng = random.Random(5)
    rows = [("a", i, rng.choice([None, "x", "y"])) for i in range(1, 300) if rng.random() > 0.3] + [("b", 7, None)]
    got = neighbours(spark.createDataFrame(rows, "k string, no int, t string"), ["k"], "no", "t", rows_per_block=16).orderBy("k", "no").collect()
    last, prev = {}, {}
    for r in got:
        assert r.prev_no == prev.get(r.k) and r.last_t == last.get(r.k)
        prev[r.k] = r.no
        last[r.k] = r.t or last.get(r.k)
    assert [r.next_no for r in got if r.k == "a"][:-1] == [r.no for r in got if r.k == "a"][1:]


def test_quantile_equals_numpy(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": rng.integers(0, 4, 500), "v": rng.normal(size=500).round(1)})
    got = {r.k: r.q for r in exact_quantile(spark.createDataFrame(pdf), ["k"], "v", 0.2, "q").collect()}
    for k, v in pdf.groupby("k").v:
        assert abs(got[k] - np.quantile(v, 0.2)) < 1e-12


def test_global_rank_and_runs(spark):
    d = spark.range(500).select(((F.col("id") * 7919) % 1000).alias("x"))
    assert [r.r for r in global_rank(d, [F.col("x")], "r").orderBy("x").collect()] == list(range(1, 501))
    bits = [1, 1, 0, 1, 1, 1, 0, 0, 1]
    d = spark.createDataFrame([("u", i + 1, b) for i, b in enumerate(bits)], "u string, no int, b int")
    assert sorted((r.start, r.length) for r in runs(d, ["u"], "no", F.col("b") == 1).collect()) == [(1, 2), (4, 3), (9, 1)]


def test_hot_keys_are_found_and_salted(spark):
    refs = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("key"), "id")
    hot = heavy_keys(refs, F.col("key"), min_rows=100)
    assert hot == ["hot"]
    lookup = refs.select("key").distinct().withColumn("v", F.length("key"))
    got = salted_left_join(refs, lookup, "key", "id", hot, 8)
    assert got.count() == 3000 and got.where("v is null").count() == 0
    assert heavy_keys(refs.limit(0), F.col("key")) == []
