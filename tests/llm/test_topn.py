import random

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.duck import ROOT, check, connection
from voxsieve.llm import topn


def test_p2_agrees_with_sql(spark):
    con = connection("sf0.01")
    check(entry.queries()["p2_found"](spark, f"{ROOT}/sf0.01"), con, entry.oracle_sql()["p2_found"])


def test_ties_copies_nulls_and_hot_groups(spark):
    rng = random.Random(1)
    rows = [("big" if i % 3 else f"g{i % 10}" if i % 7 else None, f"c{i // 2}", rng.choice([0.0, -0.0, 0.5, None, float("nan"), float("inf"), float("-inf")]), None) for i in range(4000)]
    rows += [("big", f"c{i}", 0.0, "x") for i in range(50)] + [("one", "ü", 1.0, None), ("one", "z", 1.0, None), ("one", None, 0.0, None)]
    df = spark.createDataFrame(rows, "g string, id string, s double, gone string").withColumns({"item": F.lit("clash"), "score": F.lit(1), "rank_no": F.lit(1)})
    got = {(r.group_key, r.rank_no): r.item for r in topn.top_n(topn.distinct_scores(df, "g", "id", "s", "gone"), 3).collect()}
    best = {}
    for g, i, s, gone in rows:
        if g and i and gone is None and s is not None and s == s and abs(s) != float("inf"):
            best.setdefault(g, {})[i] = min(s, best.setdefault(g, {}).get(i, s))
    want = {(g, k + 1): i for g, items in best.items() for k, (i, _) in enumerate(sorted(items.items(), key=lambda x: (x[1] + 0.0, x[0]))[:3])}
    assert got == want
    assert topn.top_n(topn.distinct_scores(df.limit(0), "g", "id", "s"), 3).count() == 0
    assert topn.top_n(topn.distinct_scores(df, "g", "id", "s"), 0).count() == 0


def test_the_group_limit_prunes_before_and_after_the_shuffle(spark):
    df = entry.queries()["p2_found"](spark, f"{ROOT}/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan and "Final" in plan
