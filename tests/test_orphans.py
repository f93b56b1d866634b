from pyspark.sql import functions as F

from voxsieve.operators.orphans import orphan_report, orphans, parent_intervals, references

PARENT = "candidate_id string, score_key string, loaded_at timestamp, deleted_at timestamp"


def t(day):
    return F.to_timestamp(F.lit(f"2025-01-{day:02d}"))


def tables(spark):
    parents = spark.sql(
        """SELECT * FROM VALUES ('a', 'k1', timestamp'2025-01-01', null), ('a', 'k1', timestamp'2025-01-09', null), ('d', 'k2', timestamp'2025-01-01', timestamp'2025-01-02'),
        ('late', 'k3', timestamp'2025-02-01', null), ('both', null, timestamp'2025-01-01', timestamp'2025-01-02'), ('both', '', timestamp'2025-03-01', null), ('', 'k4', timestamp'2025-01-01', null), ('A', null, null, null)
        AS t(candidate_id, score_key, loaded_at, deleted_at)"""
    )
    refs = spark.sql(
        """SELECT * FROM VALUES (1, 'a', timestamp'2025-01-05'), (2, 'd', timestamp'2025-01-05'), (3, 'late', timestamp'2025-01-05'), (4, 'both', timestamp'2025-01-05'), (5, 'nope', timestamp'2025-01-05'), (6, '', timestamp'2025-01-05'), (7, null, timestamp'2025-01-05'),
        (8, 'nope', null), (9, 'late', null), (10, 'A', timestamp'2025-01-05'), (11, 'a ', timestamp'2025-02-05'), (12, 'late', timestamp'2025-02-01') AS t(row_id, parent, at)"""
    )
    return parents.withColumn("key", F.lit("clash")).withColumn("_salt", F.lit(1)), refs.withColumn("kind", F.lit("clash"))


WANT = {2: "deleted", 3: "late", 4: "late", 5: "missing", 8: "missing", 11: "missing"}


def test_kinds_with_and_without_salting(spark):
    parents, refs = tables(spark)
    r = references(refs, "t", "row_id", "parent", "candidate_id", "at")
    for hot in ([], ["candidate_id:late", "candidate_id:a", "candidate_id:nope"]):
        found = orphans(r, parent_intervals(parents, ["candidate_id", "score_key"]), hot, 4)
        assert {x.row_id: x.kind for x in found.collect()} == WANT
    report = {(x.month, x.kind): x.n_rows for x in orphan_report(found).collect()}
    assert report[("2025-01", "late")] == 2 and report[("unknown", "missing")] == 1


def test_key_columns_do_not_mix(spark):
    parents, refs = tables(spark)
    r = references(refs.withColumn("parent", F.lit("k1")), "t", "row_id", "parent", "candidate_id", "at")
    assert {x.kind for x in orphans(r, parent_intervals(parents, ["candidate_id", "score_key"])).collect()} == {"missing"}


def test_empty_tables(spark):
    parents, refs = tables(spark)
    r = references(refs, "t", "row_id", "parent", "candidate_id", "at")
    assert orphans(r.limit(0), parent_intervals(parents, ["candidate_id"])).count() == 0
    assert {x.kind for x in orphans(r, parent_intervals(parents.limit(0), ["candidate_id"])).collect()} == {"missing"}


def test_both_sides_are_merged_after_one_exchange_each(spark):
    parents, refs = tables(spark)
    plan = orphans(references(refs, "t", "row_id", "parent", "candidate_id", "at"), parent_intervals(parents, ["candidate_id"]), [])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and plan.count("Exchange hashpartitioning") == 2
