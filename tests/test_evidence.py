import pytest
from pyspark.sql import functions as F

from voxsieve.functions.scalars import content_hash
from voxsieve.operators import evidence as ev
from voxsieve.streaming.incremental import absorb, follow

SIDE = "row_id long, candidate_id string, score_key string, pcm_sha256 string, wake_text string, lang string, hyp string, nll double, q_kw double, score_kind string, calibrator_hash string"


def side(spark, *rows):
    names = [c.split()[0] for c in SIDE.split(", ")]
    return spark.createDataFrame([tuple(({"row_id": i + 1} | r).get(n) for n in names) for i, r in enumerate(rows)], SIDE)


CAND = "row_id long, candidate_id string, score_key string, pcm_sha256 string, wake_text string, lang string, extra string"


def test_keys_in_order_of_priority(spark):
    s = side(spark, {"candidate_id": "c1", "hyp": "by id"}, {"score_key": "k1", "hyp": "by key"}, {"pcm_sha256": "p2", "wake_text": "hey", "lang": "en", "hyp": "by content"}, {"pcm_sha256": "p3", "hyp": "by audio"}, {"score_key": "", "candidate_id": None}, {"score_key": "k1", "hyp": "later"})
    c = spark.createDataFrame([(1, "c1", "k1", None, None, None, "x"), (2, "c1", "k9", None, None, None, "x"), (3, "c9", "", "p2", "hey", "en", "x"), (4, None, None, "p3", "hey", None, "x"), (5, None, None, "p3", "hey", "en", "x"), (6, None, None, None, None, None, "x")], CAND)
    got = {r.row_id: r.ev_hyp for r in ev.with_evidence(c, s, ["hyp"]).collect()}
    assert got == {1: "by key", 2: "by id", 3: "by content", 4: "by audio", 5: None, 6: None}
    assert {r.row_id: r.evidence_row for r in ev.matched(c, s, last=True).collect()}[1] == 6
    assert ev.unmatched_keys(c, ev.matched(c, s)).collect() == [] and ev.matched(c, s.limit(0)).count() == 0


def test_conflicts_and_bindings(spark):
    s = side(spark, {"candidate_id": "a", "pcm_sha256": "p", "hyp": "x"}, {"candidate_id": "b", "pcm_sha256": "p", "hyp": "y"}, {"candidate_id": "a", "hyp": "z"}, {"candidate_id": "a", "hyp": None, "nll": 1.0})
    assert [(r.key, r.row_id, r.first_row_id) for r in ev.conflicts(s).collect()] == [("id:a", 3, 1)]
    c = spark.createDataFrame([(1, "a", None, "other", "hey", "en", "x")], CAND)
    bad = ev.binding_violations(ev.with_evidence(c, s, ["pcm_sha256", "wake_text", "lang"])).collect()
    assert len(bad) == 1 and bad[0].bad_pcm and not bad[0].bad_wake


def test_probability_contract(spark):
    good = {"q_kw": 0.5, "score_kind": "calibrated_qkw", "calibrator_hash": "h"}
    s = side(spark, {"score_key": "ok", **good}, {"score_key": "kind", **good, "score_kind": "nll"}, {"score_key": "hash", **good, "calibrator_hash": "z"}, {"score_key": "range", **good, "q_kw": 1.5}, {"score_key": "missing", **good, "q_kw": None})
    c = spark.createDataFrame([(i, None, k, None, None, None, "x") for i, k in enumerate(["ok", "kind", "hash", "range", "missing", "absent", "ok"])], CAND)
    got = {r.score_key: r.state for r in ev.probability_contract(c, s, "h").collect()}
    assert got == {"ok": "ok", "kind": "kind", "hash": "hash", "range": "range", "missing": "missing", "absent": "missing"}


def test_content_hash_is_that_of_compact_json(spark):
    import hashlib
    import json

    row = spark.createDataFrame([("p", '小"路\\', None)], "a string, b string, c string").select(content_hash(F.col("a"), F.col("b"), F.col("c")).alias("h")).first()
    assert row.h == hashlib.sha256(json.dumps(["p", '小"路\\', None], ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()


@pytest.mark.parametrize(
    ("cov", "core", "extra", "hyp", "music", "speech", "overlap", "want"),
    [
        (1.0, True, 0.0, "x", 0.0, 0.9, 0.0, "target_wake"), (0.8, True, 0.35, "x", 0.0, 0.9, 0.0, "target_plus_interference"), (0.1, False, 0.0, "x", 0.7, 0.2, 0.0, "noise_or_music"), (0.1, False, 0.0, "x", 0.0, 0.5, 0.0, "competing_speech"),
        (0.1, False, 0.0, " ", 0.0, 0.5, 0.0, "noise_or_music"), (0.6, False, 0.0, "x", 0.0, 0.5, 0.0, "uncertain_or_hallucination"), (None, False, None, "x", None, None, None, "noise_or_music"),
    ],
)
def test_content_classes(spark, cov, core, extra, hyp, music, speech, overlap, want):
    d = spark.createDataFrame([(False, cov, core, extra, hyp, music, speech, overlap)], "f boolean, cov double, core boolean, extra double, hyp string, m double, s double, o double")
    assert d.select(ev.classify_content(*[F.col(c) for c in d.columns]).alias("c")).first().c == want


def test_absorbing_batches_once(spark, tmp_path):
    target = f"file://{tmp_path}/kept"
    one, two = (spark.createDataFrame(x, "k string, v int") for x in ([("a", 1), ("a", 1), (None, 2)], [("a", 9), ("b", 2)]))
    absorb(one, target, "k", 0)
    absorb(two, target, "k", 1)
    absorb(two, target, "k", 1)
    assert sorted((r.k, r.v) for r in spark.read.parquet(target).collect()) == [("a", 1), ("b", 2)]
    one.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k string, v int").parquet(f"{tmp_path}/in")
    for _ in range(2):
        follow(stream, f"file://{tmp_path}/live", "k", f"{tmp_path}/progress").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/live").count() == 1
