import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.duck import ROOT, check, connection
from voxsieve.operators import ranks
from voxsieve.operators import selection as sel
from voxsieve.plans import selection as plans
from voxsieve.policy import CLOSE, Policy

SCHEMA = "row_id long, candidate_id string, group_key string, uid string, split string, role string, view string, stream string, pcm_sha256 string, source_wav string, content_class string, validity string, qkw_calibrated boolean, s7_available boolean, decode_ok boolean, deleted_at timestamp, " + ", ".join(f"{m} double" for m in sel.METRICS)
BASE = dict.fromkeys(c.split()[0] for c in SCHEMA.split(", ")) | {"uid": "u", "split": "pos", "stream": "original", "source_wav": "/x.wav", "content_class": "target_wake", "validity": "rankable", "qkw_calibrated": False, "s7_available": True, "decode_ok": True, "view": "raw", "cer_route": 0.0, "nll": 1.0, "clip_rate": 0.0, "speech_ratio": 0.7, "p_overlap": 0.0, "extra_ratio": 0.0}


def frame(spark, rows):
    full = [BASE | {"candidate_id": f"C{i}", "row_id": i, "pcm_sha256": f"p{i}"} | r for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r[k] for k in BASE) for r in full], SCHEMA), full


def order(stream):
    if stream == "original":
        return 0
    if stream and stream.startswith("spk"):
        n = int(stream[3:])
        return n if n <= 4 else n + 1
    return 1000


def model(rows, p):
    """Row-wise winner of one group's rankable rows."""
    pool = [r for r in rows if r["validity"] == "rankable" and r["cer_route"] is not None]
    if not pool:
        return None
    least = min(r["cer_route"] for r in pool)
    pool = [r for r in pool if r["cer_route"] <= least + (p.cer_close_delta + 1e-12)]

    def keep(pool, f, margin, sign):
        values = [f(r) for r in pool]
        if any(v is None for v in values):
            return pool
        best = min(sign * v for v in values)
        return [r for r, v in zip(pool, values) if sign * v - best < margin - 1e-15 or abs(sign * v - best) <= 1e-12]

    if all(r["qkw_calibrated"] and r["q_kw"] is not None for r in pool):
        pool = keep(pool, lambda r: r["q_kw"], p.qkw_switch_margin, -1)
    elif all(r["keyword_score"] is not None for r in pool):
        pool = keep(pool, lambda r: r["keyword_score"], p.qkw_switch_margin, -1)
    else:
        pool = keep(pool, lambda r: r["nll"], p.nll_switch_margin, 1)
    for m, margin, sign in (("speaker_ref_score", 0.01, -1), ("extra_ratio", 0.1, 1), ("p_music", 0.05, 1), ("p_overlap", 0.05, 1), ("clip_rate", 0.1, 1), ("snr_vad_db", 1.0, -1), ("dnsmos_ovrl", 0.2, -1)):
        pool = keep(pool, lambda r: r[m], margin, sign)
    prefer = p.prefer_se_on_close_cer and p.cer_close_delta > 0
    if prefer and any(r["view"] == "moss48k" for r in pool):
        pool = [r for r in pool if r["view"] == "moss48k"]
    return min(pool, key=lambda r: (r["view"] != ("moss48k" if prefer else "raw"), order(r["stream"]), r["stream"] or "", r["stream"] != "original", r["candidate_id"]))["candidate_id"]


def sampled(rng, groups=150):
    rows = []
    some = lambda *v: rng.choice([*v, None])
    for g in range(groups):
        lacks = rng.random()
        for _ in range(rng.randint(1, 7)):
            rows.append(
                {
                    "group_key": f"g{g}", "role": rng.choice(["s1", "s7"]), "view": rng.choice(["raw", "moss48k"]), "stream": rng.choice(["original", "spk1", "spk4", "spk5", "spk12", "odd", None]), "validity": rng.choice(["rankable"] * 5 + ["fatal_invalid"]),
                    "cer_route": some(0.0, 0.01, 0.02, 0.03, 0.5), "qkw_calibrated": rng.random() < (1.0 if lacks < 0.4 else 0.5), "q_kw": rng.choice([0.5, 0.505, 0.51, 0.7]) if lacks < 0.5 else some(0.5), "keyword_score": rng.choice([0.1, 0.105, 0.11]) if lacks < 0.7 else some(0.1), "nll": rng.choice([1.0, 1.005, 1.01, 2.0]),
                    "speaker_ref_score": rng.choice([0.3, 0.305, 0.4]) if lacks < 0.6 else some(0.3), "extra_ratio": rng.choice([0.0, 0.05, 0.1]), "p_music": rng.choice([0.1, 0.14, 0.15]) if lacks > 0.3 else some(0.1), "p_overlap": rng.choice([0.0, 0.04, 0.05]), "clip_rate": rng.choice([0.0, 0.1]), "snr_vad_db": rng.choice([5.0, 5.5, 6.0]) if lacks > 0.2 else some(5.0), "dnsmos_ovrl": rng.choice([2.0, 2.1, 2.2]),
                }
            )
    return rows


@pytest.mark.parametrize("policy", [Policy(), CLOSE])
@pytest.mark.parametrize("hot", [[], ["g3", "g7", "g20"]])
def test_winners_equal_the_row_wise_model(spark, policy, hot):
    df, rows = frame(spark, sampled(random.Random(11)))
    got = {(r.group_key, r.role): r.winner.candidate_id for r in sel.stage_winners(df, policy, hot=hot).collect()}
    groups = {}
    for r in rows:
        groups.setdefault((r["group_key"], r["role"]), []).append(r)
    want = {k: w for k, g in groups.items() if (w := model(g, policy)) is not None}
    assert got == want


def test_ranks_repeat_the_elimination(spark):
    df, rows = frame(spark, sampled(random.Random(2), 25))
    got = {(r.group_key, r.role, r.stage_rank): r.candidate_id for r in sel.stage_ranks(df, CLOSE).collect()}
    want, groups = {}, {}
    for r in rows:
        groups.setdefault((r["group_key"], r["role"]), []).append(r)
    for k, g in groups.items():
        n = 0
        while (w := model(g, CLOSE)) is not None:
            n += 1
            want[(*k, n)] = w
            g = [r for r in g if r["candidate_id"] != w]
    assert got == want


@pytest.mark.parametrize("policy", [Policy(), CLOSE])
@pytest.mark.parametrize("hot", [[], ["g0", "g1"]])
def test_ranks_of_large_groups(spark, policy, hot):
    """Groups far above an Arrow batch's share, whole or cut at gaps of their errors, against repeated elimination row by row."""
    rng = random.Random(5)
    rows = [r | {"group_key": f"g{i % 3}", "nll": rng.random(), "cer_route": r["cer_route"] and rng.choice([0.1, 0.115, 0.13, 0.5])} for i, r in enumerate(sampled(rng, 150))]
    df, rows = frame(spark, rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {(r.group_key, r.role, r.stage_rank): r.candidate_id for r in sel.stage_ranks(df, policy, hot=hot).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want, groups = {}, {}
    for r in rows:
        groups.setdefault((r["group_key"], r["role"]), []).append(r)
    for k, g in groups.items():
        n = 0
        while (w := model(g, policy)) is not None:
            n += 1
            want[(*k, n)] = w
            g = [r for r in g if r["candidate_id"] != w]
    assert got == want and max(n for *_, n in want) > 50


def test_arrays_and_lists_narrow_alike():
    rng = random.Random(4)
    for lacks in (0.0, 0.01):
        values = [float("nan") if rng.random() < lacks else rng.choice([0.1, 0.1 + 5e-13, 0.11, 0.12, rng.random()]) for _ in range(300)]
        pool = rng.sample(range(300), 200)
        most, ranks._ARRAYS_FROM = ranks._ARRAYS_FROM, 1000
        by_list = ranks._narrow(pool, values, np.array(values), 0.01)
        ranks._ARRAYS_FROM = most
        assert ranks._narrow(pool, values, np.array(values), 0.01) == by_list


def test_the_query_ranks_every_rankable_candidate(spark):
    """No candidate of the table is left out; the first three ranks are those of the SQL."""
    root = f"{ROOT}/sf0.001"
    got = plans.QUERIES["stage_rank"](spark, root)
    assert got.count() == plans.QUERIES["rankable_filter"](spark, root).count()
    assert got.groupBy("group_key", "role").agg(F.max("stage_rank").alias("m"), F.count(F.lit(1)).alias("n"), F.count_distinct("stage_rank").alias("d")).where("m <> n or d <> n").count() == 0
    check(got, connection("sf0.001"), plans.ORACLES["stage_rank"])


CASES = [
    ({"cer_route": 0.0}, {"cer_route": 0.0}, "KEEP_S1_CER0_TRUSTED"),
    ({"cer_route": 0.25}, {"cer_route": 0.0}, "SWITCH_S7_LOWER_CER"),
    ({"cer_route": 0.2, "pcm_sha256": "aaa"}, {"cer_route": 0.2, "pcm_sha256": "aaa"}, "SAME_AUDIO_KEEP_S1"),
    ({"cer_route": 0.1}, {"cer_route": 0.4}, "KEEP_S1_LOWER_CER"),
    ({"cer_route": 0.2, "nll": 1.0}, {"cer_route": 0.2, "nll": 0.2}, "SWITCH_S7_EQUAL_CER_NLL_GAIN"),
    ({"cer_route": 0.2, "nll": 1.0}, {"cer_route": 0.2, "nll": 0.99}, "SWITCH_S7_EQUAL_CER_NLL_GAIN"),
    ({"cer_route": 0.2, "q_kw": 0.8, "qkw_calibrated": True, "keyword_score": 0.1}, {"cer_route": 0.2, "q_kw": 0.805, "qkw_calibrated": True, "keyword_score": 1.0}, "KEEP_S1_TIE_NO_GAIN"),
    ({"cer_route": 0.2, "q_kw": 0.8, "qkw_calibrated": True}, {"cer_route": 0.2, "q_kw": 0.9, "qkw_calibrated": True}, "SWITCH_S7_EQUAL_CER_QKW_GAIN"),
    ({"cer_route": 0.2, "keyword_score": 0.1}, {"cer_route": 0.2, "keyword_score": 0.9}, "SWITCH_S7_EQUAL_CER_CTC_GAIN"),
    ({"cer_route": 0.3, "speaker_ref_score": 0.1}, {"cer_route": 0.3, "speaker_ref_score": 0.2}, "SWITCH_S7_EQUAL_CER_SPK_GAIN"),
    ({"cer_route": 0.3}, {"cer_route": 0.3, "validity": "fatal_invalid"}, "KEEP_S1_S7_NO_RANKABLE"),
    ({"cer_route": 0.3, "s7_available": False}, {"cer_route": 0.1, "s7_available": False}, "KEEP_S1_S7_UNAVAILABLE"),
    ({"cer_route": 0.3, "validity": "semantic_ineligible"}, {"cer_route": 0.1}, "SWITCH_S7_S1_UNAVAILABLE"),
    ({"cer_route": 0.3, "validity": "semantic_ineligible"}, None, "AUDIT_FALLBACK_S1_RAW"),
    ({"cer_route": None}, None, "FAIL_NO_DECODABLE_S1"),
    ({"cer_route": 0.2, "p_overlap": 0.2}, {"cer_route": 0.2, "p_overlap": 0.1}, "KEEP_S1_TIE_NO_GAIN"),
]


def test_decisions(spark):
    rows = []
    for i, (a, b, _) in enumerate(CASES):
        rows.append({"group_key": f"g{i:02d}", "role": "s1"} | a)
        if b is not None:
            rows.append({"group_key": f"g{i:02d}", "role": "s7"} | b)
    df, _ = frame(spark, rows)
    got = {r.group_key: r for r in sel.decisions(df, Policy()).collect()}
    assert [got[f"g{i:02d}"].reason_code for i in range(len(CASES))] == [c for *_, c in CASES]
    assert got["g14"].selected_id is None and got["g14"].selection_mode == "fail" and "rule: FAIL" in got["g14"].trace
    close = {r.group_key: r.reason_code for r in sel.decisions(df, CLOSE).collect()}
    assert close["g15"] == "SWITCH_S7_CLOSE_CER_QUALITY_GAIN"


def test_views_and_margins(spark):
    pairs = [
        ({"nll": 1.0}, {"nll": 0.999}, "C0", "RAW_CONSERVATIVE_TIE"),
        ({"nll": 1.0}, {"nll": 0.98}, "C1", "MOSS_EQUAL_CER_NLL_GAIN"),
        ({"cer_route": 0.5}, {"cer_route": 0.1}, "C1", "MOSS_LOWER_CER"),
        ({"cer_route": 0.1}, {"cer_route": 0.5}, "C0", "RAW_LOWER_CER"),
    ]
    for a, b, winner, reason in pairs:
        df, _ = frame(spark, [{"group_key": "g", "role": "s1"} | a, {"group_key": "g", "role": "s1", "view": "moss48k"} | b])
        r = sel.stage_winners(df, Policy(), hot=[]).select("winner.candidate_id", sel.view_reason(Policy()).alias("why")).first()
        assert (r.candidate_id, r.why) == (winner, reason)


def test_copies_deleted_rows_and_missing_groups(spark):
    rows = [("a", 2, 0.5, None), ("a", 1, 0.25, None), ("b", 3, float("nan"), None), ("c", 4, 0.0, "2025-01-01"), (None, 5, 0.0, None)]
    df = spark.createDataFrame(rows, "candidate_id string, row_id long, cer_route double, d string").selectExpr("candidate_id", "row_id", "cer_route", "cast(d as timestamp) deleted_at", "cast(null as string) group_key", "'pos' split", "'u' uid", "named_struct('clip_rate', 0.5D) audio_quality")
    got = {r.candidate_id: r for r in sel.candidates(df).collect()}
    assert set(got) == {"a", "b"} and got["a"].cer_route == 0.25 and got["b"].cer_route is None and got["a"].group_key == "pos\0u" and got["a"].clip_rate == 0.5


def test_the_chain_needs_one_exchange(spark):
    df, _ = frame(spark, sampled(random.Random(1), 5))
    plan = sel.eliminate(sel.rankable(df), ["group_key", "role"], sel.links(CLOSE))._jdf.queryExecution().sparkPlan().toString()
    executed = sel.eliminate(sel.rankable(df), ["group_key", "role"], sel.links(CLOSE))._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning") == 1 and plan.count("Window") >= 10


def test_policy_layers():
    p = Policy.of({"cer_close_delta": 0.02, "notes": "x"}, {"cer_close_delta": None, "nll_switch_margin": 0.5})
    assert p.cer_close_delta == 0.02 and p.nll_switch_margin == 0.5 and p.digest() != Policy().digest()
