"""Selection queries over ``scored_candidates`` and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxsieve.functions.scalars import finite
from voxsieve.operators import selection as sel
from voxsieve.policy import CLOSE, Policy
from voxsieve.sources.tables import table

EXACT = Policy()


def _candidates(spark: SparkSession, root: str) -> DataFrame:
    return sel.candidates(table(spark, root, "scored_candidates"))


def hot_groups(spark: SparkSession, root: str) -> list:
    """Groups that hold a large part of the rows, from one scan of one column."""
    return sel.heavy_keys(table(spark, root, "scored_candidates"), F.col("group_key"))


def finite_filter(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "scored_candidates").where(finite(F.col("cer_route")).isNotNull()).select("row_id", "cer_route")


def rankable_filter(spark: SparkSession, root: str) -> DataFrame:
    return sel.rankable(_candidates(spark, root)).select("candidate_id", "role", "cer_route")


def _pool_after(spark: SparkSession, root: str, chain: list[sel.Link]) -> DataFrame:
    r = sel.rankable(_candidates(spark, root))
    return sel.eliminate(r, ["group_key", "role"], chain, hot_groups(spark, root), "group_key").where("alive").select("group_key", "role", "candidate_id")


def margin_pool(spark: SparkSession, root: str) -> DataFrame:
    return _pool_after(spark, root, [sel.metric_link("nll", 0.05, False), sel.metric_link("p_overlap", 0.05, False)])


def _winners(spark: SparkSession, root: str, p: Policy) -> DataFrame:
    w = sel.stage_winners(_candidates(spark, root), p, hot=hot_groups(spark, root))
    return w.select("group_key", "role", "n_candidates", "min_cer", "n_cer_close", "n_tied", F.col("winner.candidate_id").alias("winner"), F.col("winner.view").alias("winner_view"), F.col("winner.cer_route").alias("winner_cer"), sel.view_reason(p).alias("view_reason"))


def stage_winner(spark: SparkSession, root: str) -> DataFrame:
    return _winners(spark, root, EXACT).drop("view_reason")


def stage_winner_close_cer(spark: SparkSession, root: str) -> DataFrame:
    return _winners(spark, root, CLOSE).drop("view_reason")


def view_reason(spark: SparkSession, root: str) -> DataFrame:
    return _winners(spark, root, CLOSE).select("group_key", "role", "winner", "view_reason")


def conservative_tiebreak(spark: SparkSession, root: str) -> DataFrame:
    r = sel.rankable(_candidates(spark, root))
    return r.groupBy("group_key", "role").agg(F.min_by("candidate_id", sel.conservative_key()).alias("first_id"))


def cer_rank(spark: SparkSession, root: str) -> DataFrame:
    return sel.error_ranks(_candidates(spark, root)).select("candidate_id", "cer_rank")


def stage_rank(spark: SparkSession, root: str) -> DataFrame:
    return sel.stage_ranks(_candidates(spark, root), CLOSE, hot=hot_groups(spark, root))


def availability(spark: SparkSession, root: str) -> DataFrame:
    return _candidates(spark, root).groupBy("group_key").agg(F.coalesce(F.bool_or("s7_available"), F.bool_or(F.col("role") == "s7")).alias("available"))


def _sides(spark: SparkSession, root: str, p: Policy) -> DataFrame:
    w = sel.stage_winners(_candidates(spark, root), p, hot=hot_groups(spark, root))
    return w.groupBy("group_key").agg(F.max(F.when(F.col("role") == "s1", F.col("winner"))).alias("w1"), F.max(F.when(F.col("role") == "s7", F.col("winner"))).alias("w7"))


def tie_gains(spark: SparkSession, root: str) -> DataFrame:
    return _sides(spark, root, CLOSE).select("group_key", *[sel.gain(k, "w7", "w1").alias(f"{k}_gain") for k in ("q_kw", "keyword", "nll", "speaker")])


def quality_gain(spark: SparkSession, root: str) -> DataFrame:
    return _sides(spark, root, CLOSE).where("w1 is not null and w7 is not null").select("group_key", sel.not_worse("w7", "w1", 0.1).alias("not_worse"), sel.quality_gain("w7", "w1", CLOSE).alias("gains"))


def trigger_reasons(spark: SparkSession, root: str) -> DataFrame:
    return _sides(spark, root, CLOSE).select("group_key", F.array_join(sel.trigger_reasons("w1", Policy.of({"qkw_low_thr": 0.5})), "+").alias("reasons"))


def audit_fallback(spark: SparkSession, root: str) -> DataFrame:
    c = _candidates(spark, root).where("role = 's1' and view = 'raw' and decode_ok and cer_route is not null")
    return c.groupBy("group_key").agg(F.min_by("candidate_id", F.struct("cer_route", "candidate_id")).alias("fallback"))


def route_decision(spark: SparkSession, root: str) -> DataFrame:
    return sel.decisions(_candidates(spark, root), CLOSE, hot_groups(spark, root)).drop("s1_view_reason", "s7_view_reason")


def reason_counts(spark: SparkSession, root: str) -> DataFrame:
    return sel.decisions(_candidates(spark, root), CLOSE, hot_groups(spark, root)).groupBy("reason_code").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    f.__name__: f
    for f in (finite_filter, rankable_filter, margin_pool, stage_winner, stage_winner_close_cer, view_reason, conservative_tiebreak, cer_rank, stage_rank, availability, tie_gains, quality_gain, trigger_reasons, audit_fallback, route_decision, reason_counts)
}

CAND = """cand AS MATERIALIZED (
  SELECT candidate_id, coalesce(group_key, split || chr(0) || uid) AS group_key, uid, split, wake_text, lang, role, arm, stream, view, source_wav, pcm_sha256, score_key, raw_parent_candidate_id,
    CASE WHEN isfinite(cer_route) THEN cer_route END AS cer_route, CASE WHEN isfinite(nll) THEN nll END AS nll, CASE WHEN isfinite(q_kw) THEN q_kw END AS q_kw, qkw_calibrated, extra_ratio,
    audio_quality.clip_rate AS clip_rate, audio_quality.speech_ratio AS speech_ratio, audio_quality.p_overlap AS p_overlap, validity, content_class, s7_available, decode_ok, row_id, loaded_at
  FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY row_id) AS nth FROM scored_candidates WHERE deleted_at IS NULL AND candidate_id IS NOT NULL) WHERE nth = 1)"""


def _order(prefer: bool) -> str:
    view = "moss48k" if prefer else "raw"
    slot = "CASE WHEN stream = 'original' THEN 0 WHEN regexp_matches(stream, '^spk[1-4]$') THEN substr(stream, 4)::INT WHEN regexp_matches(stream, '^spk[0-9]+$') THEN substr(stream, 4)::INT + 1 ELSE 1000 END"
    return f"CASE WHEN view = '{view}' THEN 0 ELSE 1 END, {slot}, stream, CASE WHEN stream = 'original' THEN 0 ELSE 1 END, candidate_id"


def _chain(p: Policy, source: str = "cand", cand: bool = True) -> str:
    """CTEs l0, l1, ... that each keep the rows that the next link leaves; ``last`` is the final pool."""
    part = "OVER (PARTITION BY group_key, role)"
    d = p.cer_close_delta
    ctes = [f"r AS (SELECT * FROM {source} WHERE validity = 'rankable' AND cer_route IS NOT NULL)", f"l0 AS (SELECT * FROM r QUALIFY cer_route <= min(cer_route) {part} + {d + 1e-12!r})"]
    near = lambda gap, m: f"({gap} < {m} - 1e-15 OR abs({gap}) <= 1e-12)"
    q = "CASE WHEN qkw_calibrated THEN q_kw END"
    ctes.append(
        f"l1 AS (SELECT * FROM l0 QUALIFY CASE WHEN count(*) {part} = count({q}) {part} THEN {near(f'(max({q}) {part} - q_kw)', p.qkw_switch_margin)} "
        f"WHEN count(*) {part} = count(nll) {part} THEN {near(f'(nll - min(nll) {part})', p.nll_switch_margin)} ELSE true END)"
    )
    at = 1
    for m, margin in (("extra_ratio", p.quality_regression_tolerance), ("p_overlap", p.noise_switch_margin), ("clip_rate", p.quality_regression_tolerance)):
        ctes.append(f"l{at + 1} AS (SELECT * FROM l{at} QUALIFY CASE WHEN count(*) {part} = count({m}) {part} THEN {near(f'({m} - min({m}) {part})', margin)} ELSE true END)")
        at += 1
    prefer = p.prefer_se_on_close_cer and d > 0
    if prefer:
        ctes.append(f"l{at + 1} AS (SELECT * FROM l{at} QUALIFY view = 'moss48k' OR count(*) FILTER (WHERE view = 'moss48k') {part} = 0)")
        at += 1
    ctes.append(f"ends AS (SELECT *, count(*) {part} AS n_tied, row_number() OVER (PARTITION BY group_key, role ORDER BY {_order(bool(prefer))}) AS nth FROM l{at})")
    ctes.append(
        f"stats AS (SELECT group_key, role, count(*) AS n_candidates, min(cer_route) AS min_cer FROM r GROUP BY ALL), "
        f"near AS (SELECT group_key, role, count(*) AS n_cer_close FROM l0 GROUP BY ALL), "
        "win AS (SELECT ends.*, n_candidates, min_cer, n_cer_close FROM ends JOIN stats USING (group_key, role) JOIN near USING (group_key, role) WHERE nth = 1)"
    )
    return (f"WITH {CAND}, " if cand else "WITH ") + ",\n".join(ctes)


def _ranks(p: Policy) -> str:
    """All ranks: each step finds the winners of what earlier steps left and passes on the rest."""
    part = "OVER (PARTITION BY group_key, role)"
    near = lambda gap, m: f"({gap} < {m} - 1e-15 OR abs({gap}) <= 1e-12)"
    count = lambda x, k: f"count({x}) FILTER (WHERE a{k}) {part}"
    least = lambda x, k: f"min({x}) FILTER (WHERE a{k}) {part}"
    q = "CASE WHEN qkw_calibrated THEN -q_kw END"
    steps = [f"SELECT *, cer_route <= min(cer_route) {part} + {p.cer_close_delta + 1e-12!r} AS a0 FROM rec WHERE NOT won"]
    steps.append(
        f"SELECT *, a0 AND CASE WHEN {count('*', 0)} = {count(q, 0)} THEN {near(f'({q} - {least(q, 0)})', p.qkw_switch_margin)} WHEN {count('*', 0)} = {count('nll', 0)} THEN {near(f'(nll - {least("nll", 0)})', p.nll_switch_margin)} ELSE true END AS a1"
    )
    metrics = (("extra_ratio", p.quality_regression_tolerance), ("p_overlap", p.noise_switch_margin), ("clip_rate", p.quality_regression_tolerance))
    for k, (m, margin) in enumerate(metrics, 1):
        steps.append(f"SELECT *, a{k} AND CASE WHEN {count('*', k)} = {count(m, k)} THEN {near(f'({m} - {least(m, k)})', margin)} ELSE true END AS a{k + 1}")
    last = len(metrics) + 1
    steps.append(f"SELECT *, a{last} AND (view = 'moss48k' OR count(*) FILTER (WHERE a{last} AND view = 'moss48k') {part} = 0) AS a{last + 1}")
    nested = steps[0]
    for x in steps[1:]:
        nested = f"{x} FROM ({nested})"
    fields = "group_key, role, candidate_id, view, stream, cer_route, qkw_calibrated, q_kw, nll, extra_ratio, p_overlap, clip_rate"
    return f"""WITH RECURSIVE {CAND}, rec AS (SELECT {fields}, 0 AS stage_rank, false AS won FROM cand WHERE validity = 'rankable' AND cer_route IS NOT NULL
      UNION ALL SELECT {fields}, stage_rank + 1, row_number() OVER (PARTITION BY group_key, role ORDER BY CASE WHEN a{last + 1} THEN 0 ELSE 1 END, {_order(True)}) = 1 FROM ({nested}))
      SELECT group_key, role, candidate_id, stage_rank FROM rec WHERE won"""


_GAIN = """CASE WHEN b.qkw_calibrated AND a.qkw_calibrated THEN b.q_kw - a.q_kw END"""
_NOT_WORSE = "coalesce(b.speech_ratio >= a.speech_ratio - 0.1, true) AND coalesce(b.p_overlap <= a.p_overlap + 0.1, true) AND coalesce(b.clip_rate <= a.clip_rate + 0.1, true)"
_GAINS = f"(coalesce(a.p_overlap - b.p_overlap >= 0.05, false) OR coalesce(a.clip_rate - b.clip_rate >= 0.1, false)) AND {_NOT_WORSE}"
_SIDES = "a AS (SELECT * FROM win WHERE role = 's1'), b AS (SELECT * FROM win WHERE role = 's7')"
_WIN_COLUMNS = "group_key, role, n_candidates, min_cer, n_cer_close, n_tied, candidate_id AS winner, view AS winner_view, cer_route AS winner_cer"


def _triggers(low: bool) -> str:
    parts = ["CASE WHEN a.cer_route > 1e-9 THEN 's1_cer_nonzero' END"] + ["CASE WHEN a.qkw_calibrated AND a.q_kw < 0.5 THEN 's1_qkw_below_threshold' END"] * low
    parts += ["CASE WHEN a.content_class IN ('uncertain_or_hallucination', 'competing_speech') THEN 's1_semantic_suspect' END", "CASE WHEN a.clip_rate > 0.01 THEN 's1_clipping_risk' END", "CASE WHEN a.speech_ratio < 0.05 THEN 's1_speech_almost_empty' END"]
    return f"CASE WHEN a.candidate_id IS NULL THEN 's1_no_rankable_candidate' ELSE concat_ws('+', {', '.join(parts)}) END"


_FALLBACK = "SELECT group_key, arg_min(candidate_id, (cer_route, candidate_id)) AS fallback, arg_min(view, (cer_route, candidate_id)) AS fb_view, min(cer_route) AS fb_cer FROM cand WHERE role = 's1' AND view = 'raw' AND decode_ok AND cer_route IS NOT NULL GROUP BY group_key"
_AVAILABLE = "SELECT group_key, coalesce(bool_or(s7_available), bool_or(role = 's7')) AS available FROM cand GROUP BY group_key"
_DECIDED = (
    _chain(CLOSE)
    + f""", {_SIDES}, fb AS ({_FALLBACK}), av AS ({_AVAILABLE}),
joined AS (
  SELECT av.group_key, available, fallback, fb_view, fb_cer, a.candidate_id AS i1, b.candidate_id AS i7, a.view AS v1, b.view AS v7, a.cer_route AS c1, b.cer_route AS c7, a.n_candidates AS n1, b.n_candidates AS n7,
    a.pcm_sha256 <> '' AND a.pcm_sha256 = b.pcm_sha256 AS same_audio, {_GAIN} AS q, a.nll - b.nll AS n, {_GAINS} AS gains, {_triggers(False)} AS reasons
  FROM av LEFT JOIN fb USING (group_key) LEFT JOIN a USING (group_key) LEFT JOIN b USING (group_key)),
coded AS (
  SELECT *, CASE WHEN i1 IS NULL AND i7 IS NOT NULL THEN 'SWITCH_S7_S1_UNAVAILABLE' WHEN i1 IS NULL AND fallback IS NOT NULL THEN 'AUDIT_FALLBACK_S1_RAW' WHEN i1 IS NULL THEN 'FAIL_NO_DECODABLE_S1'
    WHEN reasons = '' THEN 'KEEP_S1_CER0_TRUSTED' WHEN NOT available THEN 'KEEP_S1_S7_UNAVAILABLE' WHEN i7 IS NULL THEN 'KEEP_S1_S7_NO_RANKABLE' WHEN same_audio THEN 'SAME_AUDIO_KEEP_S1'
    WHEN c7 < c1 - 1e-12 THEN 'SWITCH_S7_LOWER_CER' WHEN c7 > c1 + 1e-12 THEN 'KEEP_S1_LOWER_CER' WHEN q >= 0.01 THEN 'SWITCH_S7_EQUAL_CER_QKW_GAIN'
    WHEN q IS NULL AND n >= 0.01 THEN 'SWITCH_S7_EQUAL_CER_NLL_GAIN' WHEN gains THEN 'SWITCH_S7_CLOSE_CER_QUALITY_GAIN' ELSE 'KEEP_S1_TIE_NO_GAIN' END AS reason_code FROM joined),
decided AS (
  SELECT group_key, reason_code, CASE WHEN reason_code LIKE 'SWITCH%' THEN i7 WHEN reason_code LIKE 'AUDIT%' THEN fallback ELSE i1 END AS selected_id,
    CASE WHEN reason_code LIKE 'SWITCH%' THEN v7 WHEN reason_code LIKE 'AUDIT%' THEN fb_view ELSE v1 END AS selected_view, CASE WHEN reason_code LIKE 'SWITCH%' THEN c7 WHEN reason_code LIKE 'AUDIT%' THEN fb_cer ELSE c1 END AS selected_cer,
    reason_code LIKE 'SWITCH%' AS switched, available AS s7_available, CASE WHEN reason_code LIKE 'FAIL%' THEN 'fail' WHEN reason_code LIKE 'AUDIT%' THEN 'audit_fallback' ELSE 'normal' END AS selection_mode,
    reasons AS trigger_reasons, i1 AS s1_winner, i7 AS s7_winner, coalesce(n1, 0) AS n1, coalesce(n7, 0) AS n7 FROM coded)
"""
)
ORACLES = {
    "finite_filter": "SELECT row_id, cer_route FROM scored_candidates WHERE isfinite(cer_route)",
    "rankable_filter": f"WITH {CAND} SELECT candidate_id, role, cer_route FROM cand WHERE validity = 'rankable' AND cer_route IS NOT NULL",
    "margin_pool": f"""WITH {CAND}, r AS (SELECT * FROM cand WHERE validity = 'rankable' AND cer_route IS NOT NULL),
      x AS (SELECT * FROM r QUALIFY CASE WHEN count(*) OVER w = count(nll) OVER w THEN nll - min(nll) OVER w < 0.05 - 1e-15 ELSE true END)
      SELECT group_key, role, candidate_id FROM x QUALIFY CASE WHEN count(*) OVER w = count(p_overlap) OVER w THEN p_overlap - min(p_overlap) OVER w < 0.05 - 1e-15 ELSE true END""".replace("OVER w", "OVER (PARTITION BY group_key, role)"),
    "stage_winner": f"{_chain(EXACT)} SELECT {_WIN_COLUMNS} FROM win",
    "stage_winner_close_cer": f"{_chain(CLOSE)} SELECT {_WIN_COLUMNS} FROM win",
    "view_reason": _chain(CLOSE)
    + f""", raw AS (SELECT * FROM r WHERE view = 'raw' QUALIFY row_number() OVER (PARTITION BY group_key, role ORDER BY cer_route, {_order(False)}) = 1),
      enh AS (SELECT * FROM r WHERE view = 'moss48k' QUALIFY row_number() OVER (PARTITION BY group_key, role ORDER BY cer_route, {_order(False)}) = 1)
      SELECT b.group_key, b.role, b.candidate_id AS winner, CASE WHEN b.view = 'moss48k' THEN CASE WHEN a.candidate_id IS NULL THEN 'MOSS_ONLY' WHEN b.cer_route < a.cer_route - 1e-12 THEN 'MOSS_LOWER_CER'
        WHEN abs(b.cer_route - a.cer_route) <= 0.02 + 1e-12 AND {_GAINS} THEN 'MOSS_CLOSE_CER_QUALITY' WHEN {_GAIN} >= 0.01 THEN 'MOSS_EQUAL_CER_QKW_GAIN' WHEN a.nll - b.nll >= 0.01 THEN 'MOSS_EQUAL_CER_NLL_GAIN' ELSE 'MOSS_EQUAL_CER_OTHER' END
        WHEN e.candidate_id IS NULL THEN 'RAW_ONLY' WHEN b.cer_route < e.cer_route - 1e-12 THEN 'RAW_LOWER_CER' ELSE 'RAW_CONSERVATIVE_TIE' END AS view_reason
      FROM win b LEFT JOIN raw a USING (group_key, role) LEFT JOIN enh e USING (group_key, role)""",
    "conservative_tiebreak": f"WITH {CAND} SELECT group_key, role, candidate_id AS first_id FROM cand WHERE validity = 'rankable' AND cer_route IS NOT NULL QUALIFY row_number() OVER (PARTITION BY group_key, role ORDER BY {_order(False)}) = 1",
    "cer_rank": f"WITH {CAND} SELECT candidate_id, row_number() OVER (PARTITION BY group_key, role ORDER BY cer_route, candidate_id) AS cer_rank FROM cand WHERE validity = 'rankable' AND cer_route IS NOT NULL",
    "stage_rank": _ranks(CLOSE),
    "availability": f"WITH {CAND} {_AVAILABLE}",
    "tie_gains": f"{_chain(CLOSE)}, {_SIDES} SELECT group_key, {_GAIN} AS q_kw_gain, NULL::DOUBLE AS keyword_gain, a.nll - b.nll AS nll_gain, NULL::DOUBLE AS speaker_gain FROM a FULL JOIN b USING (group_key)",
    "quality_gain": f"{_chain(CLOSE)}, {_SIDES} SELECT group_key, {_NOT_WORSE} AS not_worse, {_GAINS} AS gains FROM a JOIN b USING (group_key)",
    "trigger_reasons": f"{_chain(CLOSE)}, {_SIDES} SELECT group_key, {_triggers(True)} AS reasons FROM a FULL JOIN b USING (group_key)",
    "audit_fallback": f"WITH {CAND} SELECT group_key, fallback FROM ({_FALLBACK})",
    "route_decision": _DECIDED
    + """SELECT group_key, reason_code, selected_id, selected_view, selected_cer, switched, s7_available, selection_mode, CASE WHEN selected_cer <= 1e-12 THEN 'zero' WHEN selected_cer IS NOT NULL THEN 'min_nonzero' END AS low_cer_status, trigger_reasons, s1_winner, s7_winner,
      'primary: ' || coalesce(s1_winner, 'none') || ' of ' || n1 || '; alternative: ' || coalesce(s7_winner, 'none') || ' of ' || n7 || '; triggers: ' || CASE WHEN trigger_reasons = '' THEN 'none' ELSE trigger_reasons END || '; rule: ' || reason_code || '; selected: ' || coalesce(selected_id, 'none') AS trace FROM decided""",
    "reason_counts": _DECIDED + "SELECT reason_code, count(*) AS n FROM decided GROUP BY reason_code",
}
