"""One winner per group by a chain of margin-tolerant metrics.

Each link keeps the members of the pool that lie within a margin of the best, and only applies if every member has its
metric. A link needs a few aggregates of the pool per group; ordinary groups get them from window functions over one
partitioning, groups that hold a large part of the rows from distributed aggregations.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxsieve.functions.scalars import finite
from voxsieve.operators.ranks import TIE, clustered_ranks
from voxsieve.operators.ordered import numbered
from voxsieve.operators.skew import heavy_keys
from voxsieve.policy import STREAM_SLOTS, Policy
from voxsieve.session import settled

METRICS = ["cer_route", "q_kw", "keyword_score", "nll", "speaker_ref_score", "gain_ref", "extra_ratio", "p_music", "p_overlap", "clip_rate", "speech_ratio", "snr_vad_db", "dnsmos_ovrl"]


def candidates(scored: DataFrame) -> DataFrame:
    """The candidates in force, flat: per ``candidate_id`` the undeleted row with the smallest ``row_id``.

    The rank filter becomes a group limit, so each task passes on one copy of a candidate to the shuffle, with the columns that are asked for.
    A missing ``group_key`` is made up from split and uid. Struct fields of ``audio_quality`` become columns, metrics that the table lacks are
    null, non-finite ones too. Rows without a candidate id are left out.
    """
    quality = scored.schema["audio_quality"].dataType.names if "audio_quality" in scored.columns else []
    live = scored.where("deleted_at is null and candidate_id is not null")
    nth = F.row_number().over(Window.partitionBy("candidate_id").orderBy("row_id"))
    kept = [c for c in scored.columns if c != "audio_quality"]
    one = live.withColumn("_nth", nth).where("_nth = 1").select(*kept, *[F.col(f"audio_quality.{q}").alias(q) for q in quality])
    there = set(one.columns)
    metrics = {m: finite(F.col(m)) if m in there else F.lit(None).cast("double") for m in METRICS}
    return one.withColumns(metrics | {"group_key": F.coalesce("group_key", F.concat("split", F.lit("\0"), "uid"))})


def rankable(c: DataFrame) -> DataFrame:
    """Candidates whose validity is 'rankable' and whose error rate is finite."""
    return c.where((F.col("validity") == "rankable") & finite(F.col("cer_route")).isNotNull())


def stream_order(stream: Column, unknown: int = 1000) -> Column:
    """Named streams by their slot, ``spkN`` beyond them by N + 1, others last."""
    named = F.coalesce(*[F.when(stream == k, v) for k, v in STREAM_SLOTS.items()])
    number = F.regexp_extract(stream, r"^spk\s*([+-]?\d{1,8})\s*$", 1)
    return F.coalesce(named, F.when(number != "", number.try_cast("int") + 1), F.lit(unknown))


def conservative_key(prefer_enhanced: bool = False, prefix: str = "") -> Column:
    """The last tie-break: preferred view, stream order, stream, original first, id. Smallest wins."""
    c = lambda n: F.col(prefix + n)
    view = F.when(c("view") == ("moss48k" if prefer_enhanced else "raw"), 0).otherwise(1)
    stream = F.coalesce(c("stream"), F.lit(""))
    return F.struct(view.alias("a"), stream_order(stream).alias("b"), stream.alias("c"), F.when(stream == "original", 0).otherwise(1).alias("d"), F.coalesce(c("candidate_id"), F.lit("")).alias("e"))


def within(best: Column, value: Column, margin: float) -> Column:
    """Whether ``value`` (smaller is better) is nearer to ``best`` than ``margin``; a gap equal to the margin isn't."""
    gap = value - best
    return (gap < margin - 1e-15) | (F.abs(gap) <= TIE)


@dataclass(frozen=True)
class Link:
    """``aggregates`` of the pool per group (over columns, null outside the pool) and the rows they keep."""

    aggregates: dict[str, Column]
    keep: Column


def _pool(value: Column) -> Column:
    return F.when(F.col("alive"), value)


def metric_link(name: str, margin: float, higher: bool) -> Link:
    """Keep what is within ``margin`` of the best ``name``, if all of the pool has it."""
    v = -F.col(name) if higher else F.col(name)
    have = {"_n": F.count(_pool(F.lit(1))), "_m": F.count(_pool(v)), "_best": F.min(_pool(v))}
    return Link(have, F.when(F.col("_n") == F.col("_m"), within(F.col("_best"), v, margin)).otherwise(F.lit(True)))


def evidence_metrics(p: Policy) -> list[tuple[Column, float]]:
    """(value, smaller is better; margin) of the metrics of which the first counts that all of the pool have."""
    sure = F.when(F.coalesce(F.col("qkw_calibrated"), F.lit(False)), F.col("q_kw"))
    return [(-sure, p.qkw_switch_margin), (-F.col("keyword_score"), p.qkw_switch_margin), (F.col("nll"), p.nll_switch_margin)]


def quality_metrics(p: Policy) -> list[tuple[str, float, bool]]:
    """(name, margin, higher is better) of the metrics after the evidence, in order."""
    return [
        ("speaker_ref_score", p.speaker_switch_margin, True),
        ("extra_ratio", p.quality_regression_tolerance, False),
        ("p_music", p.noise_switch_margin, False),
        ("p_overlap", p.noise_switch_margin, False),
        ("clip_rate", p.quality_regression_tolerance, False),
        ("snr_vad_db", p.snr_switch_margin_db, True),
        ("dnsmos_ovrl", p.dnsmos_switch_margin, True),
    ]


def evidence_link(p: Policy) -> Link:
    """One of three metrics: calibrated q_kw if all have it, else the keyword score, else the negative log-likelihood."""
    have = {"_n": F.count(_pool(F.lit(1)))}
    keep = F.lit(True)
    for tag, (v, margin) in zip("nkq", reversed(evidence_metrics(p))):
        have |= {f"_m{tag}": F.count(_pool(v)), f"_b{tag}": F.min(_pool(v))}
        keep = F.when(F.col("_n") == F.col(f"_m{tag}"), within(F.col(f"_b{tag}"), v, margin)).otherwise(keep)
    return Link(have, keep)


def links(p: Policy) -> list[Link]:
    """The chain of a policy, in order."""
    delta = max(0.0, p.cer_close_delta or 0.0)
    first = Link({"min_cer": F.min(_pool(F.col("cer_route")))}, F.col("cer_route") <= F.col("min_cer") + F.lit(delta + TIE))
    chain = [first, evidence_link(p)]
    chain += [metric_link(*m) for m in quality_metrics(p)]
    if p.prefer_se_on_close_cer and delta > 0:
        enhanced = F.col("view") == "moss48k"
        chain.append(Link({"_e": F.count(_pool(F.when(enhanced, 1)))}, (F.col("_e") == 0) | enhanced))
    return chain


def eliminate(pool: DataFrame, keys: list[str], chain: list[Link], hot: list | None = None, hot_key: str | None = None) -> DataFrame:
    """``pool`` with ``alive``: which rows are left after all links, in each group of ``keys``.

    Groups whose ``hot_key`` value is in ``hot`` are aggregated in a distributed way, link by link: only one row of
    aggregates per such group (there are at most 256 values) passes through the driver, whatever the group's size.
    """
    d = pool.withColumn("alive", F.lit(True))
    scratch = sorted({a for link in chain for a in link.aggregates if a.startswith("_")})
    usual = d.where(~F.col(hot_key).isin(hot) | F.col(hot_key).isNull()) if hot else d
    w = Window.partitionBy(*keys)
    usual = usual.repartition(hot_key) if hot_key in keys else usual
    for link in chain:
        usual = usual.withColumns({n: a.over(w) for n, a in link.aggregates.items()}).withColumn("alive", F.col("alive") & link.keep)
    usual = usual.drop(*scratch)
    if not hot:
        return usual
    big = settled(d.where(F.col(hot_key).isin(hot)), "hot-groups")
    spark = pool.sparkSession
    for link in chain:
        stats = big.groupBy(*keys).agg(*[a.alias(n) for n, a in link.aggregates.items()])
        known = spark.createDataFrame(stats.collect(), stats.schema)
        big = big.drop(*[c for c in link.aggregates if c in big.columns]).join(F.broadcast(known), keys).withColumn("alive", F.col("alive") & link.keep)
        big = settled(big.drop(*scratch), "hot-groups")
    return usual.unionByName(big)


def stage_winners(c: DataFrame, p: Policy, keys: tuple[str, ...] = ("group_key", "role"), hot: list | None = None) -> DataFrame:
    """One row per group of rankable candidates: counts, ``winner``, ``best_raw`` and ``best_enhanced`` as structs.

    ``n_candidates``, ``min_cer``, ``n_cer_close`` (in the error window) and ``n_tied`` (left after all links) describe the choice. Groups without
    a rankable candidate have no row.
    """
    r = rankable(c)
    hot = heavy_keys(r, F.col(keys[0])) if hot is None else hot
    delta = max(0.0, p.cer_close_delta or 0.0)
    prefer = bool(p.prefer_se_on_close_cer and delta > 0)
    left = eliminate(r, list(keys), links(p), hot, keys[0])
    fields = F.struct(*[x for x in ("candidate_id", "view", "stream", "pcm_sha256", "content_class", "qkw_calibrated", *METRICS)])
    by_error = F.struct(F.col("cer_route"), conservative_key())
    best = lambda view: F.min_by(F.when(F.col("view") == view, fields), F.when(F.col("view") == view, by_error))
    return left.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_candidates"),
        F.min("cer_route").alias("min_cer"),
        F.count_if(F.col("cer_route") <= F.col("min_cer") + F.lit(delta + TIE)).alias("n_cer_close"),
        F.count_if("alive").alias("n_tied"),
        F.min_by(F.when(F.col("alive"), fields), F.when(F.col("alive"), conservative_key(prefer))).alias("winner"),
        best("raw").alias("best_raw"),
        best("moss48k").alias("best_enhanced"),
    )


def gain(kind: str, new: str, old: str) -> Column:
    """How much better struct ``new`` is than ``old`` in q_kw (both calibrated), keyword, nll or speaker; null if it can't be told."""
    n, o = (lambda f: F.col(f"{new}.{f}")), (lambda f: F.col(f"{old}.{f}"))
    if kind == "q_kw":
        return F.when(n("qkw_calibrated") & o("qkw_calibrated"), n("q_kw") - o("q_kw"))
    if kind == "nll":
        return o("nll") - n("nll")
    if kind == "speaker":
        return F.coalesce(n("speaker_ref_score") - o("speaker_ref_score"), n("gain_ref") - o("gain_ref"))
    return n("keyword_score") - o("keyword_score")


def not_worse(new: str, old: str, tolerance: float) -> Column:
    """No quality metric that both have got worse by more than ``tolerance``."""
    rules = [F.coalesce(F.col(f"{new}.{m}") >= F.col(f"{old}.{m}") - tolerance, F.lit(True)) for m in ("speech_ratio", "snr_vad_db", "dnsmos_ovrl")]
    rules += [F.coalesce(F.col(f"{new}.{m}") <= F.col(f"{old}.{m}") + tolerance, F.lit(True)) for m in ("p_music", "p_overlap", "clip_rate")]
    return reduce(lambda a, b: a & b, rules)


def quality_gain(new: str, old: str, p: Policy) -> Column:
    """Some quality metric better by its margin and none worse."""
    lower = (("p_music", p.noise_switch_margin), ("p_overlap", p.noise_switch_margin), ("clip_rate", p.quality_regression_tolerance))
    higher = (("snr_vad_db", p.snr_switch_margin_db), ("dnsmos_ovrl", p.dnsmos_switch_margin))
    better = [F.coalesce(F.col(f"{old}.{m}") - F.col(f"{new}.{m}") >= x, F.lit(False)) for m, x in lower]
    better += [F.coalesce(F.col(f"{new}.{m}") - F.col(f"{old}.{m}") >= x, F.lit(False)) for m, x in higher]
    return reduce(lambda a, b: a | b, better) & not_worse(new, old, p.quality_regression_tolerance)


def view_reason(p: Policy) -> Column:
    """Why the winner's view won, from the structs of :func:`stage_winners`."""
    w, r, m = F.col("winner.cer_route"), F.col("best_raw.cer_route"), F.col("best_enhanced.cer_route")
    enhanced = (
        F.when(F.col("best_raw.candidate_id").isNull(), "MOSS_ONLY")
        .when(w < r - TIE, "MOSS_LOWER_CER")
        .when((F.abs(w - r) <= p.cer_close_delta + TIE) & quality_gain("winner", "best_raw", p), "MOSS_CLOSE_CER_QUALITY")
        .when(gain("q_kw", "winner", "best_raw") >= p.qkw_switch_margin, "MOSS_EQUAL_CER_QKW_GAIN")
        .when(gain("keyword", "winner", "best_raw") >= p.qkw_switch_margin, "MOSS_EQUAL_CER_CTC_GAIN")
        .when(gain("nll", "winner", "best_raw") >= p.nll_switch_margin, "MOSS_EQUAL_CER_NLL_GAIN")
        .otherwise("MOSS_EQUAL_CER_OTHER")
    )
    raw = F.when(F.col("best_enhanced.candidate_id").isNull(), "RAW_ONLY").when(w < m - TIE, "RAW_LOWER_CER").otherwise("RAW_CONSERVATIVE_TIE")
    return F.when(F.col("winner.view") == "moss48k", enhanced).otherwise(raw)


def error_ranks(c: DataFrame) -> DataFrame:
    """``cer_rank``: 1, 2, ... of rankable candidates by (error rate, id) within group and role; groups of any size."""
    return numbered(rankable(c), ["group_key", "role"], "cer_route", ["candidate_id"], "cer_rank")


def stage_ranks(c: DataFrame, p: Policy, most: int | None = None, hot: list | None = None) -> DataFrame:
    """``stage_rank``: the winner is 1, the winner of the rest 2, and so on, until every rankable candidate has its rank.

    Margins aren't transitive, so this is no sort but repeated elimination, in one clustered pass over the groups (see ``ranks.py``). ``most`` leaves out later ranks.
    """
    r = rankable(c)
    hot = heavy_keys(r, F.col("group_key")) if hot is None else hot
    delta = max(0.0, p.cer_close_delta or 0.0)
    prefer = bool(p.prefer_se_on_close_cer and delta > 0)
    evidence, quality = evidence_metrics(p), quality_metrics(p)
    values = [v.alias(f"_e{i}") for i, (v, _) in enumerate(evidence)] + [(-F.col(m) if higher else F.col(m)).alias(f"_m{i}") for i, (m, _, higher) in enumerate(quality)]
    enhanced = F.coalesce(F.col("view") == "moss48k", F.lit(False))
    d = r.select("group_key", "role", "candidate_id", "cer_route", *values, enhanced.alias("_enhanced"), conservative_key(prefer).alias("_last"))
    ranks = clustered_ranks(d, ["group_key", "role"], [m for _, m in evidence], [m for _, m, _ in quality], delta, prefer, hot)
    return ranks if most is None else ranks.where(F.col("stage_rank") <= most)


def trigger_reasons(w: str, p: Policy) -> Column:
    """Why the primary winner in struct ``w`` calls for the alternative, in order; one reason if there is no winner."""
    c = lambda f: F.col(f"{w}.{f}")
    low = c("qkw_calibrated") & (c("q_kw") < p.qkw_low_thr) if p.qkw_low_thr is not None else F.lit(False)
    reasons = [
        F.when(c("cer_route") > 1e-9, "s1_cer_nonzero"),
        F.when(low, "s1_qkw_below_threshold"),
        F.when(c("content_class").isin("uncertain_or_hallucination", "competing_speech"), "s1_semantic_suspect"),
        F.when(c("clip_rate") > p.clip_rate_thr, "s1_clipping_risk"),
        F.when(c("speech_ratio") < p.min_speech_ratio, "s1_speech_almost_empty"),
    ]
    return F.when(c("candidate_id").isNull(), F.array(F.lit("s1_no_rankable_candidate"))).otherwise(F.array_compact(F.array(*reasons)))


def decisions(c: DataFrame, p: Policy, hot: list | None = None) -> DataFrame:
    """One row per group: the selected candidate, why, and a trace of five steps in words.

    The winners of both roles stand side by side; the first rule that fits decides. Groups without any winner fall back on the primary raw
    candidate with the least error that could be decoded, whatever its validity, else fail. Availability of the alternative: any true flag, or if
    no flag is set any row of that role.
    """
    fallback = (F.col("role") == "s1") & (F.col("view") == "raw") & F.coalesce(F.col("decode_ok"), F.col("source_wav").isNotNull()) & F.col("cer_route").isNotNull()
    groups = c.groupBy("group_key").agg(
        F.coalesce(F.bool_or("s7_available"), F.bool_or(F.col("role") == "s7"), F.lit(False)).alias("s7_available"),
        F.min_by(F.when(fallback, F.struct("candidate_id", "view", "stream", "cer_route")), F.when(fallback, F.struct("cer_route", "candidate_id"))).alias("fb"),
    )
    winners = stage_winners(c, p, hot=hot).withColumn("view_reason", view_reason(p))
    sides = winners.groupBy("group_key").agg(*[F.max(F.when(F.col("role") == r, F.struct(*[x for x in ("n_candidates", "winner", "view_reason")]))).alias(n) for r, n in (("s1", "a"), ("s7", "b"))])
    d = groups.join(sides, "group_key", "left").withColumns({"w1": F.col("a.winner"), "w7": F.col("b.winner")})
    no1, no7 = F.col("w1.candidate_id").isNull(), F.col("w7.candidate_id").isNull()
    d = d.withColumn("triggers", trigger_reasons("w1", p))
    c1, c7 = F.col("w1.cer_route"), F.col("w7.cer_route")
    q, k, n, s = (gain(x, "w7", "w1") for x in ("q_kw", "keyword", "nll", "speaker"))
    same = (F.col("w1.pcm_sha256") == F.col("w7.pcm_sha256")) & (F.col("w1.pcm_sha256") != "")
    close = quality_gain("w7", "w1", p) if p.cer_close_delta > 0 else F.lit(False)
    rules = [
        (no1 & ~no7, "SWITCH_S7_S1_UNAVAILABLE"),
        (no1 & F.col("fb.candidate_id").isNotNull(), "AUDIT_FALLBACK_S1_RAW"),
        (no1, "FAIL_NO_DECODABLE_S1"),
        (F.size("triggers") == 0, "KEEP_S1_CER0_TRUSTED"),
        (~F.col("s7_available"), "KEEP_S1_S7_UNAVAILABLE"),
        (no7, "KEEP_S1_S7_NO_RANKABLE"),
        (same, "SAME_AUDIO_KEEP_S1"),
        (c7 < c1 - TIE, "SWITCH_S7_LOWER_CER"),
        (c7 > c1 + TIE, "KEEP_S1_LOWER_CER"),
        (q >= p.qkw_switch_margin, "SWITCH_S7_EQUAL_CER_QKW_GAIN"),
        (q.isNull() & (k >= p.qkw_switch_margin), "SWITCH_S7_EQUAL_CER_CTC_GAIN"),
        (q.isNull() & (n >= p.nll_switch_margin), "SWITCH_S7_EQUAL_CER_NLL_GAIN"),
        ((s >= p.speaker_switch_margin) & not_worse("w7", "w1", p.quality_regression_tolerance), "SWITCH_S7_EQUAL_CER_SPK_GAIN"),
        (close, "SWITCH_S7_CLOSE_CER_QUALITY_GAIN"),
    ]
    reason = F.coalesce(*[F.when(cond, code) for cond, code in rules], F.lit("KEEP_S1_TIE_NO_GAIN"))
    d = d.withColumn("reason_code", reason).withColumn("switched", F.col("reason_code").startswith("SWITCH"))
    pick = lambda f: F.when(F.col("switched"), F.col(f"w7.{f}")).when(F.col("reason_code") == "AUDIT_FALLBACK_S1_RAW", F.col(f"fb.{f}")).otherwise(F.col(f"w1.{f}"))
    d = d.withColumns({"selected_id": pick("candidate_id"), "selected_view": pick("view"), "selected_cer": pick("cer_route")})
    mode = F.when(F.col("reason_code") == "FAIL_NO_DECODABLE_S1", "fail").when(F.col("reason_code") == "AUDIT_FALLBACK_S1_RAW", "audit_fallback").otherwise("normal")
    level = F.when(F.col("selected_cer").isNull(), None).when(F.lit(p.cer_accept_thr is not None) & (F.col("selected_cer") > F.lit(p.cer_accept_thr if p.cer_accept_thr is not None else 0.0)), "above_acceptance_threshold").when(F.col("selected_cer") <= TIE, "zero").otherwise("min_nonzero")
    steps = [
        F.concat(F.lit("primary: "), F.coalesce("w1.candidate_id", F.lit("none")), F.lit(" of "), F.coalesce("a.n_candidates", F.lit(0)).cast("string")),
        F.concat(F.lit("alternative: "), F.coalesce("w7.candidate_id", F.lit("none")), F.lit(" of "), F.coalesce("b.n_candidates", F.lit(0)).cast("string")),
        F.concat(F.lit("triggers: "), F.when(F.size("triggers") > 0, F.array_join("triggers", "+")).otherwise("none")),
        F.concat(F.lit("rule: "), F.col("reason_code")),
        F.concat(F.lit("selected: "), F.coalesce("selected_id", F.lit("none"))),
    ]
    return d.select(
        "group_key", "reason_code", "selected_id", "selected_view", "selected_cer", "switched", "s7_available",
        mode.alias("selection_mode"), level.alias("low_cer_status"), F.array_join("triggers", "+").alias("trigger_reasons"),
        F.col("w1.candidate_id").alias("s1_winner"), F.col("w7.candidate_id").alias("s7_winner"), F.col("a.view_reason").alias("s1_view_reason"), F.col("b.view_reason").alias("s7_view_reason"),
        F.array_join(F.array(*steps), "; ").alias("trace"),
    )
