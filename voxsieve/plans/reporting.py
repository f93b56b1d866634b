"""Reports, listings, crops, calibration and frame features, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxsieve.functions import calibration as cal
from voxsieve.functions import scalars as sc
from voxsieve.functions import signal
from voxsieve.operators import crops
from voxsieve.operators import reporting as rep
from voxsieve.operators import selection as sel
from voxsieve.operators.compaction import absolute_path
from voxsieve.operators.ordered import exact_quantile, numbered
from voxsieve.plans.selection import _DECIDED, CAND, _chain, hot_groups
from voxsieve.operators.skew import salted_left_join
from voxsieve.policy import CLOSE
from voxsieve.session import settled
from voxsieve.sources.tables import table


def _c(spark: SparkSession, root: str) -> DataFrame:
    return sel.candidates(table(spark, root, "scored_candidates"))


def _selected(spark: SparkSession, root: str) -> DataFrame:
    c = _c(spark, root)
    ids = sel.decisions(c, CLOSE, hot_groups(spark, root)).where("selected_id is not null").select(F.col("selected_id").alias("candidate_id"), "reason_code")
    return c.join(ids, "candidate_id")


def asr_manifest(spark: SparkSession, root: str) -> DataFrame:
    c = _c(spark, root).where("score_key is not null and source_wav is not null")
    return c.groupBy("score_key").agg(F.min_by(F.struct("candidate_id", "source_wav", "wake_text", "lang"), "row_id").alias("r")).select("score_key", "r.*")


def cache_hit_miss(spark: SparkSession, root: str) -> DataFrame:
    wanted = _c(spark, root).where("pcm_sha256 is not null").select(F.lower("pcm_sha256").alias("digest"), absolute_path(F.col("source_wav")).alias("path")).distinct()
    cached = table(spark, root, "sep_audio_cache_manifest").select(F.lower("pcm_sha256").alias("digest"), absolute_path(F.col("source_wav")).alias("path"), F.lit(True).alias("cached")).distinct()
    state = F.when(F.col("cached"), "hit").otherwise("miss")
    return wanted.join(cached, ["digest", "path"], "left").groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


def loss_reason(spark: SparkSession, root: str) -> DataFrame:
    return rep.loss_reasons(_c(spark, root), _selected(spark, root), hot_groups(spark, root))


def group_order(spark: SparkSession, root: str) -> DataFrame:
    return rep.group_orders(_c(spark, root))


#: What the decisions and the listing read of a candidate.
_LISTED = [*sel.METRICS, "role", "view", "stream", "uid", "split", "pcm_sha256", "content_class", "qkw_calibrated", "validity", "s7_available", "decode_ok", "source_wav"]


def _index(spark: SparkSession, root: str) -> DataFrame:
    hot = hot_groups(spark, root)
    c = settled(_c(spark, root).select("candidate_id", "group_key", *[x for x in _LISTED if x not in ("candidate_id", "group_key")]), "candidates")
    chosen = sel.decisions(c, CLOSE, hot).select("group_key", "selected_id")
    per_group = chosen.join(rep.group_orders(c), "group_key")
    is_it = F.coalesce(F.col("candidate_id") == F.col("selected_id"), F.lit(False))
    marker = F.when(is_it, "SELECTED").when(F.col("decode_ok"), "REJECTED").otherwise("FAILED")
    d = salted_left_join(c, per_group, "group_key", "candidate_id", hot).withColumn("marker", marker)
    return d.withColumn("slot", F.when(F.col("marker") == "FAILED", rep.failed_slots()).otherwise(rep.slots(is_it)))


def export_slots(spark: SparkSession, root: str) -> DataFrame:
    return _index(spark, root).select("candidate_id", "marker", "slot")


def export_names(spark: SparkSession, root: str) -> DataFrame:
    return _index(spark, root).select("candidate_id", rep.file_names(F.col("group_order"), F.col("slot"), F.col("marker")).alias("name"))


def export_validate(spark: SparkSession, root: str) -> DataFrame:
    return rep.listing_faults(_index(spark, root))


def export_summary(spark: SparkSession, root: str) -> DataFrame:
    s = _selected(spark, root)
    parts = [("view", F.concat_ws(":", "role", "view")), ("stream", F.col("stream")), ("split", F.col("split")), ("reason", F.col("reason_code"))]
    each = s.select("cer_route", F.explode(F.array(*[F.struct(F.lit(k).alias("dimension"), v.alias("value")) for k, v in parts])).alias("d"))
    return each.groupBy("d.dimension", "d.value").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("cer_route"), 6).alias("mean_cer"))


def missing_uid_groups(spark: SparkSession, root: str) -> DataFrame:
    expected = table(spark, root, "arm_index").select("split", "uid").distinct()
    return expected.join(_c(spark, root).where("cer_route is not null").select("split", "uid").distinct(), ["split", "uid"], "left_anti")


def uid_fingerprint(spark: SparkSession, root: str) -> DataFrame:
    return rep.set_fingerprint(_c(spark, root), ["split", "uid"])


def score_meta(spark: SparkSession, root: str) -> DataFrame:
    return _c(spark, root).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("pcm_sha256").alias("n_audio"), F.count_distinct("score_key").alias("n_keys"), F.count_if(F.col("view") == "raw").alias("n_raw"), F.count_if(F.col("view") == "moss48k").alias("n_enhanced"), F.round(F.avg((F.col("qkw_calibrated") & F.col("q_kw").isNotNull()).cast("int")), 6).alias("probability_coverage"))


def inventory_meta(spark: SparkSession, root: str) -> DataFrame:
    g = _c(spark, root).groupBy("split", "uid").agg(F.bool_or("s7_available").alias("a"), F.count(F.lit(1)).alias("n"), F.count_if(~F.coalesce(F.col("decode_ok"), F.lit(False))).alias("u"))
    return g.groupBy("split").agg(F.count(F.lit(1)).alias("n_uid"), F.sum("n").alias("n_refs"), F.count_if(~F.coalesce(F.col("a"), F.lit(False))).alias("n_unavailable"), F.sum("u").alias("n_undecodable"))


def _pairs(spark: SparkSession, root: str) -> DataFrame:
    c = _c(spark, root)
    new = sel.decisions(c, CLOSE, hot_groups(spark, root)).select("group_key", F.col("selected_cer").alias("cer"))
    base = sel.stage_winners(c.where("role = 's1' and view = 'raw'"), CLOSE, hot=hot_groups(spark, root)).select("group_key", F.col("winner.cer_route").alias("cer"))
    return rep.paired(new, base)


def paired_delta(spark: SparkSession, root: str) -> DataFrame:
    return _pairs(spark, root)


def local_gate(spark: SparkSession, root: str) -> DataFrame:
    s = rep.paired_summary(_pairs(spark, root))
    return s.select("n_paired", "n_better", "n_worse", "n_same", *[F.round(x, 6).alias(x) for x in ("mean_cer", "base_mean_cer", "zero_share", "base_zero_share")])


def lang_not_worse(spark: SparkSession, root: str) -> DataFrame:
    lang = _c(spark, root).groupBy("group_key").agg(F.min("lang").alias("lang"))
    d = _pairs(spark, root).join(lang, "group_key").groupBy("lang").agg(F.avg("cer").alias("a"), F.avg("base_cer").alias("b"))
    return d.select("lang", F.round("a", 6).alias("mean_cer"), F.round("b", 6).alias("base_mean_cer"), (F.col("a") <= F.col("b") + 1e-12).alias("not_worse"))


def pair_improved(spark: SparkSession, root: str) -> DataFrame:
    g = _c(spark, root).groupBy("group_key").agg(F.min("lang").alias("lang"), F.min("split").alias("split"))
    rate = lambda c, split, miss: F.avg(F.when(F.col("split") == split, ((F.col(c) > 1e-12) if miss else (F.col(c) <= 1e-12)).cast("int")))
    d = _pairs(spark, root).join(g, "group_key").groupBy("lang").agg(*[rate(c, s, m).alias(n) for c, s, m, n in (("cer", "pos", True, "frr"), ("cer", "neg", False, "far"), ("base_cer", "pos", True, "b_frr"), ("base_cer", "neg", False, "b_far"))])
    better = rep.pair_improved(F.col("frr"), rep.false_accepts(F.col("far"), F.lit(None).cast("double")), F.col("b_frr"), F.col("b_far"))
    return d.select("lang", *[F.round(c, 6).alias(c) for c in ("frr", "far", "b_frr", "b_far")], better.alias("improved"))


def crop_select(spark: SparkSession, root: str) -> DataFrame:
    return crops.best_crops(_c(spark, root), ["group_key"])


def _occurrences(spark: SparkSession, root: str) -> DataFrame:
    start = F.minute("ts") + F.second("ts") / F.lit(100.0)
    return table(spark, root, "events").select(
        F.col("event_id").alias("source"), start.alias("start_sec"), (start + F.col("value") / 100).alias("end_sec"), (F.col("event_type") != "error").alias("valid"), F.lit(0.0).alias("target_score"), F.lit(800_000).alias("n_samples"), F.lit(16_000).alias("sample_rate")
    )


def crop_occurrences(spark: SparkSession, root: str) -> DataFrame:
    return crops.valid_occurrences(_occurrences(spark, root)).select("source", F.round("start_sec", 6).alias("start_sec"), F.round("end_sec", 6).alias("end_sec"))


def crop_specs(spark: SparkSession, root: str) -> DataFrame:
    return crops.crop_specs(_occurrences(spark, root))


def crop_keys(spark: SparkSession, root: str) -> DataFrame:
    cuts = crops.crop_specs(_occurrences(spark, root))
    key = crops.crop_key(F.sha2(F.col("source").cast("string"), 256), F.lit(crops.crop_policy_digest({"fade_ms": 0})), F.lit(16_000))
    return cuts.select("source", "view", key.alias("crop_key"))


def ctc_forced_align(spark: SparkSession, root: str) -> DataFrame:
    """The vectors of ``embeddings`` as matrices of 8 frames and 8 labels, aligned to two labels each."""
    frames = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda t: F.transform(F.slice("embedding", t * 8 + 1, 8), lambda x: x.cast("double")))
    logs = lambda f: F.transform(f, lambda x: x - F.ln(F.aggregate(f, F.lit(0.0), lambda s, y: s + F.exp(y))))
    tokens = F.array((F.col("label") % 7 + 1).cast("int"), (F.col("vec_id") % 7 + 1).cast("int"))
    # exploding an array of one keeps the lambdas out of the call of the kernel, where the optimiser may not tell two uses to be the same
    matrices = table(spark, root, "embeddings").select("vec_id", F.explode(F.array(F.struct(F.transform(frames, logs).alias("log_probs"), tokens.alias("tokens")))).alias("m"))
    d = signal.alignments(matrices.select("vec_id", "m.*"))
    shown = [F.col(f"alignment.{x}").alias(x) for x in ("start_frame", "end_frame", "start_sec", "end_sec")]
    return d.select("vec_id", *shown, *[F.round(F.col(f"alignment.{x}"), 6).alias(x) for x in ("align_logp_sum", "align_logp_mean", "token_score_min")])


def duration_bucket(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events").groupBy(sc.duration_bucket(F.col("value") / 10).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def duration_tolerance(spark: SparkSession, root: str) -> DataFrame:
    e = numbered(table(spark, root, "events").select("user_id", "ts", "event_id", "value"), ["user_id"], "ts", ["event_id"], "no")
    later = e.select("user_id", (F.col("no") - 1).alias("no"), F.col("value").alias("new"))
    gap = F.abs(F.col("new") - F.col("value"))
    return e.join(later, ["user_id", "no"]).where("value is not null and new is not null").select("event_id", (gap <= F.greatest(F.lit(0.1), F.col("value") * 0.02)).alias("within"))


def longest_run(spark: SparkSession, root: str) -> DataFrame:
    e = numbered(table(spark, root, "events").select("user_id", "ts", "event_id", "value"), ["user_id"], "ts", ["event_id"], "no")
    return rep.runs(e, ["user_id"], "no", F.col("value") > 10).groupBy("user_id").agg(F.max("length").alias("longest"))


def frame_energy_metrics(spark: SparkSession, root: str) -> DataFrame:
    e = numbered(table(spark, root, "events").select("user_id", "ts", "event_id", "value"), ["user_id"], "ts", ["event_id"], "no")
    frames = e.groupBy("user_id", F.floor((F.col("no") - 1) / 4).alias("frame")).agg(F.avg(F.col("value") * F.col("value")).alias("power"))
    low = exact_quantile(frames, ["user_id"], "power", 0.2, "p20")
    d = frames.join(low, "user_id").withColumn("active", F.col("power") > F.greatest(F.col("p20") * 2, F.lit(1e-7)))
    s = d.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_frames"), F.avg(F.col("active").cast("int")).alias("share"), F.avg(F.when(F.col("active"), F.col("power"))).alias("pa"), F.avg(F.when(~F.col("active"), F.col("power"))).alias("pn"))
    snr = F.when(F.col("pn") > 1e-8, 10 * F.log10(F.greatest(F.col("pa") - F.col("pn"), F.lit(1e-8)) / (F.col("pn") + 1e-8)))
    return s.select("user_id", "n_frames", F.round("share", 6).alias("speech_ratio"), F.round(snr, 6).alias("snr_db"))


def spectral_metrics(spark: SparkSession, root: str) -> DataFrame:
    @F.pandas_udf("flatness double, low double, mid double, high double")
    def measure(v):
        import numpy as np
        import pandas as pd

        rows = [signal.quality(np.asarray(x, np.float32), signal.RATE) for x in v]
        return pd.DataFrame({"flatness": [r["spectral_flatness"] for r in rows]} | {b: [r[f"band_energy_{b}"] for r in rows] for b in ("low", "mid", "high")})

    return table(spark, root, "embeddings").select("vec_id", measure("embedding").alias("m")).select("vec_id", "m.*")


def calib_stats(spark: SparkSession, root: str) -> DataFrame:
    c = _c(spark, root).withColumn("label", F.when(F.col("cer_route").isNotNull(), (F.col("cer_route") == 0).cast("int")))
    s = cal.class_statistics(c, "lang", "nll", "label")
    return s.select("lang", "n", "n_positive", "n_negative", F.round("mean", 6).alias("mean"), F.round("scale", 6).alias("scale"))


def calib_fit(spark: SparkSession, root: str) -> DataFrame:
    c = _c(spark, root).withColumn("label", F.when(F.col("cer_route").isNotNull(), (F.col("cer_route") == 0).cast("int")))
    models = cal.fit_logistic(c, "lang", "nll", "label")
    return spark.createDataFrame([(k, m.mean, m.scale, m.slope, m.intercept) for k, m in sorted(models.items())], "lang string, mean double, scale double, slope double, intercept double")


# A calibration to check the formula with.
MODELS = {"zh": cal.Model(1.5, 0.8, -2.0, 0.25), "global": cal.Model(1.2, 0.6, -1.5, 0.1)}


def calib_apply(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "sidecar").select("row_id", F.round(cal.calibrated(F.col("nll"), F.col("lang"), MODELS), 9).alias("p"))


def ctc_align_score(spark: SparkSession, root: str) -> DataFrame:
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.col("cer_route")))
    return _c(spark, root).select("candidate_id", F.when((F.col("lang") == "zh") & F.col("decode_ok") & F.col("cer_route").isNotNull(), score).alias("align_score"))


QUERIES = {
    f.__name__: f
    for f in (
        asr_manifest, cache_hit_miss, loss_reason, group_order, export_slots, export_names, export_validate, export_summary, missing_uid_groups, uid_fingerprint, score_meta, inventory_meta, paired_delta, local_gate, lang_not_worse, pair_improved, crop_select, crop_occurrences,
        crop_specs, crop_keys, ctc_forced_align, duration_bucket, duration_tolerance, longest_run, frame_energy_metrics, spectral_metrics, calib_stats, calib_fit, calib_apply, ctc_align_score,
    )
}

_PATH = "'/' || array_to_string(list_filter(string_split(regexp_replace(source_wav, '^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?', ''), '/'), lambda s: s <> '' AND s <> '.'), '/')"
_SEL = _DECIDED + ", s AS (SELECT cand.*, decided.reason_code FROM cand JOIN decided ON selected_id = candidate_id) "
_ORDERED = "SELECT group_key, row_number() OVER (ORDER BY CASE WHEN split = 'pos' THEN 0 ELSE 1 END, list_transform(regexp_extract_all(lower(uid), '[0-9]+|[^0-9]+'), lambda r: CASE WHEN regexp_matches(r, '^[0-9]') THEN lpad(greatest(1, length(ltrim(r, '0')))::VARCHAR, 10, '0') || coalesce(nullif(ltrim(r, '0'), ''), '0') ELSE r END), group_key) AS group_order FROM (SELECT DISTINCT group_key, split, uid FROM cand)"
_SLOT = "CASE WHEN stream = 'original' THEN 0 WHEN regexp_matches(stream, '^spk[1-4]$') THEN substr(stream, 4)::INT WHEN regexp_matches(stream, '^spk[0-9]+$') THEN substr(stream, 4)::INT + 1 ELSE 900 END"
_INDEX = (
    _DECIDED
    + f""", o AS ({_ORDERED}), i AS (SELECT cand.*, group_order, CASE WHEN candidate_id = selected_id THEN 'SELECTED' WHEN decode_ok THEN 'REJECTED' ELSE 'FAILED' END AS marker FROM cand JOIN decided USING (group_key) JOIN o USING (group_key)),
  x AS (SELECT *, CASE WHEN marker = 'SELECTED' THEN 0 WHEN marker = 'FAILED' THEN 8000 + (CASE WHEN role = 's1' THEN 0 ELSE 40 END) + (CASE WHEN view = 'raw' THEN 0 ELSE 20 END) + {_SLOT}
    ELSE (CASE WHEN role = 's1' THEN 1000 ELSE 3000 END) + (CASE WHEN view = 'raw' THEN 0 ELSE 1000 END) + {_SLOT} END AS slot FROM i) """
)
_PAIRED = _chain(CLOSE, "(SELECT * FROM cand WHERE role = 's1' AND view = 'raw')", False)
_PAIR = _DECIDED + f", base AS ({_PAIRED} SELECT group_key, cer_route AS base_cer FROM win), p AS (SELECT group_key, selected_cer AS cer, base_cer, selected_cer - base_cer AS delta FROM decided JOIN base USING (group_key) WHERE selected_cer IS NOT NULL) "
_OCC = "WITH o AS (SELECT event_id AS source, minute(ts) + second(ts) / 100.0::DOUBLE AS start_sec, (minute(ts) + second(ts) / 100.0::DOUBLE) + value / 100 AS end_sec FROM events WHERE event_type <> 'error'), ok AS (SELECT * FROM o WHERE start_sec >= 0 AND end_sec > start_sec AND end_sec <= 50 + 1e-6) "
_NUMBERED = "WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM events)"
ORACLES = {
    "asr_manifest": f"WITH {CAND} SELECT score_key, candidate_id, source_wav, wake_text, lang FROM cand WHERE score_key IS NOT NULL AND source_wav IS NOT NULL QUALIFY row_number() OVER (PARTITION BY score_key ORDER BY row_id) = 1",
    "cache_hit_miss": f"""WITH {CAND}, w AS (SELECT DISTINCT lower(pcm_sha256) AS digest, {_PATH} AS path FROM cand WHERE pcm_sha256 IS NOT NULL), k AS (SELECT DISTINCT lower(pcm_sha256) AS digest, {_PATH} AS path, true AS cached FROM sep_audio_cache_manifest)
      SELECT CASE WHEN cached THEN 'hit' ELSE 'miss' END AS state, count(*) AS n FROM w LEFT JOIN k USING (digest, path) GROUP BY ALL""",
    "loss_reason": _SEL
    + """SELECT c.candidate_id, CASE WHEN coalesce(c.validity, '') <> 'rankable' THEN coalesce(c.validity, 'fatal_invalid') WHEN c.pcm_sha256 <> '' AND c.pcm_sha256 = s.pcm_sha256 THEN 'same_pcm_prefer_s1' WHEN c.cer_route - s.cer_route > 1e-12 THEN 'higher_cer'
      WHEN abs(c.cer_route - s.cer_route) <= 1e-12 AND c.qkw_calibrated AND s.qkw_calibrated AND c.q_kw < s.q_kw THEN 'equal_cer_lower_qkw' WHEN abs(c.cer_route - s.cer_route) <= 1e-12 AND c.view <> 'raw' AND s.view = 'raw' THEN 'deterministic_raw_tie' ELSE 'deterministic_tie_or_stage_policy' END AS loss_reason
      FROM cand c JOIN s USING (group_key) WHERE c.candidate_id <> s.candidate_id""",
    "group_order": f"WITH {CAND} {_ORDERED}",
    "export_slots": _INDEX + "SELECT candidate_id, marker, slot FROM x",
    "export_names": _INDEX
    + "SELECT candidate_id, array_to_string([CASE WHEN group_order > 999999 THEN group_order::VARCHAR ELSE lpad(group_order::VARCHAR, 6, '0') END, substr(sha256(split || chr(0) || uid), 1, 8), lpad(slot::VARCHAR, 4, '0'), marker, role, view, stream, 'P-' || substr(coalesce(pcm_sha256, 'undec'), 1, 8)], '__') AS name FROM x",
    "export_summary": _SEL
    + ", e AS (SELECT cer_route, unnest(['view', 'stream', 'split', 'reason']) AS dimension, unnest([role || ':' || view, stream, split, reason_code]) AS value FROM s) SELECT dimension, value, count(*) AS n, round(avg(cer_route), 6) AS mean_cer FROM e GROUP BY ALL",
    "missing_uid_groups": f"WITH {CAND} SELECT DISTINCT split, uid FROM arm_index WHERE (split, uid) NOT IN (SELECT (split, uid) FROM cand WHERE cer_route IS NOT NULL)",
    "uid_fingerprint": f"""WITH {CAND}, h AS (SELECT DISTINCT sha256(split || chr(0) || uid) AS h FROM cand), t AS (SELECT count(*) AS n, sum(('0x' || substr(h, 1, 12))::BIGINT)::HUGEINT AS s, bit_xor(('0x' || substr(h, 13, 15))::BIGINT) AS x FROM h)
      SELECT n, sha256(n || ':' || s || ':' || x) AS fingerprint FROM t""",
    "score_meta": f"WITH {CAND} SELECT count(*) AS n_rows, count(DISTINCT pcm_sha256) AS n_audio, count(DISTINCT score_key) AS n_keys, count(*) FILTER (WHERE view = 'raw') AS n_raw, count(*) FILTER (WHERE view = 'moss48k') AS n_enhanced, round(avg((qkw_calibrated AND q_kw IS NOT NULL)::INT), 6) AS probability_coverage FROM cand",
    "inventory_meta": f"""WITH {CAND}, g AS (SELECT split, uid, bool_or(s7_available) AS a, count(*) AS n, count(*) FILTER (WHERE NOT coalesce(decode_ok, false)) AS u FROM cand GROUP BY ALL)
      SELECT split, count(*) AS n_uid, sum(n)::BIGINT AS n_refs, count(*) FILTER (WHERE NOT coalesce(a, false)) AS n_unavailable, sum(u)::BIGINT AS n_undecodable FROM g GROUP BY split""",
    "paired_delta": _PAIR + "SELECT group_key, cer, base_cer, delta FROM p",
    "local_gate": _PAIR
    + """SELECT count(*) AS n_paired, count(*) FILTER (WHERE delta < -1e-12) AS n_better, count(*) FILTER (WHERE delta > 1e-12) AS n_worse, count(*) FILTER (WHERE abs(delta) <= 1e-12) AS n_same,
      round(avg(cer), 6) AS mean_cer, round(avg(base_cer), 6) AS base_mean_cer, round(avg((cer <= 1e-12)::INT), 6) AS zero_share, round(avg((base_cer <= 1e-12)::INT), 6) AS base_zero_share FROM p""",
    "lang_not_worse": _PAIR
    + ", l AS (SELECT group_key, min(lang) AS lang FROM cand GROUP BY group_key), d AS (SELECT lang, avg(cer) AS a, avg(base_cer) AS b FROM p JOIN l USING (group_key) GROUP BY lang) SELECT lang, round(a, 6) AS mean_cer, round(b, 6) AS base_mean_cer, a <= b + 1e-12 AS not_worse FROM d",
    "pair_improved": _PAIR
    + """, l AS (SELECT group_key, min(lang) AS lang, min(split) AS split FROM cand GROUP BY group_key), d AS (SELECT lang, avg((cer > 1e-12)::INT) FILTER (WHERE split = 'pos') AS frr, avg((cer <= 1e-12)::INT) FILTER (WHERE split = 'neg') AS far,
      avg((base_cer > 1e-12)::INT) FILTER (WHERE split = 'pos') AS b_frr, avg((base_cer <= 1e-12)::INT) FILTER (WHERE split = 'neg') AS b_far FROM p JOIN l USING (group_key) GROUP BY lang)
      SELECT lang, round(frr, 6) AS frr, round(far, 6) AS far, round(b_frr, 6) AS b_frr, round(b_far, 6) AS b_far, coalesce((frr < b_frr - 1e-12 OR far < b_far - 1e-12) AND NOT (frr > b_frr + 1e-12 OR far > b_far + 1e-12), false) AS improved FROM d""",
    "export_validate": _INDEX
    + """, g AS (SELECT group_key, count(*) FILTER (WHERE marker = 'SELECTED') AS chosen, arg_min(marker, slot) AS first, min(group_order) AS lo, max(group_order) AS hi FROM x GROUP BY group_key)
      SELECT count(*) FILTER (WHERE chosen <> 1) AS not_one_selected, count(*) FILTER (WHERE first <> 'SELECTED') AS selected_not_first, count(*) FILTER (WHERE lo <> hi) AS split_groups, max(hi) - count(DISTINCT lo) AS gaps,
        (SELECT count(*) FROM (SELECT 1 FROM x GROUP BY group_key, slot HAVING count(*) > 1)) AS slots_twice FROM g""",
    "crop_select": f"WITH {CAND} SELECT group_key, arg_min(candidate_id, (cer_route, candidate_id)) AS selected_id, min(cer_route) AS selected_cer FROM cand WHERE validity = 'rankable' AND cer_route IS NOT NULL GROUP BY group_key",
    "crop_occurrences": _OCC + "SELECT source, round(start_sec, 6) AS start_sec, round(end_sec, 6) AS end_sec FROM ok",
    "crop_specs": _OCC
    + """, p(view, a, b) AS (VALUES ('keyword_tight', 0.08::DOUBLE, 0.12::DOUBLE), ('keyword_normal', 0.16::DOUBLE, 0.24::DOUBLE), ('keyword_wide', 0.30::DOUBLE, 0.40::DOUBLE), ('speaker_ctx', 0.50::DOUBLE, 0.60::DOUBLE)),
      c AS (SELECT source, view, greatest(0, round_even((start_sec - a) * 16000, 0)::BIGINT) AS start_sample, least(800000, round_even((end_sec + b) * 16000, 0)::BIGINT) AS end_sample FROM ok, p)
      SELECT source, view, start_sample, end_sample, start_sample = 0 OR end_sample = 800000 AS boundary_clamped FROM c WHERE end_sample > start_sample AND (end_sample - start_sample) / 16000 >= 0.12""",
    "crop_keys": _OCC
    + f""", p(view, a, b) AS (VALUES ('keyword_tight', 0.08::DOUBLE, 0.12::DOUBLE), ('keyword_normal', 0.16::DOUBLE, 0.24::DOUBLE), ('keyword_wide', 0.30::DOUBLE, 0.40::DOUBLE), ('speaker_ctx', 0.50::DOUBLE, 0.60::DOUBLE)),
      c AS (SELECT source, view, greatest(0, round_even((start_sec - a) * 16000, 0)::BIGINT) AS s, least(800000, round_even((end_sec + b) * 16000, 0)::BIGINT) AS e FROM ok, p)
      SELECT source, view, sha256('{{"alignment_key": "' || sha256(source::VARCHAR) || '", "crop_policy_hash": "{crops.crop_policy_digest({"fade_ms": 0})}", "end_sample": ' || e || ', "fade_ms": 0, "sample_rate": 16000, "start_sample": ' || s || '}}') AS crop_key FROM c WHERE e > s AND (e - s) / 16000 >= 0.12""",
    # every way to lay two labels into eight frames: the first from a to b, blanks to c, the second to d, blanks to the end
    "ctc_forced_align": """WITH x AS (SELECT vec_id, label % 7 + 1 AS k1, vec_id % 7 + 1 AS k2, t, embedding::DOUBLE[] AS e, list_sum(list_transform(embedding[t * 8 + 1 : t * 8 + 8]::DOUBLE[], lambda v: exp(v))) AS z FROM embeddings, range(8) r(t)),
      f AS (SELECT vec_id, k1, k2, t, e[t * 8 + 1 + k1] - ln(z) AS l1, e[t * 8 + 1 + k2] - ln(z) AS l2, e[t * 8 + 1] - ln(z) AS l0 FROM x),
      p AS (SELECT vec_id, k1, k2, t + 1 AS t, sum(l1) OVER w AS s1, sum(l2) OVER w AS s2, sum(l0) OVER w AS s0 FROM f WINDOW w AS (PARTITION BY vec_id ORDER BY t) UNION ALL SELECT DISTINCT vec_id, k1, k2, 0, 0, 0, 0 FROM f),
      g AS (SELECT a.vec_id, a.t AS a, d.t AS d, (b.s1 - a.s1) / (b.t - a.t) AS m1, (d.s2 - c.s2) / (d.t - c.t) AS m2, (b.s1 - a.s1) + (c.s0 - b.s0) + (d.s2 - c.s2) AS total, z.s0 - d.s0 AS rest
        FROM p a JOIN p b ON b.vec_id = a.vec_id AND b.t > a.t JOIN p c ON c.vec_id = a.vec_id AND c.t >= b.t AND (c.t > b.t OR a.k1 <> a.k2) JOIN p d ON d.vec_id = a.vec_id AND d.t > c.t JOIN p z ON z.vec_id = a.vec_id AND z.t = 8)
      SELECT vec_id, a AS start_frame, d - 1 AS end_frame, a / 50.0::DOUBLE AS start_sec, d / 50.0::DOUBLE AS end_sec, round(total, 6) AS align_logp_sum, round((m1 + m2) / 2, 6) AS align_logp_mean, round(least(m1, m2), 6) AS token_score_min
      FROM g QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY total + rest DESC) = 1""",
    "duration_bucket": "SELECT floor(value / 10 / 0.5)::BIGINT AS bucket, count(*) AS n FROM events GROUP BY ALL",
    "duration_tolerance": "SELECT event_id, abs(new - value) <= greatest(0.1::DOUBLE, value * 0.02::DOUBLE) AS within FROM (SELECT event_id, value, lead(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS new FROM events) WHERE new IS NOT NULL",
    "longest_run": _NUMBERED + " SELECT user_id, max(c) AS longest FROM (SELECT user_id, count(*) AS c FROM (SELECT user_id, no - row_number() OVER (PARTITION BY user_id ORDER BY no) AS g FROM n WHERE value > 10) GROUP BY user_id, g) GROUP BY user_id",
    "frame_energy_metrics": _NUMBERED
    + """, f AS (SELECT user_id, (no - 1) // 4 AS frame, avg(value * value) AS power FROM n GROUP BY ALL), l AS (SELECT user_id, quantile_cont(power, 0.2) AS p20 FROM f GROUP BY user_id), d AS (SELECT *, power > greatest(p20 * 2, 1e-7) AS active FROM f JOIN l USING (user_id)),
      s AS (SELECT user_id, count(*) AS n_frames, avg(active::INT) AS share, avg(power) FILTER (WHERE active) AS pa, avg(power) FILTER (WHERE NOT active) AS pn FROM d GROUP BY user_id)
      SELECT user_id, n_frames, round(share, 6) AS speech_ratio, round(CASE WHEN pn > 1e-8 AND pa IS NOT NULL THEN 10 * log10(greatest(pa - pn, 1e-8) / (pn + 1e-8)) END, 6) AS snr_db FROM s""",
    "calib_stats": f"WITH {CAND} SELECT lang, count(*) AS n, count(*) FILTER (WHERE cer_route = 0) AS n_positive, count(*) FILTER (WHERE cer_route <> 0) AS n_negative, round(avg(nll), 6) AS mean, round(stddev_pop(nll), 6) AS scale FROM cand WHERE nll IS NOT NULL AND cer_route IS NOT NULL GROUP BY lang",
    "calib_apply": "SELECT row_id, round(CASE WHEN isfinite(nll) THEN 1 / (1 + exp(-(CASE WHEN lang = 'zh' THEN -2.0 * (nll - 1.5) / 0.8 + 0.25 ELSE -1.5 * (nll - 1.2) / 0.6 + 0.1 END))) END, 9) AS p FROM sidecar",
    "ctc_align_score": f"WITH {CAND} SELECT candidate_id, CASE WHEN lang = 'zh' AND decode_ok AND cer_route IS NOT NULL THEN greatest(0, least(1, 1 - cer_route)) END AS align_score FROM cand",
}
