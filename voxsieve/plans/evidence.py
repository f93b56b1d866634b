"""Evidence queries over ``scored_candidates``, ``sidecar`` and ``arm_index``, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxsieve.functions import text as tx
from voxsieve.functions import scalars as sc
from voxsieve.functions.scalars import content_hash, cosine
from voxsieve.operators import crops
from voxsieve.operators import evidence as ev
from voxsieve.operators import selection as sel
from voxsieve.plans.selection import CAND, _chain, hot_groups
from voxsieve.operators.skew import heavy_keys, salted_left_join
from voxsieve.policy import CLOSE
from voxsieve.sources.tables import table



def _c(spark: SparkSession, root: str) -> DataFrame:
    return sel.candidates(table(spark, root, "scored_candidates"))


def score_key_hash(spark: SparkSession, root: str) -> DataFrame:
    c = table(spark, root, "scored_candidates")
    return c.where("pcm_sha256 is not null").select("row_id", content_hash(F.col("pcm_sha256"), F.col("wake_text"), F.col("lang")).alias("score_key"))


def sidecar_dedupe(spark: SparkSession, root: str) -> DataFrame:
    return ev.first_rows(table(spark, root, "sidecar"))


def sidecar_conflicts(spark: SparkSession, root: str) -> DataFrame:
    return ev.conflicts(table(spark, root, "sidecar"))


def sidecar_priority_join(spark: SparkSession, root: str) -> DataFrame:
    return ev.matched(_c(spark, root), table(spark, root, "sidecar"))


def alignment_lookup(spark: SparkSession, root: str) -> DataFrame:
    there = F.col("pcm_sha256").isNotNull() & F.col("wake_text").isNotNull() & F.col("lang").isNotNull()
    nothing = F.lit(None).cast("string")
    return ev.aligned(_c(spark, root), table(spark, root, "sidecar"), F.when(there, crops.alignment_key(*[nothing] * 5)))


def crop_lookup(spark: SparkSession, root: str) -> DataFrame:
    return ev.crop_evidence(_c(spark, root), table(spark, root, "sidecar"))


def cache_rebind(spark: SparkSession, root: str) -> DataFrame:
    stored = table(spark, root, "sep_audio_cache_manifest").select("pcm_sha256", "file_sha256", F.col("cached_wav").alias("stored_path"))
    return ev.rebound(_c(spark, root).select("candidate_id", "pcm_sha256", "source_wav"), stored).drop("pcm_sha256")


def sidecar_bind_violations(spark: SparkSession, root: str) -> DataFrame:
    return ev.binding_violations(ev.with_evidence(_c(spark, root), table(spark, root, "sidecar"), ["pcm_sha256", "wake_text", "lang"]))


def missing_asr(spark: SparkSession, root: str) -> DataFrame:
    c = _c(spark, root)
    return ev.unmatched_keys(c, ev.matched(c, table(spark, root, "sidecar")))


def qkw_contract(spark: SparkSession, root: str) -> DataFrame:
    side = table(spark, root, "sidecar")
    counts = side.where("calibrator_hash is not null").groupBy("calibrator_hash").agg(F.count(F.lit(1)).alias("n"))
    top = counts.agg(F.min_by("calibrator_hash", F.struct(-F.col("n"), F.col("calibrator_hash"))).alias("h")).first()
    return ev.probability_contract(_c(spark, root), side, (top and top["h"]) or "")


def arm_subset_check(spark: SparkSession, root: str) -> DataFrame:
    arms = table(spark, root, "arm_index").select("split", "uid", F.col("arm").startswith("s1").alias("primary")).distinct()
    return arms.where("not primary").join(arms.where("primary"), ["split", "uid"], "left_anti").select("split", "uid")


def arm_availability(spark: SparkSession, root: str) -> DataFrame:
    arms = table(spark, root, "arm_index").groupBy("split", "uid").agg(F.bool_or(F.col("arm").startswith("s1")).alias("in_primary"), F.bool_or(~F.col("arm").startswith("s1")).alias("s7_available"))
    return arms.where("in_primary").select("split", "uid", "s7_available")


def lang_infer(spark: SparkSession, root: str) -> DataFrame:
    lang, origin = tx.language_of(F.col("lang"), F.col("wake_text"))
    return table(spark, root, "arm_index").select("row_id", lang.alias("language"), origin.alias("origin"))


def stream_canonicalize(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "arm_index").select("row_id", F.array_join(tx.stream_names(F.col("streams")), ",").alias("names"))


def text_normalize(spark: SparkSession, root: str) -> DataFrame:
    t = F.col("hyp")
    return table(spark, root, "sidecar").select("row_id", tx.single_spaced(tx.normal_text(t)).alias("words"), tx.normal_chars(t).alias("chars"))


def text_errors(spark: SparkSession, root: str) -> DataFrame:
    return tx.text_errors(table(spark, root, "sidecar").select("row_id", "hyp", "wake_text"), "hyp", "wake_text").drop("hyp", "wake_text")


def cer_char(spark: SparkSession, root: str) -> DataFrame:
    return text_errors(spark, root).select("row_id", "cer_char")


def cer_alias_min(spark: SparkSession, root: str) -> DataFrame:
    return text_errors(spark, root).select("row_id", "metric", "alias_hit", "cer_alias", "cer_route")


def wake_coverage(spark: SparkSession, root: str) -> DataFrame:
    return text_errors(spark, root).select("row_id", "wake_coverage", "core_hit")


def extra_ratio(spark: SparkSession, root: str) -> DataFrame:
    return text_errors(spark, root).select("row_id", "extra_ratio")


def alignment_normalise(spark: SparkSession, root: str) -> DataFrame:
    c = _c(spark, root).select("score_key", "pcm_sha256", "wake_text", "lang").where("score_key is not null").groupBy("score_key").agg(*[F.min(f).alias(f) for f in ("pcm_sha256", "wake_text", "lang")])
    return ev.backfilled(table(spark, root, "sidecar").select("row_id", "score_key", "pcm_sha256", "wake_text", "lang"), c, "score_key", ["pcm_sha256", "wake_text", "lang"])


def distinct_feature_reuse(spark: SparkSession, root: str) -> DataFrame:
    """A feature worked out once per audio and looked up by every row that has it."""
    s = table(spark, root, "sidecar").select("row_id", "pcm_sha256")
    feature = F.substring(F.sha2("pcm_sha256", 256), 1, 12)
    once = s.where("pcm_sha256 is not null").groupBy("pcm_sha256").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("feature", feature)
    return salted_left_join(s, once, "pcm_sha256", "row_id", heavy_keys(s, F.col("pcm_sha256"))).select("row_id", "feature", "n_rows")


def _described(spark: SparkSession, root: str) -> DataFrame:
    joined = ev.with_evidence(_c(spark, root), table(spark, root, "sidecar"), ["hyp"]).drop("extra_ratio", "cer_route")
    return tx.text_errors(joined, "ev_hyp", "wake_text")


def _classes(spark: SparkSession, root: str) -> DataFrame:
    d = _described(spark, root)
    fatal = ~F.coalesce(F.col("decode_ok"), F.lit(False))
    label = ev.classify_content(fatal, F.col("wake_coverage"), F.col("core_hit"), F.col("extra_ratio"), F.col("ev_hyp"), F.col("p_music"), F.col("speech_ratio"), F.col("p_overlap"))
    return d.withColumns({"fatal": fatal, "label": label})


def content_class(spark: SparkSession, root: str) -> DataFrame:
    return _classes(spark, root).select("candidate_id", F.col("label").alias("content_class"))


def validity_rules(spark: SparkSession, root: str) -> DataFrame:
    d = _classes(spark, root)
    state = (
        F.when(F.col("fatal") | F.col("ev_hyp").isNull(), "fatal_invalid")
        .when((F.col("lang") == "en") & ~F.col("core_hit"), "semantic_ineligible")
        .when((F.col("label") == "uncertain_or_hallucination") & (F.col("cer_route") > 0.5), "semantic_ineligible")
        .otherwise("rankable")
    )
    return d.select("candidate_id", state.alias("validity"))


def se_parent_delta(spark: SparkSession, root: str) -> DataFrame:
    return ev.parent_deltas(_c(spark, root)).drop("content_class")


def se_parent_similarity(spark: SparkSession, root: str) -> DataFrame:
    """Vectors of ``embeddings`` stand in for those of the recordings, their first numbers for the likeness to a reference speaker."""
    vectors = table(spark, root, "embeddings").select("vec_id", "embedding", F.col("embedding")[0].cast("double").alias("speaker_ref_score"))
    c = _c(spark, root).drop("speaker_ref_score").withColumn("vec_id", F.col("row_id") % 500).join(vectors, "vec_id", "left")
    d = ev.with_parents(c).where("view = 'moss48k'")
    return d.select("candidate_id", "raw_parent_pcm_sha256", *[F.round(x, 6).alias(x) for x in ("delta_cer", "cos_se_raw", "gain_ref")])


def se_delta_rollup(spark: SparkSession, root: str) -> DataFrame:
    d = ev.parent_deltas(_c(spark, root)).where("delta_cer is not null")
    bucket = F.when(F.col("delta_cer") < -1e-12, "improved").when(F.col("delta_cer") > 1e-12, "worsened").otherwise("same")
    sums = d.withColumn("bucket", bucket).groupingSets([["content_class", "bucket"], ["bucket"]], "content_class", "bucket").agg(F.count(F.lit(1)).alias("n"))
    return sums.select(F.coalesce("content_class", F.lit("all")).alias("content_class"), "bucket", "n")


def se_view_expand(spark: SparkSession, root: str) -> DataFrame:
    return ev.expanded_views(_c(spark, root).where("view = 'raw'"))


def se_companion(spark: SparkSession, root: str) -> DataFrame:
    c = _c(spark, root)
    won = sel.stage_winners(c, CLOSE, hot=hot_groups(spark, root)).select("group_key", F.col("winner.candidate_id").alias("candidate_id"), F.col("winner.view").alias("view"), F.col("winner.pcm_sha256").alias("pcm_sha256"))
    return ev.companions(won, c)


def embedding_cosine(spark: SparkSession, root: str) -> DataFrame:
    e = table(spark, root, "embeddings")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(nxt, "vec_id").select("vec_id", F.round(cosine(F.col("embedding"), F.col("other")), 6).alias("cosine"))


def asr_ab_audit(spark: SparkSession, root: str) -> DataFrame:
    s = table(spark, root, "sidecar").where("score_key <> ''")
    bare = F.regexp_replace(F.lower("hyp"), r"[^0-9a-z\x{4E00}-\x{9FFF}]", "")
    runs = [s.where(F.col("score_kind") == k).groupBy("score_key").agg(F.min_by(bare, "row_id").alias(n)) for k, n in (("nll", "a"), ("calibrated_qkw", "b"))]
    both = runs[0].join(runs[1], "score_key", "full_outer")
    has_a, has_b = F.col("a").isNotNull(), F.col("b").isNotNull()
    return both.agg(F.count_if(has_a & ~has_b).alias("only_a"), F.count_if(~has_a & has_b).alias("only_b"), F.count_if(has_a & has_b).alias("in_both"), F.count_if(F.col("a") == F.col("b")).alias("same_text"))


def tag_strip(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "documents").select("doc_id", sc.tag_strip(F.col("text")).alias("bare"))


QUERIES = {
    f.__name__: f
    for f in (
        score_key_hash, sidecar_dedupe, sidecar_conflicts, sidecar_priority_join, alignment_lookup, crop_lookup, cache_rebind, se_parent_similarity, sidecar_bind_violations, missing_asr, qkw_contract, arm_subset_check, arm_availability, lang_infer, stream_canonicalize, text_normalize, text_errors, cer_char, cer_alias_min, wake_coverage, extra_ratio, alignment_normalise,
        distinct_feature_reuse, content_class, validity_rules, se_parent_delta, se_delta_rollup, se_view_expand, se_companion, embedding_cosine, asr_ab_audit, tag_strip,
    )
}

_KEYS = """SELECT {r} AS row_id, prio, key FROM (SELECT {r}, unnest([0, 1, 2, 3]) AS prio, unnest([
  CASE WHEN score_key <> '' THEN 'score:' || score_key END, CASE WHEN candidate_id <> '' THEN 'id:' || candidate_id END,
  CASE WHEN pcm_sha256 <> '' AND wake_text IS NOT NULL AND lang <> '' THEN 'asr:' || sha256(to_json([pcm_sha256, wake_text, lang])::VARCHAR) END,
  CASE WHEN pcm_sha256 <> '' AND NOT (wake_text IS NOT NULL AND coalesce(lang, '') <> '') THEN 'pcm:' || pcm_sha256 END]) AS key FROM {t}) WHERE key IS NOT NULL"""
_BOTH = f"WITH {CAND}, ck AS ({_KEYS.format(r='row_id', t='cand')}), sk AS ({_KEYS.format(r='row_id', t='sidecar')}), "
_MATCH = _BOTH + "firsts AS (SELECT key, {pick}(row_id) AS evidence_row FROM sk GROUP BY key), m AS (SELECT row_id, arg_min(evidence_row, prio) AS evidence_row, min(prio) AS prio FROM ck JOIN firsts USING (key) GROUP BY row_id) "
_FIRST = _MATCH.format(pick="min")
#: The alignment's three kinds of keys; what depends on audio, phrase and language only is written as these.
_ALIGNED = """SELECT row_id, prio, key FROM (SELECT row_id, unnest([0, 1, 2]) AS prio, unnest([
  CASE WHEN pcm_sha256 IS NOT NULL AND wake_text IS NOT NULL AND lang IS NOT NULL THEN 'a:' || to_json([pcm_sha256, wake_text, lang])::VARCHAR END, CASE WHEN score_key <> '' THEN 's:' || score_key END,
  'p:' || coalesce(pcm_sha256, 'None') || '|' || coalesce(wake_text, 'None') || '|' || coalesce(lang, 'None')]) AS key FROM {t}) WHERE key IS NOT NULL"""
_CROPPED = "SELECT row_id, prio, key FROM (SELECT row_id, unnest([0, 1]) AS prio, unnest([nullif(score_key, ''), nullif(candidate_id, '')]) AS key FROM {t}) WHERE key IS NOT NULL"
_BEST = "m AS (SELECT row_id, arg_min(evidence_row, prio) AS evidence_row, min(prio) AS prio FROM ck JOIN known USING (key) GROUP BY row_id) SELECT row_id, prio, evidence_row FROM m"
_DIFFER = " OR ".join(f"coalesce(n.{f} <> f.{f}, false)" for f in ev.COMPARED)
ORACLES = {
    "score_key_hash": "SELECT row_id, sha256(to_json([pcm_sha256, wake_text, lang])::VARCHAR) AS score_key FROM scored_candidates WHERE pcm_sha256 IS NOT NULL",
    "sidecar_dedupe": f"WITH sk AS ({_KEYS.format(r='row_id', t='sidecar')}) SELECT key, min(row_id) AS row_id FROM sk GROUP BY key",
    "sidecar_conflicts": f"""WITH sk AS ({_KEYS.format(r='row_id', t='sidecar')}), f1 AS (SELECT key, min(row_id) AS first_row_id FROM sk WHERE key NOT LIKE 'pcm:%' GROUP BY key)
      SELECT key, sk.row_id, first_row_id FROM sk JOIN f1 USING (key) JOIN sidecar n ON n.row_id = sk.row_id JOIN sidecar f ON f.row_id = first_row_id WHERE sk.row_id > first_row_id AND ({_DIFFER})""",
    "sidecar_priority_join": _FIRST + "SELECT row_id, prio, evidence_row FROM m",
    "alignment_lookup": f"""WITH {CAND}, ck AS ({_ALIGNED.format(t='cand')}), sk AS ({_ALIGNED.format(t='sidecar')}),
      known AS (SELECT key, CASE WHEN key LIKE 'a:%' THEN max(row_id) ELSE min(row_id) END AS evidence_row FROM sk GROUP BY key), {_BEST}""",
    "crop_lookup": f"WITH {CAND}, ck AS ({_CROPPED.format(t='cand')}), sk AS ({_CROPPED.format(t='sidecar')}), known AS (SELECT key, max(row_id) AS evidence_row FROM sk GROUP BY key), {_BEST}",
    "cache_rebind": f"""WITH {CAND}, k AS (SELECT lower(pcm_sha256) AS pcm, cached_wav, file_sha256 FROM sep_audio_cache_manifest WHERE pcm_sha256 <> '' AND cached_wav IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY lower(pcm_sha256) ORDER BY cached_wav, file_sha256 NULLS FIRST) = 1)
      SELECT candidate_id, coalesce(cached_wav, source_wav) AS source_wav, CASE WHEN cached_wav IS NOT NULL THEN source_wav END AS origin_wav, file_sha256, CASE WHEN cached_wav IS NOT NULL THEN 'sep_pcm' END AS audio_cache_kind
      FROM cand LEFT JOIN k ON k.pcm = lower(nullif(pcm_sha256, ''))""",
    "se_parent_similarity": f"""WITH {CAND}, v AS (SELECT cand.*, embedding::DOUBLE[] AS e FROM cand LEFT JOIN embeddings ON vec_id = row_id % 500)
      SELECT c.candidate_id, CASE WHEN two THEN p_pcm END AS raw_parent_pcm_sha256, round(CASE WHEN two THEN d END, 6) AS delta_cer, round(CASE WHEN two THEN cos END, 6) AS cos_se_raw, round(CASE WHEN two THEN g END, 6) AS gain_ref
      FROM (SELECT c.candidate_id, c.cer_route IS NOT NULL AND p.cer_route IS NOT NULL AS two, p.pcm_sha256 AS p_pcm, c.cer_route - p.cer_route AS d, list_cosine_similarity(c.e, p.e) AS cos, c.e[1] - p.e[1] AS g
        FROM v c LEFT JOIN v p ON p.candidate_id = nullif(c.raw_parent_candidate_id, '') WHERE c.view = 'moss48k') c""",
    "sidecar_bind_violations": _FIRST
    + """, x AS (SELECT m.row_id, evidence_row, coalesce(nullif(c.pcm_sha256, '') <> nullif(s.pcm_sha256, ''), false) AS bad_pcm, coalesce(nullif(c.wake_text, '') <> nullif(s.wake_text, ''), false) AS bad_wake, coalesce(nullif(c.lang, '') <> nullif(s.lang, ''), false) AS bad_lang
      FROM m JOIN cand c USING (row_id) JOIN sidecar s ON s.row_id = evidence_row) SELECT * FROM x WHERE bad_pcm OR bad_wake OR bad_lang""",
    "missing_asr": _FIRST + "SELECT DISTINCT score_key FROM cand WHERE score_key IS NOT NULL AND row_id NOT IN (SELECT row_id FROM m)",
    "qkw_contract": f"""WITH {CAND}, top AS (SELECT calibrator_hash AS h FROM sidecar WHERE calibrator_hash IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
      e AS (SELECT * FROM sidecar WHERE score_key <> '' QUALIFY row_number() OVER (PARTITION BY score_key ORDER BY row_id) = 1)
      SELECT score_key, CASE WHEN e.row_id IS NULL OR q_kw IS NULL OR isnan(q_kw) THEN 'missing' WHEN coalesce(score_kind <> 'calibrated_qkw', true) THEN 'kind' WHEN coalesce(calibrator_hash <> (SELECT h FROM top), true) THEN 'hash' WHEN NOT q_kw BETWEEN 0 AND 1 THEN 'range' ELSE 'ok' END AS state
      FROM (SELECT DISTINCT score_key FROM cand WHERE score_key IS NOT NULL) LEFT JOIN e USING (score_key)""",
    "arm_subset_check": "SELECT DISTINCT split, uid FROM arm_index WHERE arm NOT LIKE 's1%' AND (split, uid) NOT IN (SELECT (split, uid) FROM arm_index WHERE arm LIKE 's1%')",
    "arm_availability": "SELECT split, uid, bool_or(arm NOT LIKE 's1%') AS s7_available FROM arm_index GROUP BY ALL HAVING bool_or(arm LIKE 's1%')",
    "lang_infer": """SELECT row_id, coalesce(a, b, '') AS language, CASE WHEN a IS NOT NULL THEN 'index_lang' WHEN b IS NOT NULL THEN 'inferred_from_wake_text' ELSE 'missing_wake_text' END AS origin FROM (
      SELECT row_id, CASE WHEN lower(trim(lang)) IN ('zh', 'cn', 'chinese', '中文', 'mandarin') THEN 'zh' WHEN lower(trim(lang)) IN ('en', 'english', '英文') THEN 'en' END AS a,
        CASE WHEN regexp_matches(coalesce(wake_text, ''), '[一-鿿]') THEN 'zh' WHEN trim(coalesce(wake_text, '')) <> '' THEN 'en' END AS b FROM arm_index)""",
    "stream_canonicalize": r"""WITH n AS (SELECT row_id, CASE WHEN streams LIKE '{%' THEN json_keys(streams) WHEN streams LIKE '[%' THEN CASE WHEN json_type(streams, '$[0]') = 'OBJECT' THEN coalesce(nullif(json_extract_string(streams, '$[*].stream'), []), nullif(json_extract_string(streams, '$[*].name'), []), json_extract_string(streams, '$[*].id')) ELSE json_extract_string(streams, '$[*]') END END AS names FROM arm_index),
      e AS (SELECT row_id, CASE WHEN name = 'peak' THEN 'original' ELSE name END AS name, pos FROM (SELECT row_id, unnest(names) AS name, generate_subscripts(names, 1) AS pos FROM n) WHERE name <> ''),
      d AS (SELECT row_id, name, min(pos) AS pos FROM e GROUP BY ALL)
      SELECT arm_index.row_id, coalesce(string_agg(name, ',' ORDER BY pos), '') AS names FROM arm_index LEFT JOIN d USING (row_id) GROUP BY arm_index.row_id""",
    "alignment_normalise": f"""WITH {CAND}, k AS (SELECT score_key, min(pcm_sha256) AS p, min(wake_text) AS w, min(lang) AS l FROM cand WHERE score_key IS NOT NULL GROUP BY score_key)
      SELECT row_id, score_key, coalesce(pcm_sha256, p) AS pcm_sha256, coalesce(wake_text, w) AS wake_text, coalesce(lang, l) AS lang FROM sidecar LEFT JOIN k USING (score_key)""",
    "distinct_feature_reuse": "SELECT row_id, substr(sha256(pcm_sha256), 1, 12) AS feature, CASE WHEN pcm_sha256 IS NOT NULL THEN count(*) OVER (PARTITION BY pcm_sha256) END AS n_rows FROM sidecar",
    "se_parent_delta": f"WITH {CAND} SELECT c.candidate_id, c.cer_route - p.cer_route AS delta_cer, c.nll - p.nll AS delta_nll FROM cand c LEFT JOIN cand p ON p.candidate_id = nullif(c.raw_parent_candidate_id, '') WHERE c.view = 'moss48k'",
    "se_delta_rollup": f"""WITH {CAND}, d AS (SELECT c.content_class, CASE WHEN c.cer_route - p.cer_route < -1e-12 THEN 'improved' WHEN c.cer_route - p.cer_route > 1e-12 THEN 'worsened' ELSE 'same' END AS bucket
      FROM cand c JOIN cand p ON p.candidate_id = c.raw_parent_candidate_id WHERE c.view = 'moss48k' AND c.cer_route IS NOT NULL AND p.cer_route IS NOT NULL)
      SELECT coalesce(content_class, 'all') AS content_class, bucket, count(*) AS n FROM d GROUP BY GROUPING SETS ((content_class, bucket), (bucket))""",
    "se_view_expand": f"""WITH {CAND} SELECT candidate_id, group_key, view, NULL AS parent_id, NULL AS parent_pcm FROM cand WHERE view = 'raw'
      UNION ALL SELECT replace(candidate_id, '-raw-', '-moss48k-'), group_key, 'moss48k', candidate_id, pcm_sha256 FROM cand WHERE view = 'raw' AND pcm_sha256 <> ''""",
    "se_companion": _chain(CLOSE)
    + """, s AS (SELECT candidate_id AS selected_id, group_key, pcm_sha256 AS selected_pcm FROM win WHERE view = 'raw'),
      e AS (SELECT c.*, p.pcm_sha256 AS parent_pcm FROM cand c LEFT JOIN cand p ON p.candidate_id = c.raw_parent_candidate_id WHERE c.view = 'moss48k' AND c.source_wav IS NOT NULL)
      SELECT selected_id, arg_min(candidate_id, (CASE WHEN validity = 'rankable' AND cer_route IS NOT NULL THEN 0 ELSE 1 END, coalesce(cer_route, 'inf'::DOUBLE), candidate_id)) AS companion_id
      FROM s JOIN e ON e.group_key = s.group_key AND (e.raw_parent_candidate_id = selected_id OR (selected_pcm <> '' AND e.parent_pcm = selected_pcm)) GROUP BY selected_id""",
    "embedding_cosine": "SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1",
    "asr_ab_audit": r"""WITH r AS (SELECT score_key, score_kind, arg_min(regexp_replace(lower(hyp), '[^0-9a-z一-鿿]', '', 'g'), row_id) AS t FROM sidecar WHERE score_key <> '' GROUP BY ALL),
      j AS (SELECT a.t AS a, b.t AS b FROM (SELECT * FROM r WHERE score_kind = 'nll') a FULL JOIN (SELECT * FROM r WHERE score_kind = 'calibrated_qkw') b USING (score_key))
      SELECT count(*) FILTER (WHERE a IS NOT NULL AND b IS NULL) AS only_a, count(*) FILTER (WHERE a IS NULL AND b IS NOT NULL) AS only_b, count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS in_both, count(*) FILTER (WHERE a = b) AS same_text FROM j""",
    "tag_strip": r"SELECT doc_id, trim(regexp_replace(regexp_replace(text, '<[^>]*>', ' ', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g')) AS bare FROM documents",
}
