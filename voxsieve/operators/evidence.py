"""Joining evidence rows to candidates by prioritised keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxsieve.functions.scalars import content_hash, cosine
from voxsieve.operators.skew import heavy_keys, salted_left_join

#: Fields in which two rows of one key must not differ.
COMPARED = ["hyp", "nll", "q_kw", "score_kind", "calibrator_hash", "pcm_sha256", "wake_text", "lang"]


def filled(c: Column) -> Column:
    """``c``, or null for ''."""
    return F.when(c != "", c)


def keys_of(df: DataFrame, path: str | None = None) -> Column:
    """The lookup keys of a row in order of priority: score key, candidate id, content (audio, phrase, language), audio alone, path.

    The bare audio key counts only where phrase or language is missing.
    """
    c = F.col
    pcm, asr = filled(c("pcm_sha256")), content_hash(c("pcm_sha256"), c("wake_text"), c("lang"))
    full = pcm.isNotNull() & c("wake_text").isNotNull() & filled(c("lang")).isNotNull()
    kinds = [
        F.concat(F.lit("score:"), filled(c("score_key"))),
        F.concat(F.lit("id:"), filled(c("candidate_id"))),
        F.when(full, F.concat(F.lit("asr:"), asr)),
        F.when(~full, F.concat(F.lit("pcm:"), pcm)),
    ]
    if path:
        kinds.append(F.concat(F.lit("path:"), filled(c(path))))
    return F.array_compact(F.array(*[F.when(k.isNotNull(), F.struct(F.lit(i).alias("prio"), k.alias("key"))) for i, k in enumerate(kinds)]))


def keyed(df: DataFrame, row_id: str = "row_id", path: str | None = None) -> DataFrame:
    """One row per row and key: ``row_id, prio, key``."""
    return df.select(F.col(row_id).alias("row_id"), F.explode(keys_of(df, path)).alias("k")).select("row_id", "k.prio", "k.key")


def first_rows(sidecar: DataFrame, last: bool = False) -> DataFrame:
    """``key, row_id``: the first row (the last with ``last``) that brings each key; ids give the order of arrival."""
    pick = F.max("row_id") if last else F.min("row_id")
    return keyed(sidecar).groupBy("key").agg(pick.alias("row_id"))


def conflicts(sidecar: DataFrame, compared: list[str] | None = None) -> DataFrame:
    """``key, row_id, first_row_id``: rows that differ from the first row of a key in a field that both have.

    Bare audio keys may differ. A field is had if it isn't null.
    """
    names = compared or COMPARED
    k = keyed(sidecar).where(~F.col("key").startswith("pcm:"))
    fields = F.struct(*names)
    rows = k.join(sidecar.select("row_id", fields.alias("now")), "row_id")
    firsts = rows.groupBy("key").agg(F.min_by("now", "row_id").alias("first"), F.min("row_id").alias("first_row_id"))
    met = salted_left_join(rows, firsts, "key", "row_id", heavy_keys(rows, F.col("key")))
    unlike = lambda f: F.coalesce(F.col(f"now.{f}") != F.col(f"first.{f}"), F.lit(False))
    return met.where(F.col("row_id") > F.col("first_row_id")).where(reduce(lambda a, b: a | b, [unlike(f) for f in names])).select("key", "row_id", "first_row_id")


def matched(candidates: DataFrame, sidecar: DataFrame, path: str | None = None, last: bool = False) -> DataFrame:
    """``row_id, prio, evidence_row``: for each candidate with any match, its evidence by the first of its keys that is found."""
    probe = keyed(candidates, path=path)
    known = first_rows(sidecar, last).withColumnRenamed("row_id", "evidence_row")
    hits = salted_left_join(probe, known, "key", "row_id", heavy_keys(probe, F.col("key"))).where("evidence_row is not null")
    return hits.groupBy("row_id").agg(F.min(F.struct("prio", "evidence_row")).alias("m")).select("row_id", "m.prio", "m.evidence_row")


def with_evidence(candidates: DataFrame, sidecar: DataFrame, fields: list[str], path: str | None = None) -> DataFrame:
    """All candidates with ``prio`` and the evidence columns ``ev_*``; null without a match."""
    m = matched(candidates, sidecar, path)
    payload = sidecar.select(F.col("row_id").alias("evidence_row"), *[F.col(f).alias(f"ev_{f}") for f in fields])
    found = salted_left_join(m, payload, "evidence_row", "row_id", heavy_keys(m, F.col("evidence_row")))  # one row may serve very many candidates
    return candidates.join(found, "row_id", "left")


def matched_by(probe: DataFrame, evidence: DataFrame, kinds: list[tuple[str, Column, bool]]) -> DataFrame:
    """``row_id, prio, evidence_row``: for each probe row with any match, its evidence by the first of ``kinds`` that is found.

    A kind is (name, key as an expression over either table, whether the last row with a key counts instead of the first). Kinds of the same name
    share their keys. Rows whose key is null have none of that kind.
    """
    options = F.array_compact(F.array(*[F.when(k.isNotNull(), F.struct(F.lit(i).alias("prio"), F.concat(F.lit(f"{name}:"), k).alias("key"), F.lit(last).alias("last"))) for i, (name, k, last) in enumerate(kinds)]))
    asked, known = (d.select("row_id", F.explode(options).alias("k")).select("row_id", "k.*") for d in (probe, evidence))
    known = known.groupBy("key").agg(F.min("row_id").alias("_first"), F.max("row_id").alias("_last"), F.max("last").alias("_is_last"))
    known = known.select("key", F.when(F.col("_is_last"), F.col("_last")).otherwise(F.col("_first")).alias("evidence_row"))
    hits = salted_left_join(asked, known, "key", "row_id", heavy_keys(asked, F.col("key"))).where("evidence_row is not null")
    return hits.groupBy("row_id").agg(F.min(F.struct("prio", "evidence_row")).alias("m")).select("row_id", "m.prio", "m.evidence_row")


def aligned(candidates: DataFrame, alignments: DataFrame, key: Column) -> DataFrame:
    """The alignment of each candidate by alignment ``key`` (the last row counts), score key, or audio, phrase and language together, null for null (the first)."""
    shown = lambda f: F.coalesce(F.col(f), F.lit("None"))
    content = F.concat_ws("|", shown("pcm_sha256"), shown("wake_text"), shown("lang"))
    return matched_by(candidates, alignments, [("alignment", filled(key), True), ("score", filled(F.col("score_key")), False), ("pcm", content, False)])


def crop_evidence(crops: DataFrame, evidence: DataFrame) -> DataFrame:
    """The evidence row of each cut by its score key, candidate id or crop key, in that order; the last row that brings a key under any of them counts."""
    there = [f for f in ("score_key", "candidate_id", "crop_key") if f in crops.columns and f in evidence.columns]
    return matched_by(crops, evidence, [("key", filled(F.col(f)), True) for f in there])


# What a noise model's record may replace in the quality of a recording.
NOISE_FIELDS = "p_music p_overlap noise_class music_class speaker_count dnsmos_sig dnsmos_bak dnsmos_ovrl srmr drr t60 music_top_k instrument_top_k singing_top_k".split()


def with_noise_fields(quality: DataFrame, noise: DataFrame, key: str) -> DataFrame:
    """``quality`` with the NOISE_FIELDS of ``noise`` (one row per ``key``) laid over it where there is a record, nulls included; other fields stay."""
    laid = [f for f in NOISE_FIELDS if f in noise.columns]
    met = salted_left_join(quality, noise.select(key, F.lit(True).alias("_there"), *[F.col(f).alias(f"_n_{f}") for f in laid]), key, key, [])
    old = lambda f: F.col(f) if f in quality.columns else F.lit(None)
    return met.withColumns({f: F.when(F.col("_there"), F.col(f"_n_{f}")).otherwise(old(f)) for f in laid}).drop("_there", *[f"_n_{f}" for f in laid])


def rebound(refs: DataFrame, stored: DataFrame) -> DataFrame:
    """``refs`` that point to stored copies: where the audio (``pcm_sha256``, case doesn't count) is stored, ``source_wav`` is the copy and ``origin_wav`` the old place.

    ``stored`` has ``pcm_sha256, file_sha256, stored_path``; of several copies the first in name order counts. Others keep their source, with null ``origin_wav``.
    """
    known = stored.where(filled(F.col("pcm_sha256")).isNotNull() & F.col("stored_path").isNotNull()).groupBy(F.lower("pcm_sha256").alias("_pcm")).agg(F.min(F.struct("stored_path", "file_sha256")).alias("_at"))
    keyed = refs.withColumn("_pcm", F.lower(filled(F.col("pcm_sha256"))))
    met = salted_left_join(keyed, known, "_pcm", "candidate_id", heavy_keys(keyed, F.col("_pcm")))
    there = F.col("_at").isNotNull()
    return met.withColumns({"origin_wav": F.when(there, F.col("source_wav")), "source_wav": F.coalesce("_at.stored_path", "source_wav"), "file_sha256": F.col("_at.file_sha256"), "audio_cache_kind": F.when(there, "sep_pcm")}).drop("_pcm", "_at")


def binding_violations(joined: DataFrame) -> DataFrame:
    """Matches whose evidence names another audio, phrase or language, where both sides have one."""
    differ = lambda f: F.coalesce(filled(F.col(f)) != filled(F.col(f"ev_{f}")), F.lit(False))
    checks = {f"bad_{n}": differ(f) for n, f in (("pcm", "pcm_sha256"), ("wake", "wake_text"), ("lang", "lang"))}
    return joined.withColumns(checks).where("bad_pcm or bad_wake or bad_lang").select("row_id", "evidence_row", *checks)


def unmatched_keys(candidates: DataFrame, m: DataFrame) -> DataFrame:
    """Distinct score keys of candidates without evidence."""
    return candidates.where(F.col("score_key").isNotNull()).join(m.select("row_id"), "row_id", "left_anti").select("score_key").distinct()


def backfilled(rows: DataFrame, manifest: DataFrame, key: str, fields: list[str], row_id: str = "row_id") -> DataFrame:
    """``rows`` with null ``fields`` filled from ``manifest`` (one row per ``key``); hot keys are salted."""
    known = manifest.select(key, *[F.col(f).alias(f"_m_{f}") for f in fields])
    met = salted_left_join(rows, known, key, row_id, heavy_keys(rows, F.col(key)))
    return met.select(*[F.coalesce(c, f"_m_{c}").alias(c) if c in fields else F.col(c) for c in rows.columns])


def probability_contract(candidates: DataFrame, sidecar: DataFrame, accepted: str) -> DataFrame:
    """Per distinct score key the first fault of its probability evidence: ``missing, kind, hash, range`` or ``ok``."""
    keys = candidates.where(F.col("score_key").isNotNull()).groupBy("score_key").agg(F.min("row_id").alias("row_id"))
    first = sidecar.where(filled(F.col("score_key")).isNotNull()).groupBy("score_key").agg(F.min_by(F.struct("q_kw", "score_kind", "calibrator_hash"), "row_id").alias("e"))
    q = F.col("e.q_kw")
    fault = (
        F.when(F.col("e").isNull() | q.isNull() | F.isnan(q), "missing")
        .when(F.coalesce(F.col("e.score_kind") != "calibrated_qkw", F.lit(True)), "kind")
        .when(F.coalesce(F.col("e.calibrator_hash") != accepted, F.lit(True)), "hash")
        .when(~q.between(0, 1), "range")
    )
    return keys.join(first, "score_key", "left").select("score_key", F.coalesce(fault, F.lit("ok")).alias("state"))


def with_parents(c: DataFrame) -> DataFrame:
    """``c`` with what it gains on its raw parent: ``delta_cer, cos_se_raw, raw_parent_pcm_sha256, gain_ref``.

    All four are null without a parent or where one of both error rates is missing. ``cos_se_raw`` is the cosine of the columns ``embedding``, ``gain_ref`` the
    difference of ``speaker_ref_score``; a table without such a column has nulls. Parents that very many refer to are salted. ``gain_ref`` feeds the speaker gain of the selection.
    """
    fields = [f for f in ("cer_route", "pcm_sha256", "embedding", "speaker_ref_score") if f in c.columns]
    parents = c.select(F.col("candidate_id").alias("_parent"), *[F.col(f).alias(f"_p_{f}") for f in fields])
    mine = c.withColumn("_parent", filled(F.col("raw_parent_candidate_id")))
    joined = salted_left_join(mine, parents, "_parent", "candidate_id", heavy_keys(mine, F.col("_parent")))
    both = F.col("cer_route").isNotNull() & F.col("_p_cer_route").isNotNull()
    made = {
        "delta_cer": F.col("cer_route") - F.col("_p_cer_route"),
        "raw_parent_pcm_sha256": F.col("_p_pcm_sha256"),
        "cos_se_raw": cosine(F.col("embedding"), F.col("_p_embedding")) if "embedding" in fields else F.lit(None).cast("double"),
        "gain_ref": F.col("speaker_ref_score") - F.col("_p_speaker_ref_score") if "speaker_ref_score" in fields else F.lit(None).cast("double"),
    }
    return joined.withColumns({n: F.when(both, x) for n, x in made.items()}).drop("_parent", *[f"_p_{f}" for f in fields])


def parent_deltas(c: DataFrame) -> DataFrame:
    """Enhanced candidates with the change of error and likelihood against their raw parent; null without a parent."""
    parents = c.select(F.col("candidate_id").alias("parent_id"), F.col("cer_route").alias("p_cer"), F.col("nll").alias("p_nll"))
    mine = c.where(F.col("view") == "moss48k").withColumn("parent_id", filled(F.col("raw_parent_candidate_id")))
    joined = salted_left_join(mine, parents, "parent_id", "candidate_id", heavy_keys(mine, F.col("parent_id")))
    return joined.select("candidate_id", "content_class", (F.col("cer_route") - F.col("p_cer")).alias("delta_cer"), (F.col("nll") - F.col("p_nll")).alias("delta_nll"))


def expanded_views(raw: DataFrame) -> DataFrame:
    """Raw references and, for every one with audio, the reference of its enhanced view; one enhancement serves all that share the audio."""
    views = raw.where(filled(F.col("pcm_sha256")).isNotNull()).select(
        F.regexp_replace("candidate_id", "-raw-", "-moss48k-").alias("candidate_id"), "group_key", F.lit("moss48k").alias("view"), F.col("candidate_id").alias("parent_id"), F.col("pcm_sha256").alias("parent_pcm")
    )
    return raw.select("candidate_id", "group_key", "view").unionByName(views, allowMissingColumns=True)


def companions(selected: DataFrame, c: DataFrame) -> DataFrame:
    """For each selected raw candidate the enhanced view made from it, or from the same audio in its group.

    The either-or condition is two equi-joins; the rankable, then the least error, then the smallest id wins.
    """
    enhanced = c.where((F.col("view") == "moss48k") & F.col("source_wav").isNotNull())
    parents = c.select(F.col("candidate_id").alias("raw_parent_candidate_id"), F.col("pcm_sha256").alias("parent_pcm"))
    enhanced = salted_left_join(enhanced, parents, "raw_parent_candidate_id", "candidate_id", heavy_keys(enhanced, F.col("raw_parent_candidate_id")))
    own = selected.where(F.col("view") == "raw").select(F.col("candidate_id").alias("selected_id"), "group_key", F.col("pcm_sha256").alias("selected_pcm"))
    by_id = own.join(enhanced, (own.selected_id == enhanced.raw_parent_candidate_id) & (own.group_key == enhanced.group_key))
    by_pcm = own.join(enhanced, (own.selected_pcm == enhanced.parent_pcm) & (own.group_key == enhanced.group_key) & (own.selected_pcm != ""))
    order = F.struct(F.when((F.col("validity") == "rankable") & F.col("cer_route").isNotNull(), 0).otherwise(1).alias("a"), F.coalesce("cer_route", F.lit(float("inf"))).alias("b"), F.col("candidate_id").alias("c"))
    both = by_id.select("selected_id", "candidate_id", order.alias("o")).unionByName(by_pcm.select("selected_id", "candidate_id", order.alias("o")))
    return both.groupBy("selected_id").agg(F.min_by("candidate_id", "o").alias("companion_id"))


def classify_content(fatal: Column, coverage: Column, core: Column, extra: Column, hyp: Column, music: Column, speech: Column, overlap: Column) -> Column:
    """What a recording holds, from text and sound features; missing numbers count as 0."""
    cov, ext, mus, sp, ov = (F.coalesce(x, F.lit(0.0)) for x in (coverage, extra, music, speech, overlap))
    text = F.trim(F.coalesce(hyp, F.lit("")))
    return (
        F.when(fatal, "uncertain_or_hallucination")
        .when((cov >= 0.8) & core & (ext <= 0.35), F.when((ov >= 0.35) | (ext > 0.1), "target_plus_interference").otherwise("target_wake"))
        .when((mus >= 0.65) & (sp < 0.35), "noise_or_music")
        .when((sp >= 0.35) & (cov < 0.5) & (text != ""), "competing_speech")
        .when((text == "") | ((sp < 0.2) & (mus < 0.65)), "noise_or_music")
        .otherwise("uncertain_or_hallucination")
    )
