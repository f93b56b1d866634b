"""Cutting spans around aligned occurrences."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxsieve.functions.lineage import json_digest
from voxsieve.functions.scalars import finite, spaced_content_hash

# Seconds kept before and after an occurrence, by name of the cut.
PADS = {"keyword_tight": (0.08, 0.12), "keyword_normal": (0.16, 0.24), "keyword_wide": (0.30, 0.40), "speaker_ctx": (0.50, 0.60)}


@dataclass(frozen=True)
class CropPolicy:
    min_duration_sec: float = 0.12
    max_duration_sec: float | None = None
    several: bool = False


def valid_occurrences(occ: DataFrame) -> DataFrame:
    """Occurrences (``source, start_sec, end_sec, valid, n_samples, sample_rate``) that lie inside their recording and aren't marked invalid."""
    start, end = finite(F.col("start_sec")), finite(F.col("end_sec"))
    length = F.col("n_samples") / F.greatest(F.col("sample_rate"), F.lit(1))
    fit = (start >= 0) & (end > start) & (end <= length + 1e-6)
    return occ.where(F.coalesce(F.col("valid"), F.lit(True)) & fit).withColumns({"start_sec": start, "end_sec": end})


def crop_specs(occ: DataFrame, policy: CropPolicy = CropPolicy(), pads: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """The cuts of each source: ``source, view, start_sample, end_sample, boundary_clamped``.

    A source with several valid occurrences is ambiguous and gives none unless ``several``; then the best target score, and of these the shortest, counts.
    Sample positions are rounded half to even and kept inside the recording; cuts that are too short or too long fall out.
    """
    ok = valid_occurrences(occ)
    order = F.struct(-F.coalesce(finite(F.col("target_score")), F.lit(0.0)), F.col("end_sec") - F.col("start_sec"), F.col("start_sec"))
    ranked = ok.groupBy("source").agg(F.count(F.lit(1)).alias("_n"), F.min_by(F.struct("start_sec", "end_sec", "sample_rate", "n_samples"), order).alias("o")).select("source", "_n", "o.*")
    if not policy.several:
        ranked = ranked.where("_n = 1")
    table = F.array(*[F.struct(F.lit(k).alias("view"), F.lit(a).alias("left"), F.lit(b).alias("right")) for k, (a, b) in (pads or PADS).items()])
    d = ranked.withColumn("p", F.explode(table))
    start = F.greatest(F.lit(0), F.rint((F.col("start_sec") - F.col("p.left")) * F.col("sample_rate")).cast("long"))
    end = F.least(F.col("n_samples").cast("long"), F.rint((F.col("end_sec") + F.col("p.right")) * F.col("sample_rate")).cast("long"))
    d = d.select("source", "sample_rate", "n_samples", F.col("p.view").alias("view"), start.alias("start_sample"), end.alias("end_sample"))
    seconds = (F.col("end_sample") - F.col("start_sample")) / F.greatest(F.col("sample_rate"), F.lit(1))
    d = d.where((F.col("end_sample") > F.col("start_sample")) & (seconds >= policy.min_duration_sec))
    if policy.max_duration_sec is not None:
        d = d.where(seconds <= policy.max_duration_sec)
    return d.select("source", "view", "start_sample", "end_sample", ((F.col("start_sample") == 0) | (F.col("end_sample") == F.col("n_samples"))).alias("boundary_clamped"))


def alignment_key(aligner: Column, model: Column, runtime: Column, aliases: Column, normaliser: Column) -> Column:
    """Digest of what an alignment depends on, for rows with ``pcm_sha256, wake_text, lang``."""
    return spaced_content_hash(pcm_sha256=F.col("pcm_sha256"), wake_text=F.col("wake_text"), lang=F.col("lang"), alias_set_hash=aliases, text_normalizer_hash=normaliser, aligner=aligner, model_hash=model, runtime_hash=runtime)


def crop_policy_digest(policy: dict) -> str:
    """SHA-256 of a cutting policy as compact JSON with sorted keys."""
    return json_digest(policy)


def crop_key(alignment: Column, policy_digest: Column, sample_rate: Column, fade_ms: float = 0) -> Column:
    """Digest that names a cut, for rows with ``start_sample, end_sample``."""
    whole = lambda c: c.cast("bigint")
    return spaced_content_hash(alignment_key=alignment, crop_policy_hash=policy_digest, start_sample=whole(F.col("start_sample")), end_sample=whole(F.col("end_sample")), sample_rate=whole(sample_rate), fade_ms=F.lit(fade_ms))


def cut_samples(samples: Column, start: Column, end: Column) -> Column:
    """The samples of a cut from an ``array<float>``."""
    return F.slice(samples, start.cast("int") + 1, (end - start).cast("int"))


def best_crops(scored: DataFrame, keys: list[str], cer: str = "cer_route", ident: str = "candidate_id") -> DataFrame:
    """Per group the rankable cut with the least error, ties by id."""
    ok = scored.where((F.col("validity") == "rankable") & finite(F.col(cer)).isNotNull())
    return ok.groupBy(*keys).agg(F.min_by(ident, F.struct(cer, ident)).alias("selected_id"), F.min(cer).alias("selected_cer"))
