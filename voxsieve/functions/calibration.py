"""Per-language logistic calibration of scores."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxsieve.functions.lineage import json_digest
from voxsieve.functions.scalars import finite, sigmoid


SCHEMA = "score_calibration/v1"


@dataclass(frozen=True)
class Model:
    mean: float
    scale: float
    slope: float
    intercept: float


class CalibrationError(ValueError):
    """The examples don't allow a fit."""


def class_statistics(rows: DataFrame, lang: str, score: str, label: str) -> DataFrame:
    """Per language the numbers of examples of each class, mean and population deviation of the finite scores."""
    d = rows.select(F.col(lang).alias("lang"), finite(F.col(score)).alias("x"), F.col(label).cast("int").alias("y")).where("x is not null and y in (0, 1)")
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") == 1).alias("n_positive"), F.count_if(F.col("y") == 0).alias("n_negative"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("scale"))


def fit_logistic(rows: DataFrame, lang: str, score: str, label: str, least_per_class: int = 20, penalty: float = 1e-4, steps: int = 100) -> dict[str, Model]:
    """Slope and intercept per language by Newton's method on z-scores; ``penalty`` holds for the slope only.

    Each step is one aggregation of five sums per language over the distributed examples, so their number doesn't
    matter; only languages x 5 numbers reach the driver. Without examples there are no models. Raises CalibrationError for a missing class or scores without spread.
    """
    stats = {r["lang"]: r for r in class_statistics(rows, lang, score, label).collect()}
    for name, r in stats.items():
        if min(r["n_positive"], r["n_negative"]) < max(1, least_per_class):
            raise CalibrationError(f"{name}: a class has fewer than {least_per_class} examples")
        if r["scale"] < 1e-8:
            raise CalibrationError(f"{name}: the scores have no spread")
    if not stats:
        return {}
    beta = dict.fromkeys(stats, (0.0, 0.0))
    d = rows.select(F.col(lang).alias("lang"), finite(F.col(score)).alias("x"), F.col(label).cast("double").alias("y")).where("x is not null and y in (0, 1)")
    pick = lambda values: F.coalesce(*[F.when(F.col("lang").eqNullSafe(F.lit(k)), F.lit(v)) for k, v in values.items()])
    d = d.withColumn("z", (F.col("x") - pick({k: r["mean"] for k, r in stats.items()})) / pick({k: r["scale"] for k, r in stats.items()})).select("lang", "z", "y").persist()
    active = set(stats)
    for _ in range(steps):
        if not active:
            break
        logit = pick({k: b[0] for k, b in beta.items()}) * F.col("z") + pick({k: b[1] for k, b in beta.items()})
        p = sigmoid(F.least(F.greatest(logit, F.lit(-35.0)), F.lit(35.0)))
        w = F.greatest(p * (1 - p), F.lit(1e-8))
        sums = d.groupBy("lang").agg(F.sum((p - F.col("y")) * F.col("z")).alias("ga"), F.sum(p - F.col("y")).alias("gb"), F.sum(w * F.col("z") ** 2).alias("haa"), F.sum(w * F.col("z")).alias("hab"), F.sum(w).alias("hbb")).collect()
        for r in sums:
            if r["lang"] not in active:
                continue
            a, b = beta[r["lang"]]
            ga, haa, hbb = r["ga"] + penalty * a, r["haa"] + penalty, r["hbb"] + 1e-10
            det = haa * hbb - r["hab"] ** 2
            da, db = (hbb * ga - r["hab"] * r["gb"]) / det, (haa * r["gb"] - r["hab"] * ga) / det
            beta[r["lang"]] = (a - da, b - db)
            if max(abs(da), abs(db)) < 1e-9:
                active.discard(r["lang"])
    d.unpersist()
    return {k: Model(stats[k]["mean"], stats[k]["scale"], *beta[k]) for k in stats}


def calibrated(score: Column, lang: Column, models: dict[str, Model]) -> Column:
    """The probability of each score by its language's model, else by that of ``global``; null without either or without a finite score."""
    x = finite(score)
    out = F.lit(None).cast("double")
    for name, m in sorted(models.items(), key=lambda kv: kv[0] != "global"):
        p = sigmoid(F.lit(m.slope) * (x - m.mean) / m.scale + m.intercept)
        out = p if name == "global" else F.when(lang == name, p).otherwise(out)
    return out


# Languages a calibration may be for, and the directions of a score.
CALIBRATED = ("zh", "en", "global")
DIRECTIONS = ("higher_is_better", "lower_is_better")


def to_document(models: dict[str, Model], source_digest: str, counts: dict[str, dict[str, int]] | None = None, score_direction: str = "higher_is_better") -> dict:
    """The models as a JSON document that carries the digest of its own content. ``counts``: per language the examples ``n, n_positive, n_negative``."""
    body = {"schema": SCHEMA, "score_direction": score_direction, "independent_dev_required": True, "source_sha256": source_digest, "models": {k: asdict(m) for k, m in sorted(models.items())}, "counts": counts or {}}
    return body | {"calibrator_hash": json_digest(body)}


def from_document(document: dict) -> dict[str, Model]:
    """The models of :func:`to_document`.

    Raises CalibrationError if the content was changed, isn't of this kind, isn't bound to an independent set of labelled examples, names another language, or
    has a scale that isn't positive or a class without examples.
    """
    body = {k: v for k, v in document.items() if k != "calibrator_hash"}
    if body.get("schema") != SCHEMA or body.get("independent_dev_required") is not True or not body.get("source_sha256") or body.get("score_direction") not in DIRECTIONS:
        raise CalibrationError("no calibration bound to labelled examples")
    if json_digest(body) != document.get("calibrator_hash"):
        raise CalibrationError("the document was changed after it was written")
    models = {k: Model(**m) for k, m in body["models"].items()}
    if not models or any(m.scale <= 0 for m in models.values()):
        raise CalibrationError("no models, or a scale that isn't positive")
    if any(k not in CALIBRATED for k in models) or any(min(c["n_positive"], c["n_negative"]) <= 0 for c in body["counts"].values()):
        raise CalibrationError("a language that can't be calibrated, or a class without examples")
    return models
