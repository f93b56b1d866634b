"""The whole way from candidates and evidence to decisions, report and package; and decisions anew from late evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxsieve.functions import text as tx
from voxsieve.operators import evidence as ev
from voxsieve.operators import reporting as rep
from voxsieve.operators import selection as sel
from voxsieve.policy import CLOSE, Policy
from voxsieve.session import settled
from voxsieve.sources import review
from voxsieve.sources.tables import table


def rescored(c: DataFrame, sidecar: DataFrame, accepted: str | None = None, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """Candidates ``c`` with text errors, content class and validity worked out from the ``sidecar``'s transcripts, and its likelihoods.

    A probability counts only if it is calibrated by the document with digest ``accepted``. Candidates without a transcript, or that can't be decoded, are ``fatal_invalid``.
    """
    fields = ["hyp", "nll", "q_kw", "score_kind", "calibrator_hash"]
    joined = ev.with_evidence(c, sidecar, fields).drop("cer_route", "extra_ratio", "nll", "q_kw", "qkw_calibrated", "validity", "content_class")
    d = tx.text_errors(joined, "ev_hyp", "wake_text", aliases)
    fatal = ~F.coalesce(F.col("decode_ok"), F.lit(False)) | F.col("ev_hyp").isNull()
    label = ev.classify_content(fatal, F.col("wake_coverage"), F.col("core_hit"), F.col("extra_ratio"), F.col("ev_hyp"), F.col("p_music"), F.col("speech_ratio"), F.col("p_overlap"))
    signed = (F.col("ev_score_kind") == "calibrated_qkw") & (F.col("ev_calibrator_hash") == F.lit(accepted)) & F.col("ev_q_kw").between(0, 1) & ~F.isnan("ev_q_kw")
    d = d.withColumns({"content_class": label, "qkw_calibrated": F.coalesce(signed, F.lit(False)), "nll": F.col("ev_nll"), "_fatal": fatal})
    d = d.withColumn("q_kw", F.when(F.col("qkw_calibrated"), F.col("ev_q_kw"))).withColumn("cer_route", F.when(~F.col("_fatal"), F.col("cer_route")))
    state = (
        F.when(F.col("_fatal"), "fatal_invalid")
        .when((F.col("lang") == "en") & ~F.col("core_hit"), "semantic_ineligible")
        .when((F.col("content_class") == "uncertain_or_hallucination") & (F.col("cer_route") > 0.5), "semantic_ineligible")
        .otherwise("rankable")
    )
    return d.withColumn("validity", state).drop("_fatal", *[f"ev_{f}" for f in fields])


def reselected(spark: SparkSession, root: str) -> DataFrame:
    """Decisions from the sidecar's transcripts alone."""
    c = settled(rescored(sel.candidates(table(spark, root, "scored_candidates")), table(spark, root, "sidecar")), "rescored")
    return sel.decisions(c, CLOSE).select("group_key", "reason_code", "selected_id", "selected_cer", "switched", "selection_mode")


def run(spark: SparkSession, scored: DataFrame, out: str, policy: Policy = CLOSE, sidecar: DataFrame | None = None, accepted: str | None = None, package: bool = False) -> dict:
    """Select from ``scored`` (or from its candidates scored anew by ``sidecar``), write decisions and listing under ``out``, with ``package`` also the recordings; returns the report.

    ``out`` gets the tables ``decisions`` and ``listing``, with ``package`` the folders ``review`` and, without failures, ``selected``.
    """
    c = sel.candidates(scored)
    c = settled(rescored(c, sidecar, accepted) if sidecar is not None else c, "candidates")
    hot = sel.heavy_keys(c, F.col("group_key"))
    sel.decisions(c, policy, hot).write.mode("overwrite").parquet(f"{out}/decisions")
    decisions = spark.read.parquet(f"{out}/decisions")
    review.listed(c, decisions, rep.group_orders(c), hot).write.mode("overwrite").parquet(f"{out}/listing")
    listing = spark.read.parquet(f"{out}/listing")
    base = sel.stage_winners(c.where("role = 's1' and view = 'raw'"), policy, hot=hot).select("group_key", F.col("winner.cer_route").alias("cer"))
    pairs = rep.paired(decisions.select("group_key", F.col("selected_cer").alias("cer")), base)
    report = {"policy": policy.digest(), "paired": rep.paired_summary(pairs).first().asDict(), "faults": rep.listing_faults(listing).first().asDict()}
    if package:
        report["review"] = review.write_review(listing, decisions, f"{out}/review")
        report["review_faults"] = [r.asDict() for r in review.review_faults(spark, f"{out}/review").collect()]
        if report["review"]["ok"]:
            won = listing.where("marker = 'SELECTED'").select("candidate_id", "group_key", "view", "pcm_sha256")
            review.write_selected(listing, ev.companions(won, c), f"{out}/selected", report["review"])
    review._put(f"{out}/report.json", report)
    return report


QUERIES = {"reselected": reselected}
ORACLES: dict[str, str] = {}
