"""Queries p4 and p5: references to absent records, and far too many small files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxsieve.operators import compaction, orphans
from voxsieve.sources.tables import table


def _orphans(spark: SparkSession, root: str) -> DataFrame:
    scored, sidecar = table(spark, root, "scored_candidates"), table(spark, root, "sidecar")
    refs = orphans.references(scored, "scored_candidates", "row_id", "raw_parent_candidate_id", "candidate_id", "loaded_at")
    refs = refs.unionByName(orphans.references(sidecar, "sidecar", "row_id", "score_key", "score_key", "written_at"))
    return orphans.orphans(refs, orphans.parent_intervals(scored, ["candidate_id", "score_key"]))


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return _orphans(spark, root).select("table_name", "row_id", "kind")


def p4_report(spark: SparkSession, root: str) -> DataFrame:
    return orphans.orphan_report(_orphans(spark, root))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    rows, _ = compaction.compacted_rows(spark, f"{root}/sep_audio_cache_manifest.parquet")
    return compaction.redelivered(rows).select("row_id")


def p5_records(spark: SparkSession, root: str) -> DataFrame:
    rows, _ = compaction.compacted_rows(spark, f"{root}/sep_audio_cache_manifest.parquet")
    return compaction.exactly_once(rows)


def p5_files(spark: SparkSession, root: str) -> DataFrame:
    """The manifests written as the tiny files they came in, and these consolidated by copying their blocks."""
    tiny = compaction.scratch_path(spark, "tiny-files")
    rows = table(spark, root, "sep_audio_cache_manifest")
    audit = compaction.compact(spark, tiny, compaction.scratch_path(spark, "compacted"), listed=compaction.scattered(rows, tiny), holds=rows)
    return audit.agg(F.sum("n_files").alias("files_in"), F.count(F.lit(1)).alias("files_out"), F.sum("n_blocks").alias("blocks_in"), F.sum("n_rows").alias("n_rows"))


def p5_layout(spark: SparkSession, root: str) -> DataFrame:
    return compaction.manifest_layout(table(spark, root, "sep_audio_cache_manifest"))


def p5_written(spark: SparkSession, root: str) -> DataFrame:
    """The consolidated records, each exactly once, written to few files: what these hold."""
    rows, _ = compaction.compacted_rows(spark, f"{root}/sep_audio_cache_manifest.parquet")
    return compaction.written_once(rows, compaction.scratch_path(spark, "written-once"))


QUERIES = {f.__name__: f for f in (p4_found, p4_report, p5_found, p5_records, p5_files, p5_layout, p5_written)}

_P4 = """
WITH refs AS (
  SELECT 'scored_candidates' AS table_name, row_id, 'c:' || raw_parent_candidate_id AS k, loaded_at AS own
  FROM scored_candidates WHERE raw_parent_candidate_id <> ''
  UNION ALL SELECT 'sidecar', row_id, 's:' || score_key, written_at FROM sidecar WHERE score_key <> ''),
parents AS (
  SELECT k, bool_or(deleted_at IS NULL) AS live, min(loaded_at) FILTER (WHERE deleted_at IS NULL) AS since
  FROM (SELECT 'c:' || candidate_id AS k, loaded_at, deleted_at FROM scored_candidates
        UNION ALL SELECT 's:' || score_key, loaded_at, deleted_at FROM scored_candidates WHERE score_key IS NOT NULL) GROUP BY k),
found AS (
  SELECT table_name, row_id, own, CASE WHEN live IS NULL THEN 'missing' WHEN NOT live THEN 'deleted' WHEN since > own THEN 'late' END AS kind
  FROM refs LEFT JOIN parents USING (k))
"""
_P5 = r"""
WITH keyed AS (
  SELECT *, lower(pcm_sha256) || ' /' || array_to_string(list_filter(string_split(regexp_replace(source_wav, '^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?', ''), '/'), lambda s: s <> '' AND s <> '.'), '/') AS k
  FROM sep_audio_cache_manifest),
ranked AS (SELECT *, CASE WHEN k IS NULL THEN 1 ELSE row_number() OVER (PARTITION BY k ORDER BY row_id) END AS nth FROM keyed)
"""
ORACLES = {
    "p4_found": _P4 + "SELECT table_name, row_id, kind FROM found WHERE kind IS NOT NULL",
    "p4_report": _P4 + "SELECT table_name, coalesce(strftime(own, '%Y-%m'), 'unknown') AS month, kind, count(*) AS n_rows FROM found WHERE kind IS NOT NULL GROUP BY ALL",
    "p5_found": _P5 + "SELECT row_id FROM ranked WHERE nth > 1",
    "p5_records": _P5 + "SELECT * EXCLUDE (k, nth) FROM ranked WHERE nth = 1",
    # the tables' manifests, about 3 KB each, make one file
    "p5_files": "SELECT count(DISTINCT coalesce(manifest_file, '')) AS files_in, 1 AS files_out, count(DISTINCT coalesce(manifest_file, '')) AS blocks_in, count(*) AS n_rows FROM sep_audio_cache_manifest",
    "p5_written": _P5 + "SELECT count(*) AS n_rows, coalesce(sum(record_bytes), 0)::BIGINT AS n_bytes, greatest(1, ceil(coalesce(sum(record_bytes), 0) / 268435456))::BIGINT AS n_files FROM ranked WHERE nth = 1",
}
