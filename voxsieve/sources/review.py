"""Packages for review: every candidate's recording under a name that sorts, a document of reasons per group, an index and a summary; and their validation.

Nothing is gathered per group: files are written row by row where the rows lie, the index is a folder of JSON lines in order, and a reasons document holds the
decision and counts, not the group's candidates.
"""

from __future__ import annotations

import hashlib
import json
import os
import posixpath
import shutil
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxsieve.functions.signal import decode_wav, pcm_digest
from voxsieve.operators.skew import heavy_keys, salted_left_join
from voxsieve.session import settled
from voxsieve.sources.jsonl import write_jsonl

INDEX, SUMMARY, REASONS = "_index", "_summary.json", "9000__REASONS.json"


class Collision(RuntimeError):
    """A file of that name with other bytes is there already."""


class NotWritten(RuntimeError):
    """A package may not be written: groups failed, or files couldn't be read."""


def _open(path: str):  # noqa: ANN202
    from pyarrow import fs as pafs

    return pafs.FileSystem.from_uri(path)


def _digest(where, path: str) -> str:  # noqa: ANN001
    with where.open_input_stream(path) as f:
        h = hashlib.sha256()
        while chunk := f.read(1 << 20):
            h.update(chunk)
    return h.hexdigest()


def link_or_copy(source: str, target: str) -> str:
    """Put the file ``source`` at ``target``: 'existing' if the same bytes are there, else 'hardlink' where both lie on one disk, else 'copy'.

    Copies are written aside and renamed. Raises Collision if other bytes are there.
    """
    from pyarrow import fs as pafs

    (src, a), (dst, b) = _open(source), _open(target)
    dst.create_dir(posixpath.dirname(b), recursive=True)
    if dst.get_file_info(b).type == pafs.FileType.File:
        if _digest(src, a) != _digest(dst, b):
            raise Collision(target)
        return "existing"
    if isinstance(src, pafs.LocalFileSystem) and isinstance(dst, pafs.LocalFileSystem):
        try:
            os.link(a, b)
            return "hardlink"
        except FileExistsError:  # another attempt of the same task
            return link_or_copy(source, target)
        except OSError:
            pass
    aside = f"{posixpath.dirname(b)}/_{os.urandom(6).hex()}"
    with src.open_input_stream(a) as f, dst.open_output_stream(aside) as g:
        shutil.copyfileobj(f, g)
    dst.move(aside, b)
    return "copy"


def _put(path: str, value: dict) -> None:
    where, p = _open(path)
    where.create_dir(posixpath.dirname(p), recursive=True)
    aside = f"{posixpath.dirname(p)}/_{os.urandom(6).hex()}"
    with where.open_output_stream(aside) as f:
        f.write((json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True, default=str) + "\n").encode())
    where.move(aside, p)


def _placed(rows: DataFrame, name: str, source: str) -> DataFrame:
    """``rows`` with ``mode``: how the file named by column ``name`` (a full path) came from ``source``; 'placeholder' (a small document) without one, 'unreadable' if it can't be read."""
    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes) + ", mode string"

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            modes = []
            for target, origin, ident in zip(pdf[name], pdf[source], pdf["candidate_id"], strict=True):
                try:
                    if origin is None:
                        _put(f"{target}.json", {"candidate_id": ident, "why": "no recording"})
                        modes.append("placeholder")
                    else:
                        modes.append(link_or_copy(origin, f"{target}.wav"))
                except FileNotFoundError:
                    modes.append("unreadable")
            yield pdf.assign(mode=modes)

    return rows.mapInPandas(work, schema)


def write_review(listing: DataFrame, decisions: DataFrame, folder: str, details: dict | None = None) -> dict:
    """Write the package of all candidates to ``folder`` and return its summary.

    ``listing`` has a row per candidate with ``candidate_id, group_key, group_order, split, uid, role, view, stream, marker, slot, name, source_wav, pcm_sha256,
    cer_route``, ``decisions`` one per group with ``group_key, reason_code, selected_id, trace``. Candidates marked FAILED get a placeholder document. Writing again
    changes nothing; other bytes under a name raise Collision. Groups without a selection, and recordings that can't be read, are failures in the summary.
    """
    targets = listing.withColumns({"_target": F.concat(F.lit(f"{folder}/"), "name"), "_source": F.when(F.col("marker") != "FAILED", F.col("source_wav"))})
    placed = settled(_placed(targets, "_target", "_source").drop("_target", "_source"), "placed")
    order = ["group_order", "slot", "name"]
    write_jsonl(placed.repartitionByRange(*order).sortWithinPartitions(*order), f"{folder}/{INDEX}", "overwrite")
    firsts = placed.groupBy("group_key").agg(
        *[F.min(c).alias(c) for c in ("group_order", "split", "uid")], F.count(F.lit(1)).alias("n_candidates"), F.min(F.when(F.col("marker") == "SELECTED", F.col("name"))).alias("selected_name"),
        F.min(F.regexp_extract("name", r"^([^_]+__[^_]+)__", 1)).alias("prefix"),
    )
    groups = settled(firsts.join(decisions.select("group_key", "reason_code", "selected_id", "trace"), "group_key", "left"), "groups")

    def reasons(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.to_dict("records"):
                _put(f"{folder}/{r['prefix']}__{REASONS}", r)
            yield pdf[["group_key"]]

    groups.mapInPandas(reasons, "group_key string").agg(F.count(F.lit(1))).collect()
    sums = placed.agg(*[F.count_if(F.col("mode") == m).alias(m) for m in ("hardlink", "copy", "existing", "placeholder", "unreadable")], F.count(F.lit(1)).alias("n_candidates")).first().asDict()
    by_reason = {r["reason_code"] or "none": r["n"] for r in groups.groupBy("reason_code").agg(F.count(F.lit(1)).alias("n")).collect()}
    failed = groups.where("selected_name is null")
    summary = sums | {"n_groups": sum(by_reason.values()), "reasons": by_reason, "n_failures": failed.count() + sums["unreadable"], "failed_groups": [r[0] for r in failed.select("group_key").orderBy("group_key").limit(100).collect()], "details": details or {}}
    summary["ok"] = not summary["n_failures"]
    _put(f"{folder}/{SUMMARY}", summary)
    return summary


def write_selected(listing: DataFrame, companions: DataFrame, folder: str, summary: dict) -> DataFrame:
    """Write the selected recordings alone, as ``{split}/{uid}.wav``, with the enhanced companion of a raw one beside as ``{uid}__se.wav``; the index, a table in ``folder``.

    ``companions`` has ``selected_id, companion_id``. What lies in ``folder`` is removed first. Raises NotWritten if the package's ``summary`` has failures.
    """
    if summary["n_failures"]:
        raise NotWritten(f"{summary['n_failures']} failures")
    where, path = _open(folder)
    from pyarrow import fs as pafs

    if where.get_file_info(path).type == pafs.FileType.Directory:
        where.delete_dir(path)
    chosen = listing.where("marker = 'SELECTED'").select("candidate_id", "split", "uid", "role", "view", "stream", "cer_route", "pcm_sha256", "source_wav")
    stem = F.concat(F.lit(f"{folder}/"), "split", F.lit("/"), "uid")
    main = chosen.withColumns({"dest": stem, "is_companion": F.lit(False)})
    beside = chosen.join(companions, F.col("candidate_id") == F.col("selected_id")).select(F.col("companion_id"), "split", "uid")
    sources = listing.select(F.col("candidate_id").alias("companion_id"), *[c for c in chosen.columns if c not in ("candidate_id", "split", "uid")])
    beside = beside.join(sources, "companion_id").withColumnRenamed("companion_id", "candidate_id").select(*chosen.columns).withColumns({"dest": F.concat(stem, F.lit("__se")), "is_companion": F.lit(True)})
    written = settled(_placed(main.unionByName(beside), "dest", "source_wav"), "selected")
    lost = written.where("mode in ('unreadable', 'placeholder')").count()
    write_jsonl(written.withColumn("dest", F.concat("dest", F.lit(".wav"))), f"{folder}/{INDEX}")
    if lost:
        raise NotWritten(f"{lost} recordings can't be read")
    return written


def review_faults(spark: SparkSession, folder: str, expected: DataFrame | None = None) -> DataFrame:
    """``fault, n, example``: what is wrong with a written package; no rows if nothing is.

    Every group has exactly one selected recording, first by name, and one document of reasons; every recording of the index is there, once, and has the samples whose
    digest the index names; no file is there that isn't in the index; group orders have no gaps; each (split, uid) of ``expected`` has a group; the summary reports no failures.
    """
    where, path = _open(folder)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(folder)

    @F.pandas_udf("string")
    def samples(contents: pd.Series) -> pd.Series:
        def one(data: bytes) -> str:
            try:
                return pcm_digest(*decode_wav(bytes(data)))
            except Exception:  # noqa: BLE001  anything unreadable is a fault
                return "unreadable"

        return contents.map(one)

    heard = settled(files.select(F.regexp_extract("path", r"([^/]+)\.wav$", 1).alias("name"), samples("content").alias("heard")), "heard")
    index = spark.read.schema("candidate_id string, group_key string, group_order long, split string, uid string, marker string, slot long, name string, pcm_sha256 string, mode string").json(f"{folder}/{INDEX}")
    audio = index.where("mode <> 'placeholder'")
    met = audio.join(heard, "name", "full_outer")
    per_group = index.groupBy("group_key").agg(
        F.count_if(F.col("marker") == "SELECTED").alias("chosen"), F.min_by("marker", "name").alias("first"), F.min("group_order").alias("order"), F.min(F.regexp_extract("name", r"^([^_]+__[^_]+)__", 1)).alias("prefix"), F.min("split").alias("split"), F.min("uid").alias("uid")
    )
    documents = spark.read.format("binaryFile").option("pathGlobFilter", f"*{REASONS}").load(folder).select(F.regexp_extract("path", r"([^/]+?)__9000__", 1).alias("prefix"))
    documented = per_group.join(documents.groupBy("prefix").agg(F.count(F.lit(1)).alias("n_documents")), "prefix", "left")
    found = [
        ("no recording", met.where("heard is null").select("name")),
        ("not in the index", met.where("candidate_id is null").select("name")),
        ("other samples", met.where("heard <> pcm_sha256").select("name")),
        ("name twice", index.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name")),
        ("not one selected", per_group.where("chosen <> 1").select(F.col("group_key").alias("name"))),
        ("selected isn't first", per_group.where("chosen = 1 and first <> 'SELECTED'").select(F.col("group_key").alias("name"))),
        ("not one document of reasons", documented.where("coalesce(n_documents, 0) <> 1").select(F.col("group_key").alias("name"))),
        ("gap in the orders", per_group.agg((F.max("order") - F.count_distinct("order")).alias("gap")).where("gap <> 0").select(F.col("gap").cast("string").alias("name"))),
    ]
    if expected is not None:
        found.append(("no group", expected.select("split", "uid").distinct().join(per_group.select("split", "uid").distinct(), ["split", "uid"], "left_anti").select(F.concat_ws("/", "split", "uid").alias("name"))))
    with where.open_input_stream(f"{path}/{SUMMARY}") as f:
        failures = json.loads(f.read())["n_failures"]
    out = spark.createDataFrame([("failures reported", failures, SUMMARY)] if failures else [], "fault string, n long, example string")
    for fault, rows in found:
        out = out.unionByName(rows.agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("example")).where("n > 0").select(F.lit(fault).alias("fault"), "n", "example"))
    return out


def listed(candidates: DataFrame, decisions: DataFrame, orders: DataFrame, hot: list | None = None) -> DataFrame:
    """The listing of :func:`write_review`: candidates with their group's order and decision, marker, slot and name; large groups are salted."""
    from voxsieve.operators import reporting as rep

    hot = heavy_keys(candidates, F.col("group_key")) if hot is None else hot
    is_it = F.coalesce(F.col("candidate_id") == F.col("selected_id"), F.lit(False))
    d = salted_left_join(candidates, decisions.select("group_key", "selected_id").join(orders, "group_key"), "group_key", "candidate_id", hot)
    d = d.withColumn("marker", F.when(is_it, "SELECTED").when(F.coalesce("decode_ok", F.lit(False)), "REJECTED").otherwise("FAILED"))
    d = d.withColumn("slot", F.when(F.col("marker") == "FAILED", rep.failed_slots()).otherwise(rep.slots(is_it)))
    return d.withColumn("name", rep.file_names(F.col("group_order"), F.col("slot"), F.col("marker")))
