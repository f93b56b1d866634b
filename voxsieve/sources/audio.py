"""Audio folders: arm indexes, recordings by stream, matrices of log-probabilities, and a content-addressed store."""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxsieve.functions.signal import decode_wav, pcm_digest

# Folders beside the arms that hold no arm.
NO_ARMS = ["meta", "reports", "best_sep", "packs", "review_flat"]


def read_arms(spark: SparkSession, root: str, split: str) -> DataFrame:
    """Lines of ``{root}/{split}/{stage}/index.jsonl`` and ``.../{stage}/thr_*/index.jsonl`` with ``split``, ``arm`` (stage or stage/thr) and ``body``.

    Hidden folders and those of NO_ARMS are passed over. Raises ValueError if the split has no arm.
    """
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "index.jsonl").text(f"{root}/{split}")
    arm = F.regexp_extract(F.col("_metadata.file_path"), rf"/{split}/([^/]+(?:/thr_[^/]+)?)/index\.jsonl$", 1)
    d = lines.select(F.lit(split).alias("split"), arm.alias("arm"), F.col("value").alias("body")).where("arm <> '' and trim(body) <> ''")
    found = d.where(~F.col("arm").startswith(".") & ~F.split("arm", "/")[0].isin(NO_ARMS))
    if not found.take(1):
        raise ValueError(f"no index.jsonl below {root}/{split}")
    return found


def made_before(spark: SparkSession, root: str) -> DataFrame:
    """``pcm_sha256, path`` of recordings whose name is a digest of at least 32 hexadecimal digits, wherever they lie below ``root``; of several the first in name order.

    File contents aren't read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.wav").load(root).select("path")
    stem = F.lower(F.regexp_extract("path", r"([^/]+)\.wav$", 1))
    return files.select(stem.alias("pcm_sha256"), "path").where(F.col("pcm_sha256").rlike("^[0-9a-f]{32,}$")).groupBy("pcm_sha256").agg(F.min("path").alias("path"))


def recordings(spark: SparkSession, root: str, content: bool = False) -> DataFrame:
    """``arm_dir, uid, stream, path`` of ``.../wav/{uid}_{tag}.wav``; of the tags ``peak`` and ``original``, one stream, peak comes first.

    File contents are only read with ``content``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.wav").load(root)
    name = lambda i: F.regexp_extract("path", r"^(.*)/wav/(.+)_([^_/]+)\.wav$", i)
    d = files.select(name(1).alias("arm_dir"), name(2).alias("uid"), name(3).alias("tag"), "path", *(["content"] if content else [])).where("uid <> ''")
    d = d.withColumn("stream", F.when(F.col("tag").isin("peak", "original"), "original").otherwise(F.col("tag")))
    kept = F.struct("path", *(["content"] if content else []))
    return d.groupBy("arm_dir", "uid", "stream").agg(F.min_by(kept, F.when(F.col("tag") == "peak", 0).otherwise(1)).alias("r")).select("arm_dir", "uid", "stream", "r.*")


def read_matrices(spark: SparkSession, path: str) -> DataFrame:
    """``path, log_probs`` of .npy files and of the entry ``log_probs`` of .npz files; null where there is no two-dimensional matrix."""

    @F.pandas_udf("array<array<double>>")
    def load(contents: pd.Series) -> pd.Series:
        def one(data: bytes) -> list | None:
            try:
                x = np.load(io.BytesIO(data), allow_pickle=False)
                x = x["log_probs"] if isinstance(x, np.lib.npyio.NpzFile) else x
                return x.astype(np.float64).tolist() if x.ndim == 2 else None
            except (ValueError, KeyError, OSError, EOFError):
                return None

        return contents.map(one)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.np[yz]").load(path)
    return files.select("path", load("content").alias("log_probs"))


def store_by_content(files: DataFrame, store: str) -> DataFrame:
    """Put recordings (``path, content``) under ``{store}/{first two}/{digest}.wav``; returns the manifest.

    The digest is that of the samples at 16 kHz. A file that is there already is checked and left (``hit``), else written aside and
    renamed (``fresh``), so that a repeated task changes nothing; unreadable recordings are ``undecodable``.
    """
    schema = "source_path string, pcm_sha256 string, file_sha256 string, stored_path string, status string"

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os
        import wave

        from pyarrow import fs as pafs

        where, base = pafs.FileSystem.from_uri(store)
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                data = bytes(content)
                try:
                    digest = pcm_digest(*decode_wav(data))
                except (ValueError, EOFError, wave.Error):
                    rows.append((path, None, None, None, "undecodable"))
                    continue
                target, state = f"{base}/{digest[:2]}/{digest}.wav", "fresh"
                if where.get_file_info(target).type == pafs.FileType.File:
                    with where.open_input_stream(target) as f:
                        held = f.read()
                    if pcm_digest(*decode_wav(held)) == digest:
                        data, state = held, "hit"
                if state == "fresh":
                    where.create_dir(f"{base}/{digest[:2]}", recursive=True)
                    aside = f"{target}.{os.urandom(6).hex()}"
                    with where.open_output_stream(aside) as f:
                        f.write(data)
                    where.move(aside, target)
                rows.append((path, digest, hashlib.sha256(data).hexdigest(), target, state))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    return files.select("path", "content").mapInPandas(put, schema)
