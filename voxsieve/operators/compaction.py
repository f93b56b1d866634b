"""Few large files out of very many small ones, and the records that were delivered more than once."""

from __future__ import annotations

import hashlib
import io
import math
import posixpath
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxsieve.operators.skew import heavy_keys, salted_left_join
from voxsieve.session import scratch_path, settled
from voxsieve.sources.parquet_blocks import BlockWriter, IncompatibleBlocks, has_dictionary, read_footer, schema_of

AUDIT = "bin int, out_file string, n_files long, n_blocks long, n_blocks_out long, n_rows long, n_bytes long, n_apart long"
#: About the size of the blocks that small ones are joined to; a task holds one of them.
GROUP_BYTES = 32 << 20
#: Blocks in one output file; more go to a further file, so that footers stay small.
MOST_BLOCKS = 4096
#: Files up to this size whose blocks have dictionaries are encoded anew without, so that their blocks can be joined.
TINY_BYTES = 1 << 20
#: Files that one task joins; where bins would have more, there is a pass before.
TASK_FILES = 2000


class CompactionError(RuntimeError):
    """The written files don't hold what the source files hold."""


def _without_dictionaries(data: bytes) -> tuple[bytes, dict]:
    """A tiny Parquet file encoded anew without dictionaries, or as it is where that would change its schema or types; and its footer."""
    import pyarrow.parquet as pq

    footer = read_footer(io.BytesIO(data), len(data))
    if not any(has_dictionary(g) for g in footer[4][1][1]):
        return data, footer
    try:
        meta = pq.ParquetFile(io.BytesIO(data)).metadata
        codec = meta.row_group(0).column(0).compression.lower()
        out = io.BytesIO()
        pq.write_table(pq.ParquetFile(io.BytesIO(data)).read(), out, use_dictionary=False, compression="none" if codec == "uncompressed" else codec, row_group_size=max(1, meta.num_rows))
    except (ValueError, OSError, NotImplementedError):
        return data, footer
    new = read_footer(out, out.getbuffer().nbytes)
    return (out.getvalue(), new) if schema_of(new) == schema_of(footer) else (data, footer)


def _merge_bin(sources: list[tuple], target: str) -> list[tuple]:
    """Copy the blocks of ``sources`` (path, files and blocks it stands for, bytes; blocks null if not yet counted) into files under ``target``.

    One output per schema met and MOST_BLOCKS blocks, written aside and renamed.
    """
    import os

    from pyarrow import fs as pafs

    waiting, part, out = list(sources), 0, []
    while waiting:
        left, apart, sums = [], 0, [0, 0, 0]
        name = f"{target}-{part:03d}.parquet"
        where, path = pafs.FileSystem.from_uri(name)
        where.create_dir(posixpath.dirname(path), recursive=True)
        aside = f"{posixpath.dirname(path)}/_{posixpath.basename(path)}.{os.getpid()}-{os.urandom(4).hex()}"
        with where.open_output_stream(aside) as sink:
            writer = BlockWriter(sink, GROUP_BYTES)
            for i, (uri, files, blocks, given) in enumerate(waiting):
                if len(writer.groups) >= MOST_BLOCKS:
                    left += waiting[i:]
                    break
                src, p = pafs.FileSystem.from_uri(uri)
                size = src.get_file_info(p).size
                with src.open_input_file(p) as f:
                    data, footer = _without_dictionaries(f.read()) if size <= TINY_BYTES else (None, None)
                    try:
                        n, _ = writer.append(f, size) if data is None else writer.append(io.BytesIO(data), len(data), footer)
                    except IncompatibleBlocks:
                        if not sums[0]:  # it fits nowhere, not even alone
                            raise
                        left.append(waiting[i])
                        apart += 1
                        continue
                sums = [a + b for a, b in zip(sums, (files, n if blocks is None else blocks, given), strict=True)]
            writer.close()
        where.move(aside, path)  # a repeated or speculative task replaces the file by the same bytes
        out.append((name, sums[0], sums[1], len(writer.groups), writer.rows, sums[2], apart))
        waiting, part = left, part + 1
    return out


def _merged(listed: DataFrame, target: str, bins: int) -> DataFrame:
    """One pass: the files of ``listed`` (``path, n_files, n_blocks, n_bytes``) dealt to ``bins`` and joined; the audit, a table on disk."""

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        have: dict[int, list[tuple]] = {}
        for pdf in batches:
            for k, p, files, blocks, size in zip(*(pdf[c] for c in ("bin", "path", "n_files", "n_blocks", "n_bytes")), strict=True):
                have.setdefault(k, []).append((p, files, None if blocks < 0 else blocks, size))
        for k, sources in have.items():
            rows = [(k, *x) for x in _merge_bin(sorted(sources, key=lambda x: x[0]), f"{target}/part-{k:06d}")]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in AUDIT.split(", ")])

    dealt = listed.withColumn("bin", F.pmod(F.xxhash64("path"), F.lit(bins)).cast("int")).repartition(min(bins, 100_000), "bin")
    dealt.mapInPandas(merge, AUDIT).write.mode("overwrite").parquet(f"{target}/_audit")
    return listed.sparkSession.read.parquet(f"{target}/_audit")


def compact(spark: SparkSession, source: str, target: str, file_bytes: int = 256 << 20, listed: DataFrame | None = None, holds: DataFrame | None = None) -> DataFrame:
    """Join the Parquet files under ``source`` into files of about ``file_bytes`` each under ``target``.

    Encoded column blocks (row groups) are copied byte by byte and only footers are written anew, so no value is
    decoded. Small blocks without dictionaries become one block of up to GROUP_BYTES, their pages unchanged; only files up to TINY_BYTES with
    dictionaries, whose blocks could never be joined, are encoded anew first. Files are dealt to bins by a hash of their path; the number of bins follows from the total size. A
    bin's task reads its files one after the other and holds one block at a time, and the footer of at most MOST_BLOCKS blocks. If bins would have more than TASK_FILES files, a
    first pass joins so many a task, and a second one their results. Files with another schema go to an output
    of their own. ``listed`` (``path, length``) saves listing the folder. Afterwards schema, block counts and row totals are compared with what Spark reads on both sides
    (or with ``holds``, the rows the files were written from); a difference raises :class:`CompactionError`. Returns the audit, one row per written file; it is a table on disk.
    A source without files or rows gives an empty audit, nulls and repeated rows are copied as they are.
    """
    if listed is None:
        listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(source).select("path", "length")
    total = listed.agg(F.sum("length").alias("b"), F.count(F.lit(1)).alias("n")).first()
    if not total["n"]:
        return spark.createDataFrame([], AUDIT)
    bins = max(1, math.ceil(total["b"] / file_bytes))
    some = listed.select("path", F.lit(1).cast("long").alias("n_files"), F.lit(-1).cast("long").alias("n_blocks"), F.col("length").alias("n_bytes"))
    if total["n"] > bins * TASK_FILES:
        first = _merged(some, f"{target}/_first", math.ceil(total["n"] / TASK_FILES))
        some = first.select(F.col("out_file").alias("path"), "n_files", "n_blocks", "n_bytes")
    audit = _merged(some, target, bins)
    wrote = audit.agg(F.sum("n_files").alias("files"), F.sum("n_rows").alias("rows"), F.max("n_apart").alias("apart")).first()
    several = str(wrote["apart"] > 0).lower()  # more than one schema: compare what the files have together
    before = spark.read.option("mergeSchema", several).parquet(source) if holds is None else holds
    after = spark.read.option("mergeSchema", several).parquet(target)
    rows = (before.count(), after.count())
    if sorted(before.dtypes) != sorted(after.dtypes) or wrote["files"] != total["n"] or {wrote["rows"], *rows} != {rows[0]}:
        raise CompactionError(f"files {total['n']} and {wrote['files']}, rows {rows[0]} and {rows[1]} (footers: {wrote['rows']})")
    return audit


def scattered(rows: DataFrame, folder: str, manifest: str = "manifest_file") -> DataFrame:
    """``rows`` as they are delivered: a Parquet file for each value of ``manifest`` under ``folder``; returns the listing ``path, length``, a table on disk.

    A null manifest counts as ''. Manifests are sorted in their partition, so a task holds one at a time; a file is named by the digest of its manifest's name and
    written aside and renamed.
    """
    schema = rows.schema

    def write(batches: Iterator) -> Iterator:
        import os

        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyarrow import fs as pafs

        where, base = pafs.FileSystem.from_uri(folder)
        where.create_dir(base, recursive=True)

        def put(key: str, parts: list) -> tuple[str, int]:
            path = f"{base}/{hashlib.sha256(key.encode()).hexdigest()[:32]}.parquet"
            aside = f"{base}/_{os.urandom(8).hex()}"
            out = io.BytesIO()
            pq.write_table(pa.Table.from_batches(parts), out, use_dictionary=False)
            with where.open_output_stream(aside) as f:
                f.write(out.getbuffer())
            where.move(aside, path)
            return f"{folder}/{path.rsplit('/', 1)[1]}", out.getbuffer().nbytes

        done, now, held = [], None, []
        for batch in batches:
            keys = batch.column("_manifest")
            batch = batch.drop_columns("_manifest")
            ends = pc.run_end_encode(keys)
            at = 0
            for key, end in zip(ends.values.to_pylist(), ends.run_ends.to_pylist(), strict=True):
                if held and key != now:
                    done.append(put(now, held))
                    held = []
                now = key
                held.append(batch.slice(at, end - at))
                at = end
        if held:
            done.append(put(now, held))
        yield pa.RecordBatch.from_pydict({"path": [p for p, _ in done], "length": pa.array([n for _, n in done], pa.int64())})

    keyed = rows.select(F.coalesce(F.col(manifest), F.lit("")).alias("_manifest"), *schema.names)
    return settled(keyed.repartition("_manifest").sortWithinPartitions("_manifest").mapInArrow(write, "path string, length long"), "manifests")


def absolute_path(uri: Column) -> Column:
    """The absolute path a URI or path names: no scheme or authority, no empty or ``.`` segment; case is kept."""
    bare = F.regexp_replace(uri, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    parts = F.filter(F.split(bare, "/"), lambda s: (s != "") & (s != "."))
    return F.concat(F.lit("/"), F.array_join(parts, "/"))


def record_key(source: Column, digest: Column) -> Column:
    """One string for a record's identity; null if a part of it is null, so such rows repeat nothing."""
    return F.concat(F.lower(digest), F.lit(" "), absolute_path(source))


def redelivered(rows: DataFrame, row_id: str = "row_id", source: str = "source_wav", digest: str = "pcm_sha256", hot: list | None = None) -> DataFrame:
    """Rows whose record a row with a smaller id delivers too: ``row_id, first_row_id``.

    The first row per record comes from an aggregation with partial results before the shuffle. Only records with
    more than one row are looked up again, with hot records salted. Rows with a null path or digest are never
    repeats; equal ids count once.
    """
    named = rows.where(F.col(source).isNotNull() & F.col(digest).isNotNull())
    keyed = named.select(F.col(row_id).alias("row_id"), record_key(F.col(source), F.col(digest)).alias("key"))
    firsts = keyed.groupBy("key").agg(F.min("row_id").alias("first_row_id"), F.max("row_id").alias("_last")).where("_last > first_row_id").drop("_last")
    if hot is None:
        hot = heavy_keys(keyed, F.col("key"))
    met = salted_left_join(keyed, firsts, "key", "row_id", hot)
    return met.where("row_id > first_row_id").select("row_id", "first_row_id")


def compacted_rows(spark: SparkSession, source: str, file_bytes: int = 256 << 20) -> tuple[DataFrame, DataFrame]:
    """The rows of the consolidated copy of ``source`` in the shared folder, and the copy's audit."""
    target = scratch_path(spark, "compacted")
    audit = compact(spark, source, target, file_bytes)
    if not audit.take(1):
        return spark.read.parquet(source), audit
    several = audit.where("n_apart > 0").limit(1).count() > 0
    return spark.read.option("mergeSchema", str(several).lower()).parquet(target), audit


def exactly_once(rows: DataFrame, row_id: str = "row_id", source: str = "source_wav", digest: str = "pcm_sha256") -> DataFrame:
    """The consolidated rows without redeliveries: of each record the row with the smallest id; rows without identity stay."""
    again = redelivered(rows, row_id, source, digest).select(F.col("row_id").alias("_again"))
    return rows.join(again, F.col(row_id) == F.col("_again"), "left_anti")


def manifest_layout(rows: DataFrame, manifest: str = "manifest_file", size: str = "record_bytes", file_bytes: int = 256 << 20) -> DataFrame:
    """Which of the few new files takes each small manifest file: ``manifest_file, n_records, n_bytes, target_file``.

    Manifests are dealt by a hash of their name to as many targets as the total size needs. Rows without a manifest count as one
    manifest '' and unknown sizes as 0.
    """
    each = rows.groupBy(F.coalesce(F.col(manifest), F.lit("")).alias("manifest_file")).agg(F.count(F.lit(1)).alias("n_records"), F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("n_bytes"))
    bins = each.agg(F.greatest(F.lit(1), F.ceil(F.sum("n_bytes") / F.lit(file_bytes))).alias("bins"))
    return each.join(F.broadcast(bins)).withColumn("target_file", F.pmod(F.xxhash64("manifest_file"), F.col("bins")).cast("int")).drop("bins")


def written_once(rows: DataFrame, folder: str, size: str = "record_bytes", file_bytes: int = 256 << 20) -> DataFrame:
    """Write the records of ``rows``, each exactly once, into as few files under ``folder`` as their size needs; one row ``n_rows, n_bytes, n_files`` read back from there.

    Records are dealt to files by the hash of all their columns. Raises CompactionError if the files hold another number of records.
    An empty table gives no rows and no files.
    """
    kept = settled(exactly_once(rows), "exactly-once")
    total = kept.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    files = max(1, math.ceil(total["b"] / file_bytes))
    kept.repartition(files, *kept.columns).write.mode("overwrite").parquet(folder)
    back = rows.sparkSession.read.parquet(folder)
    found = back.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("n_bytes"), F.count_distinct(F.col("_metadata.file_path")).alias("n_files"))
    if found.first()["n_rows"] != total["n"]:
        raise CompactionError(f"{total['n']} records to write, {found.first()['n_rows']} written")
    return found


def joined_bytes(blobs: list[bytes]) -> bytes:
    """The Parquet file that holds the blocks of the Parquet files ``blobs``, in order."""
    out = io.BytesIO()
    writer = BlockWriter(out)
    for b in blobs:
        writer.append(io.BytesIO(b), len(b))
    writer.close()
    return out.getvalue()
