import io

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from voxsieve.operators import compaction as cp
from voxsieve.sources.parquet_blocks import BlockWriter, IncompatibleBlocks, read_footer


def sample(n, start=0):
    return pa.table(
        {
            "row_id": pa.array(range(start, start + n), pa.int64()), "pcm_sha256": [None if i % 9 == 0 else f"{i % 5:064X}" for i in range(start, start + n)], "source_wav": [f"/data//a/./{i % 5}.wav" if i % 2 else f"file:///data/a/{i % 5}.wav" for i in range(start, start + n)],
            "nested": [{"a": [1, None, i]} if i % 3 else None for i in range(start, start + n)], "t": pa.array([i * 1_000 for i in range(start, start + n)], pa.timestamp("us")), "blob": [b"\0" * (i % 4) for i in range(start, start + n)], "flag": [bool(i % 2) for i in range(start, start + n)],
        }
    )


def encoded(table, **options):
    out = io.BytesIO()
    pq.write_table(table, out, **options)
    return out.getvalue()


def test_blocks_are_copied_byte_by_byte():
    parts = [sample(7, 7 * i) for i in range(12)]
    blobs = [encoded(p, compression=["snappy", "zstd", "none"][i % 3], write_page_index=i % 2 == 0, use_dictionary=i % 4 != 0, data_page_version="2.0" if i % 5 == 0 else "1.0", row_group_size=3) for i, p in enumerate(parts)]
    joined = cp.joined_bytes(blobs)
    assert pq.read_table(io.BytesIO(joined)).equals(pa.concat_tables(parts))
    meta = pq.ParquetFile(io.BytesIO(joined)).metadata
    assert meta.num_row_groups == 12 * 3 and meta.num_rows == 84
    # a block's bytes are found unchanged in the joined file
    first = pq.ParquetFile(io.BytesIO(blobs[3])).metadata.row_group(0).column(0)
    at = first.dictionary_page_offset or first.data_page_offset
    assert blobs[3][at : at + first.total_compressed_size] in joined


def test_empty_files_and_other_schemas():
    assert pq.read_table(io.BytesIO(cp.joined_bytes([encoded(sample(3).slice(0, 0)), encoded(sample(3)), encoded(sample(3).slice(0, 0))]))).num_rows == 3
    w = BlockWriter(io.BytesIO())
    a, b = encoded(sample(2)), encoded(sample(2).drop(["flag"]))
    w.append(io.BytesIO(a), len(a))
    with pytest.raises(IncompatibleBlocks):
        w.append(io.BytesIO(b), len(b))
    with pytest.raises(ValueError):
        read_footer(io.BytesIO(b"no parquet at all"), 17)


def test_a_folder_of_tiny_files(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    for i in range(60):
        (tmp_path / "in" / ("sub" if i % 2 else ".") / f"{i:03d}.parquet").write_bytes(encoded(sample(5, 5 * i)))
    source = f"file://{tmp_path}/in"
    spark.conf.set("spark.sql.files.ignoreMissingFiles", "false")
    df = spark.read.option("recursiveFileLookup", "true").parquet(source)
    with pytest.raises(cp.CompactionError):  # a plain read of the folder doesn't see files in subfolders
        cp.compact(spark, source, f"file://{tmp_path}/bad", 30_000)
    for p in (tmp_path / "in" / "sub").iterdir():
        p.rename(tmp_path / "in" / p.name)
    audit = cp.compact(spark, source, f"file://{tmp_path}/out", 30_000).toPandas()
    assert audit.n_files.sum() == 60 and audit.n_rows.sum() == 300 and audit.n_blocks.sum() == 60 and 2 <= len(audit) < 20
    back = spark.read.parquet(f"file://{tmp_path}/out")
    key = lambda d: sorted(map(str, d.toPandas().to_dict("records")))
    assert key(back) == key(spark.read.parquet(source)) and df is not None


def test_files_of_two_schemas(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(10):
        (tmp_path / "in" / f"{i}.parquet").write_bytes(encoded(sample(5, 5 * i) if i % 2 else sample(5, 5 * i).drop(["flag"])))
    audit = cp.compact(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out").toPandas()
    assert sorted(audit.n_files) == [5, 5] and audit.n_rows.sum() == 50
    rows = spark.read.option("mergeSchema", "true").parquet(f"file://{tmp_path}/out")
    assert rows.count() == 50 and rows.where("flag is null").count() == 25


def test_small_blocks_become_one():
    parts = [sample(7, 7 * i) for i in range(30)]
    plain = [encoded(p, use_dictionary=False, compression=["snappy", "zstd"][i % 10 == 9], data_page_version="2.0" if i % 5 == 0 else "1.0", row_group_size=3) for i, p in enumerate(parts)]
    out = io.BytesIO()
    w = BlockWriter(out, group_bytes=1 << 20)
    for b in plain:
        w.append(io.BytesIO(b), len(b))
    w.close()
    assert pq.read_table(io.BytesIO(out.getvalue())).equals(pa.concat_tables(parts))
    assert pq.ParquetFile(io.BytesIO(out.getvalue())).metadata.num_row_groups == 6  # a change of codec begins a block
    out = io.BytesIO()
    w = BlockWriter(out, group_bytes=1500)
    for b in (plain[0], encoded(parts[1]), plain[2], plain[3], encoded(parts[4].slice(0, 0), use_dictionary=False)):
        w.append(io.BytesIO(b), len(b))
    w.close()
    assert pq.read_table(io.BytesIO(out.getvalue())).equals(pa.concat_tables([parts[i] for i in (0, 1, 2, 3)]))


def test_tiny_files_with_dictionaries(spark, tmp_path, monkeypatch):
    data = encoded(sample(50))
    plain, _ = cp._without_dictionaries(data)
    assert plain != data and pq.read_table(io.BytesIO(plain)).equals(sample(50)) and cp._without_dictionaries(plain)[0] == plain
    (tmp_path / "in").mkdir()
    for i in range(40):
        (tmp_path / "in" / f"{i:03d}.parquet").write_bytes(encoded(sample(5, 5 * i)))
    audit = cp.compact(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out").toPandas()
    assert audit.n_blocks.sum() == 40 and audit.n_blocks_out.sum() == 1
    monkeypatch.setattr(cp, "TINY_BYTES", 0)  # blocks with dictionaries are copied as they are, a bounded number to a file
    monkeypatch.setattr(cp, "MOST_BLOCKS", 15)
    rows = cp._merge_bin([(f"file://{tmp_path}/in/{i:03d}.parquet", 1, None, 0) for i in range(40)], f"file://{tmp_path}/parts/p")
    assert [(r[1], r[3]) for r in rows] == [(15, 15), (15, 15), (10, 10)]
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == spark.read.parquet(f"file://{tmp_path}/parts").count() == 200


def test_two_passes(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    for i in range(90):
        part = sample(5, 5 * i)
        (tmp_path / "in" / f"{i:03d}.parquet").write_bytes(encoded(part if i % 9 else part.drop(["flag"]), use_dictionary=i % 2 == 0))
    monkeypatch.setattr(cp, "TASK_FILES", 10)
    audit = cp.compact(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out").toPandas()
    assert (audit.n_files.sum(), audit.n_blocks.sum(), audit.n_rows.sum(), len(audit), audit.n_blocks_out.sum()) == (90, 90, 450, 2, 2)
    back = spark.read.option("mergeSchema", "true").parquet(f"file://{tmp_path}/out")
    assert sorted(r.row_id for r in back.collect()) == list(range(450)) and back.where("flag is null").count() == 50


def test_scattered_manifests_come_back(spark, tmp_path):
    rows = spark.createDataFrame([(i, None if i % 50 == 0 else f"m{i % 37 if i % 3 else 0}", f"t{i}") for i in range(900)], "row_id long, manifest_file string, t string")
    listed = cp.scattered(rows, f"file://{tmp_path}/tiny")
    assert listed.count() == len(list((tmp_path / "tiny").iterdir())) == 38
    audit = cp.compact(spark, f"file://{tmp_path}/tiny", f"file://{tmp_path}/few", listed=listed).toPandas()
    assert (audit.n_files.sum(), len(audit), audit.n_rows.sum(), audit.n_blocks_out.sum()) == (38, 1, 900, 1)
    back = spark.read.parquet(f"file://{tmp_path}/few")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    assert cp.scattered(rows.limit(0), f"file://{tmp_path}/none").count() == 0


def test_records_are_written_once(spark, tmp_path):
    rows = [(i, f"/d/{i % 40}.wav", f"AB{i % 40}" if i % 2 else f"ab{i % 40}", 100) for i in range(200)] + [(900, None, "ab", 100), (901, None, "ab", None)]
    df = spark.createDataFrame(rows, "row_id long, source_wav string, pcm_sha256 string, record_bytes int")
    got = cp.written_once(df, f"file://{tmp_path}/once", file_bytes=1500).first()
    assert (got.n_rows, got.n_bytes, got.n_files) == (42, 4100, 3)
    none = cp.written_once(df.limit(0), f"file://{tmp_path}/no").first()
    assert (none.n_rows, none.n_bytes) == (0, 0)


def test_redeliveries(spark):
    rows = [(1, "/d/a.wav", "AB"), (2, "file:///d/a.wav", "ab"), (3, "/d//./a.wav", "aB"), (4, "/d/A.wav", "ab"), (5, None, "ab"), (6, None, "ab"), (7, "/d/a.wav", None), (8, "/d/a.wav", "cd"), (9, "s3://b/d/a.wav", "cd"), (1, "/d/a.wav", "AB")]
    df = spark.createDataFrame(rows, "row_id long, source_wav string, pcm_sha256 string").withColumn("key", F.lit("clash"))
    for hot in ([], ["ab /d/a.wav"]):
        got = sorted((r.row_id, r.first_row_id) for r in cp.redelivered(df, hot=hot).collect())
        assert got == [(2, 1), (3, 1), (9, 8)]
    kept = sorted(r.row_id for r in cp.exactly_once(df).collect())
    assert kept == [1, 1, 4, 5, 6, 7, 8]
    assert cp.redelivered(df.limit(0)).count() == 0


def test_layout_keeps_every_manifest_once(spark):
    df = spark.createDataFrame(pd.DataFrame({"manifest_file": [f"m{i // 3}" for i in range(300)], "record_bytes": [400] * 300}))
    got = cp.manifest_layout(df, file_bytes=20_000).toPandas()
    assert len(got) == 100 and got.n_records.sum() == 300 and got.n_bytes.sum() == 120_000 and got.target_file.nunique() == 6
