"""JSON lines: strict reading with file and text in the error, sorted-key writing, decoder transcripts, one-document files."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class BadLine(ValueError):
    """A line that is no JSON object."""


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """Rows of JSON-lines files with ``schema``; blank lines are skipped.

    With ``strict`` a line that is no JSON object, or doesn't fit the schema, stops the query with its file and text (files are read in pieces, which don't know
    the numbers of their lines); otherwise such lines are left out. Field order and extra fields don't matter.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file")).where(F.trim("value") != "")
    shape = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    parsed = lines.select("value", "_file", F.from_json("value", T.StructType([*shape.fields, T.StructField("_bad", T.StringType())]), {"columnNameOfCorruptRecord": "_bad"}).alias("r"))
    wrong = F.col("r").isNull() | F.col("r._bad").isNotNull() | ~F.ltrim("value").startswith("{")
    if strict:
        parsed = parsed.withColumn("r", F.when(wrong, F.raise_error(F.concat(F.col("_file"), F.lit(": not a JSON object: "), F.substring("value", 1, 200))).cast(parsed.schema["r"].dataType)).otherwise(F.col("r")))
    else:
        parsed = parsed.where(~wrong)
    return parsed.select(*[F.col(f"r.{f.name}").alias(f.name) for f in shape.fields])


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object a line, keys in alphabetic order, other scripts unescaped, nulls written."""
    df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value")).write.mode(mode).text(path)


def read_document(path: str) -> dict:
    """A file with one JSON object."""
    value = json.loads(Path(path).read_text(encoding="utf-8"))
    if not isinstance(value, dict):
        raise BadLine(f"{path}: not a JSON object")
    return value


def write_document(path: str, value: dict) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n", encoding="utf-8")


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """``key, text`` of decoder output: each line a JSON object with key and text, or ``key text``. A key's last line in its file counts; of several files the last in name order."""
    lines = spark.read.text(path).select(F.trim("value").alias("v"), F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("n")).where("v <> ''")
    j = F.from_json("v", "key string, text string, hyp string")
    is_json = F.col("v").startswith("{") & F.col("j.key").isNotNull()
    d = lines.withColumn("j", j).select("f", "b", "n", F.when(is_json, F.col("j.key")).otherwise(F.regexp_extract("v", r"^(\S+)", 1)).alias("key"), F.when(is_json, F.coalesce("j.text", "j.hyp", F.lit(""))).otherwise(F.regexp_extract("v", r"^\S+\s+(.*)$", 1)).alias("text"))
    return d.groupBy("key").agg(F.max_by("text", F.struct("f", "b", "n")).alias("text"))
