"""Scalar building blocks as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(value: Column) -> Column:
    """``value`` as a double; null where it is missing, not a number, NaN or infinite."""
    v = value.try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)


def first_filled(*columns: Column) -> Column:
    """The first value that is neither null nor blank."""
    return F.coalesce(*[F.when(F.trim(c) != "", c) for c in columns])


def content_hash(*parts: Column) -> Column:
    """SHA-256 of the compact JSON array of string parts; a null part is written as null."""
    return F.sha2(F.to_json(F.array(*[p.cast("string") for p in parts]), {"ignoreNullFields": "false"}), 256)


def spaced_content_hash(**fields: Column) -> Column:
    """SHA-256 of a JSON object with sorted keys and a blank after each colon and comma; null fields are written as null.

    String values go through to_json, numbers are written as they are.
    """
    def shown(c: Column) -> Column:
        quoted = F.regexp_extract(F.to_json(F.array(c.cast("string"))), r"(?s)^\[(.*)\]$", 1)
        return F.coalesce(F.when(F.typeof(c) == "string", quoted).otherwise(c.cast("string")), F.lit("null"))

    pairs = [F.concat(F.lit(f'"{k}": '), shown(c)) for k, c in sorted(fields.items())]
    return F.sha2(F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}")), 256)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays; null if a side is null or empty, the lengths differ, or a norm is at most 1e-12."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    na, nb = F.sqrt(dot(a, a)), F.sqrt(dot(b, b))
    return F.when((F.size(a) == F.size(b)) & (F.size(a) > 0) & (na > 1e-12) & (nb > 1e-12), dot(a, b) / (na * nb))


def natural_key(text: Column) -> Column:
    """A string whose order is that of ``text`` with digit runs of any length compared as numbers, without case: a number's length stands before it."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"\d+|\D+"), 0)
    number = lambda r: F.regexp_replace(r, "^0+(?=.)", "")
    keyed = F.transform(runs, lambda r: F.when(r.rlike(r"^\d"), F.concat(F.lpad(F.length(number(r)).cast("string"), 10, "0"), number(r))).otherwise(r))
    return F.array_join(keyed, "")


def slug(text: Column, most: int = 48) -> Column:
    """Letters, digits, ``._-`` of a text, other runs as one underscore, at most ``most`` characters."""
    clean = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^A-Za-z0-9_.-]+", "_")
    bare = F.regexp_replace(clean, r"^[._]+|[._]+$", "")
    return F.substring(F.when(bare == "", "empty").otherwise(bare), 1, most)


def duration_bucket(seconds: Column, width: float = 0.5) -> Column:
    """Number of the length bucket; null for missing or non-finite lengths."""
    return F.floor(finite(seconds) / F.lit(width))


def sigmoid(z: Column) -> Column:
    """1 / (1 + exp(-z)) without overflow at either end."""
    e = F.exp(-F.abs(z))
    return F.when(z >= 0, 1 / (1 + e)).otherwise(e / (1 + e))


def tag_strip(text: Column) -> Column:
    """``<...>`` tags become blanks, blank runs one blank, ends trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"<[^>]*>", " "), r"\s+", " "))
