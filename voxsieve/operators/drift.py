"""Schemas that drift between files: a catalogue of field lifespans, every change, and one consistent table.

A *footer* here is what one file says about one field: presence, JSON type, number of values. All work on whole
history happens on footers, a small fraction of the rows; values are only looked at where a field may have been renamed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxsieve.operators.ordered import neighbours, numbered
from voxsieve.session import settled

# The spellings under which a canonical field is known, in order of preference, and its type.
ALIASES = {
    "uid": (["uid", "UID", "id", "utt_id"], "string"),
    "candidate_id": (["candidate_id", "candidateId", "cand"], "string"),
    "wake_text": (["wake_text", "wakeText", "Wake_Text", "wake", "唤醒文本", "phrase", "target"], "string"),
    "lang": (["lang", "Lang", "language", "locale"], "string"),
    "arm": (["arm", "stage"], "string"),
    "streams": (["streams", "stream_list", "tracks"], "string"),
    "hyp": (["hyp", "HYP", "result", "transcript", "asr_text"], "string"),
    "score_key": (["score_key", "scoreKey", "sk"], "string"),
    "nll": (["nll", "neg_log", "target_nll"], "double"),
    "q_kw": (["q_kw", "qkw", "p_keyword"], "double"),
    "score_kind": (["score_kind", "kind"], "string"),
    "calibrator_hash": (["calibrator_hash", "calibratorHash", "qkw_calibrator_hash", "calib.sha", "cal_digest"], "string"),
    "decode_ok": (["decode_ok"], "boolean"),
    "token_count": (["token_count"], "long"),
    "dur_sec": (["dur_sec"], "double"),
}
# A spelling that stands for another canonical field in each family.
FAMILY_ALIASES = {("index", "text"): "wake_text", ("sidecar", "text"): "hyp"}
FAMILY_FIELDS = {
    "index": ["uid", "wake_text", "lang", "arm", "streams", "decode_ok", "token_count", "dur_sec"],
    "sidecar": ["candidate_id", "score_key", "wake_text", "lang", "hyp", "nll", "q_kw", "score_kind", "calibrator_hash", "decode_ok", "token_count", "dur_sec"],
}


def alias_rows() -> list[tuple[str, str, int, str]]:
    """(spelling, canonical field, preference, type) for the cast generator and renames without content."""
    return [(s, name, i, kind) for name, (spellings, kind) in ALIASES.items() for i, s in enumerate(spellings)]


def readable(lines: DataFrame, body: str = "body") -> DataFrame:
    """The lines whose body is one JSON object, parsed to the variant ``doc``; others are left out.

    The body is parsed inside brackets, so that anything after the object makes the line unreadable. With doubled keys the last one counts.
    """
    spark = lines.sparkSession
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    text = F.trim(F.regexp_replace(F.col(body), r"^[\s\x{FEFF}]+|\s+$", ""))
    whole = F.when(text.startswith("{") & text.endswith("}"), F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))))
    # exploding an array of one keeps the optimiser from parsing once per use
    parsed = lines.withColumn("_all", F.explode(F.array(whole))).where("_all is not null and variant_get(_all, '$[1]') is null")
    return parsed.withColumn("doc", F.variant_get("_all", "$[0]", "variant")).where("schema_of_variant(doc) like 'OBJECT%'").drop("_all")


def _with_content(cells: DataFrame, value: str) -> DataFrame:
    """``content``: a value as text, whatever its JSON type: wrappers, quotes and blanks are dropped, numbers brought to one form.

    Taken in steps, as each step's column is used several times in the next and would be worked out once per use.
    """
    bare = lambda c: F.translate(c, '[]{}":, \t\n\r', "")
    nested = F.col("_json").startswith("{") | F.col("_json").startswith("[")
    leaves = F.when(nested, bare(F.regexp_replace("_json", r'"(?:\\.|[^"\\])*"\s*:', ""))).otherwise(F.lit(""))
    numeric = F.substring("_text", 1, 1).between("-", "9") & F.col("_text").rlike(r"^-?\d{1,15}(\.\d+)?([eE][-+]?\d{1,2})?$")
    d = cells.withColumn("_json", F.to_json(value)).withColumn("_leaves", leaves)
    d = d.withColumn("_text", F.when(F.col("_leaves") != "", F.col("_leaves")).otherwise(bare(F.col("_json"))))
    return d.withColumn("content", F.when(numeric, F.col("_text").try_cast("double").cast("string")).otherwise(F.col("_text"))).drop("_json", "_leaves", "_text")


def fields(lines: DataFrame, feed: str, at: str, file: str, line: str) -> DataFrame:
    """One row per line and top-level key: ``feed, at, file, line, field, kind, content``; kind and content are null for a null value."""
    spark = lines.sparkSession
    docs = readable(lines).select(F.col(feed).alias("feed"), F.col(at).alias("at"), F.col(file).alias("file"), F.col(line).alias("line"), "doc")
    each = spark.sql("SELECT d.feed, d.at, d.file, d.line, x.key AS field, x.value AS value FROM {d} AS d, LATERAL variant_explode(d.doc) AS x", d=docs)
    shape = F.schema_of_variant("value")
    kind = (
        F.when(shape.startswith("OBJECT"), "object")
        .when(shape.startswith("ARRAY"), "array")
        .when(shape == "BOOLEAN", "boolean")
        .when(shape == "STRING", "string")
        .when(shape != "VOID", "number")
    )
    each = _with_content(each.withColumn("kind", kind), "value")
    return each.select("feed", "at", "file", "line", "field", "kind", F.when(F.col("kind").isNotNull(), F.col("content")).alias("content"))


def catalogue(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files, footers): the numbered files of each feed, and per file and field ``kind, n_lines, n_values``.

    Files are ordered by time, then name. A file without a readable line has no footer and isn't a version of the schema. Values of several types in one file
    give one kind that names them all in alphabetic order.
    """
    per_file = cells.groupBy("feed", "at", "file", "field").agg(
        F.array_join(F.array_sort(F.collect_set("kind")), "|").alias("kind"), F.count(F.lit(1)).alias("n_lines"), F.count("kind").alias("n_values")
    )
    per_file = settled(per_file, "footers")
    files = settled(numbered(per_file.select("feed", "at", "file").distinct(), ["feed"], "at", ["file"], "no"), "files")
    footers = per_file.join(files, ["feed", "at", "file"]).withColumn("kind", F.when(F.col("kind") != "", F.col("kind")))
    return files, footers.select("feed", "no", "field", "kind", "n_lines", "n_values")


def lifespans(footers: DataFrame) -> DataFrame:
    """The unbroken spans of each (feed, field, type): ``feed, field, kind, first_no, last_no, n_files, n_values, retyped, next_no``.

    An island starts where the field was not in the file before or had another type (``retyped``); files where all its values are null belong to the island they lie in.
    ``next_no`` is the next file after the island that has the field.
    """
    seen = neighbours(footers, ["feed", "field"], "no", "kind")
    absent, other = F.coalesce(F.col("prev_no") != F.col("no") - 1, F.lit(True)), F.coalesce(F.col("last_kind") != F.col("kind"), F.lit(False))
    marked = seen.select("feed", "field", "no", "kind", "n_values", "next_no", (other & ~absent).alias("retyped"), F.when(absent | other, F.col("no")).alias("start"))
    islands = neighbours(marked, ["feed", "field"], "no", "start").withColumn("first_no", F.coalesce("start", "last_start"))
    ends = islands.groupBy("feed", "field", "first_no").agg(F.max("kind").alias("kind"), F.max("no").alias("last_no"), F.count(F.lit(1)).alias("n_files"), F.sum("n_values").alias("n_values"), F.max("retyped").alias("retyped"), F.max_by("next_no", "no").alias("next_no"))
    return ends.select("feed", "field", F.coalesce("kind", F.lit("null")).alias("kind"), "first_no", "last_no", "n_files", "n_values", "retyped", "next_no")


def _renames(cells: DataFrame, files: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """Of ``pairs`` (feed, no, old, new), those where the content goes on: the lines of both files are matched, then values compared.

    Two lines match if they share contents that are unique in either file, whatever key these stand under. A pair holds if at
    least ``least`` of the matched lines that have both values agree; one field goes to one field, best share first. Where no
    matched line has both values, the alias table decides.
    """
    at = pairs.select("feed", "no").distinct()
    near = at.select("feed", "no", F.explode(F.array("no", F.col("no") - 1)).alias("at_no"))
    numbered_cells = cells.where("content is not null and content <> ''").join(files, ["feed", "at", "file"]).select("feed", F.col("no").alias("at_no"), "line", "field", "content")
    local = settled(numbered_cells.join(near, ["feed", "at_no"]).withColumn("is_new", F.col("at_no") == F.col("no")), "local")
    unique = local.groupBy("feed", "no", "is_new", "content").agg(F.count_distinct("line").alias("n"), F.first("line").alias("line")).where("n = 1")
    a = unique.where("not is_new").select("feed", "no", "content", F.col("line").alias("old_line"))
    b = unique.where("is_new").select("feed", "no", "content", F.col("line").alias("new_line"))
    votes = a.join(b, ["feed", "no", "content"]).groupBy("feed", "no", "old_line", "new_line").agg(F.count(F.lit(1)).alias("votes"))
    best = Window.partitionBy("feed", "no", "old_line").orderBy(F.desc("votes"), "new_line")
    linked = votes.withColumn("r", F.row_number().over(best)).where("r = 1").select("feed", "no", "old_line", "new_line", "votes")
    back = Window.partitionBy("feed", "no", "new_line").orderBy(F.desc("votes"), "old_line")
    linked = settled(linked.withColumn("r", F.row_number().over(back)).where("r = 1").select("feed", "no", "old_line", "new_line"), "linked")
    x = local.where("not is_new").select("feed", "no", F.col("line").alias("old_line"), F.col("field").alias("old"), F.col("content").alias("x"))
    y = local.where("is_new").select("feed", "no", F.col("line").alias("new_line"), F.col("field").alias("new"), F.col("content").alias("y"))
    seen = pairs.join(x, ["feed", "no", "old"]).join(linked, ["feed", "no", "old_line"]).join(y, ["feed", "no", "new", "new_line"])
    agree = seen.groupBy("feed", "no", "old", "new").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("x") == F.col("y")).alias("same"))
    scored = pairs.join(agree, ["feed", "no", "old", "new"], "left")
    spark = cells.sparkSession
    names = F.broadcast(spark.createDataFrame([(s, c) for s, c, _, _ in alias_rows()], "spelling string, canon string"))
    for side in ("old", "new"):
        scored = scored.join(names.withColumnsRenamed({"spelling": side, "canon": f"{side}_canon"}), side, "left")
    share = F.coalesce(F.col("same") / F.col("n"), F.when(F.col("old_canon") == F.col("new_canon"), F.lit(1.0)).otherwise(F.lit(0.0)))
    scored = scored.withColumns({"share": share, "known": F.coalesce(F.col("old_canon") == F.col("new_canon"), F.lit(False)), "n": F.coalesce("n", F.lit(0))}).where(F.col("share") >= least)
    for side in ("old", "new"):
        w = Window.partitionBy("feed", "no", side).orderBy(F.desc("share"), F.desc("known"), F.desc("n"), "old", "new")
        scored = scored.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")
    return scored.select("feed", "no", "old", "new", "share", "n")


def _history(cells: DataFrame, rename_share: float) -> tuple[DataFrame, ...]:
    """(files, footers, spans, new, gone, renamed): numbered files, their footers, the catalogue of lifespans, starts and ends of fields in it, and the renames among these."""
    files, footers = catalogue(cells)
    spans = settled(lifespans(footers), "lifespans")
    new = spans.where("first_no > 1 and not retyped").select("feed", F.col("first_no").alias("no"), F.col("field").alias("new"))
    ended = spans.where("next_no is null or next_no > last_no + 1").select("feed", (F.col("last_no") + 1).alias("no"), F.col("field").alias("old"))
    gone = settled(ended.join(files.select("feed", "no"), ["feed", "no"], "left_semi"), "gone")
    renamed = settled(_renames(cells, files, settled(gone.join(new, ["feed", "no"]), "pairs"), rename_share), "renamed")
    return files, footers, spans, new, gone, renamed


def changes(cells: DataFrame, rename_share: float = 0.6) -> DataFrame:
    """Every change and the file that brought it: ``feed_id, file_name, change, old_field, new_field``.

    Starts and ends come from the catalogue of lifespans; an end and a start in the same file are a
    rename if the content goes on (see :func:`_renames`), an island begun by another type a change of type, which is compared with the last file that had values. Empty and unreadable lines, and empty tables, give no rows. ``cells`` is
    read several times: pass a materialised table.
    """
    files, _, spans, new, gone, renamed = _history(cells, rename_share)
    event = lambda d, change, old, new_field: d.select("feed", "no", F.lit(change).alias("change"), old.alias("old_field"), new_field.alias("new_field"))
    retyped = spans.where("retyped").select("feed", F.col("first_no").alias("no"), "field")
    out = event(retyped, "retyped", F.col("field"), F.col("field"))
    out = out.unionByName(event(renamed, "renamed", F.col("old"), F.col("new")))
    out = out.unionByName(event(gone.join(renamed, ["feed", "no", "old"], "left_anti"), "removed", F.col("old"), F.lit("")))
    out = out.unionByName(event(new.join(renamed, ["feed", "no", "new"], "left_anti"), "added", F.lit(""), F.col("new")))
    return out.join(files, ["feed", "no"]).select(F.col("feed").alias("feed_id"), F.col("file").alias("file_name"), "change", "old_field", "new_field")


def materialised_cells(lines: DataFrame) -> DataFrame:
    """The exploded fields of raw lines as a table in the shared folder."""
    return settled(fields(lines, "feed_id", "written_at", "file_name", "line_id"), "cells")


def spellings_of(family: str) -> dict[str, str]:
    """Spelling to canonical field of a family, by the alias table."""
    known = {s: name for name in FAMILY_FIELDS[family] for s in ALIASES[name][0]}
    return known | {s: name for (fam, s), name in FAMILY_ALIASES.items() if fam == family}


def renamed_spellings(cells: DataFrame, family: str, rename_share: float = 0.6) -> DataFrame:
    """``feed, at, file, canon, field``: fields outside the alias table that a chain of renames links to a canonical field, in the files of that unbroken span only.

    A span that renames link to several canonical fields is left out; of two spans for one field in a file the first in alphabetic order counts.
    """
    files, footers, _, _, _, renamed = _history(cells, rename_share)
    seen = neighbours(footers, ["feed", "field"], "no", "kind")
    known = list(spellings_of(family))
    edges = renamed.select("feed", "no", "old", "new").where(~F.col("old").isin(known) | ~F.col("new").isin(known))
    marked = seen.select("feed", "field", "no", F.when(F.col("prev_no").isNull() | (F.col("prev_no") < F.col("no") - 1), F.col("no")).alias("start"))
    spans = neighbours(marked, ["feed", "field"], "no", "start").select("feed", "field", "no", F.coalesce("start", "last_start").alias("start"))
    before = spans.select("feed", (F.col("no") + 1).alias("no"), F.col("field").alias("old"), F.col("start").alias("old_start"))
    edges = edges.join(before, ["feed", "no", "old"])
    step = lambda a, a_start, b, b_start: edges.select("feed", F.col(a).alias("field"), F.col(a_start).alias("start"), F.col(b).alias("to"), F.col(b_start).alias("to_start"))
    steps = settled(step("old", "old_start", "new", "no").unionByName(step("new", "no", "old", "old_start")).where(~F.col("to").isin(known)), "rename-steps")
    names = cells.sparkSession.createDataFrame(list(spellings_of(family).items()), "field string, canon string")
    reached = lambda d: d.select("feed", F.col("to").alias("field"), F.col("to_start").alias("start"), "canon").distinct()
    latest = linked = settled(reached(steps.join(F.broadcast(names), "field")), "renamed-fields")
    while latest.take(1):
        latest = settled(reached(steps.join(latest, ["feed", "field", "start"])).join(linked, ["feed", "field", "start", "canon"], "left_anti"), "renamed-fields")
        linked = linked.unionByName(latest)
    sure = linked.groupBy("feed", "field", "start").agg(F.min("canon").alias("canon"), F.count_distinct("canon").alias("n")).where("n = 1")
    return spans.join(sure, ["feed", "field", "start"]).join(files, ["feed", "no"]).groupBy("feed", "at", "file", "canon").agg(F.min("field").alias("field"))


def cast_of(v: Column, name: str) -> Column:
    """The generated cast of a variant to canonical field ``name``: unwrapped and cast; null where a cast fails."""
    kind = ALIASES[name][1]
    shape = F.schema_of_variant(v)
    if name == "streams":
        listed = F.coalesce(F.when(shape.startswith("OBJECT"), F.json_object_keys(F.to_json(v))), F.from_json(F.to_json(v), "array<string>"))
        return F.array_join(listed, ",")
    if kind == "string":
        text = F.try_variant_get(v, "$", "string")
        inner = F.array_join(F.from_json(F.to_json(v), "array<string>"), " ")
        values = F.map_values(F.from_json(F.to_json(v), "map<string,string>"))
        unwrapped = F.when(F.size(values) == 1, F.get(values, 0)).otherwise(F.to_json(v))
        return F.when(shape.startswith("ARRAY"), inner).when(shape.startswith("OBJECT"), unwrapped).when(shape != "VOID", text)
    bare = F.regexp_replace(F.to_json(v), r'^[\[{"]+(?:[^":]+"\s*:)?["]?|[\]}"]+$', "")
    return F.when(shape != "VOID", bare.try_cast(kind))


def consistent_table(lines: DataFrame, family: str) -> DataFrame:
    """All readable lines of a family in one table: ``line_id, feed_id, file_name``, the family's canonical fields, typed, and ``other_fields``.

    A canonical field is the first spelling, by the alias table and then by the renames found in the feed's history, whose value can be cast; stream lists and maps become
    a comma list of their names. Unreadable lines are left out, fields a line lacks are null. Every field of a line that gave no canonical
    value stays in the map ``other_fields`` as JSON text: fields without a canonical name, values that can't be cast, further spellings of a field, and
    maps of streams. Only nulls under a spelling of the alias table are dropped.
    """
    mine = lines.where(F.col("family") == family)
    docs = readable(mine).withColumn("_fields", F.col("doc").cast("map<string,variant>"))
    found = settled(renamed_spellings(materialised_cells(mine), family), "spellings")
    more = bool(found.take(1))
    if more:
        per_file = found.groupBy("feed", "at", "file").agg(F.map_from_entries(F.collect_list(F.struct("canon", "field"))).alias("_more"))
        per_file = per_file.withColumnsRenamed({"feed": "_feed", "at": "_at", "file": "_file"})
        docs = docs.join(per_file, (F.col("feed_id") == F.col("_feed")) & (F.col("written_at") == F.col("_at")) & (F.col("file_name") == F.col("_file")), "left")
    known = spellings_of(family)
    picks = []
    for name in FAMILY_FIELDS[family]:
        spelled = [(F.lit(s), F.try_variant_get("doc", "$['" + s.replace("\\", "\\\\").replace("'", "\\'") + "']", "variant")) for s, canon in known.items() if canon == name]
        if more:
            spelled.append((F.col("_more")[name], F.element_at("_fields", F.col("_more")[name])))
        whole = lambda v: ~F.schema_of_variant(v).startswith("OBJECT") if name == "streams" else F.lit(True)  # noqa: B023, E731
        options = F.array(*[F.struct(cast_of(v, name).alias("value"), F.when(whole(v), s).alias("field")) for s, v in spelled])
        picks.append(F.get(F.filter(options, lambda x: x["value"].isNotNull()), 0).alias(f"_{name}"))
    picked = docs.select("line_id", "feed_id", "file_name", "_fields", *picks)
    values = [F.col(f"_{name}.value").alias(name) for name in FAMILY_FIELDS[family]]
    used = F.array_compact(F.array(*[F.col(f"_{name}.field") for name in FAMILY_FIELDS[family]]))
    texts = F.transform_values("_fields", lambda _, v: F.coalesce(F.to_json(v), F.lit("null")))
    unnamed = F.map_filter(texts, lambda k, v: ~F.array_contains(used, k) & ~((v == "null") & k.isin(list(known))))
    return picked.select("line_id", "feed_id", "file_name", *values, unnamed.alias("other_fields"))
