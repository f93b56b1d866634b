"""Normalisation of transcripts and their distance to a reference phrase."""

from __future__ import annotations

import json
import string
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxsieve.functions.lineage import json_digest

# Punctuation that never counts.
PUNCTUATION = string.punctuation + "，。！？、；：‘’“”「」『』（）【】《》…·—–"
# Phrases that count as one another.
ALIASES = {
    "hicolmo": ["hicolmo", "heycolmo", "hi colmo", "hey colmo"],
    "heycolmo": ["heycolmo", "hicolmo", "hey colmo", "hi colmo"],
    "hi colmo": ["hicolmo", "heycolmo", "hi colmo", "hey colmo"],
    "hey colmo": ["heycolmo", "hicolmo", "hey colmo", "hi colmo"],
}
CJK = r"[\x{4E00}-\x{9FFF}]"


def compatible_form(text: Column) -> Column:
    """NFKC of a text. Only texts beyond ASCII are changed; null becomes ''."""

    @F.pandas_udf("string")
    def nfkc(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))

    t = F.coalesce(text, F.lit(""))
    return F.when(t.rlike(r"^\p{ASCII}*\z"), t).otherwise(nfkc(t))


def without_punctuation(text: Column) -> Column:
    return F.translate(text, PUNCTUATION, "")


def normal_text(text: Column) -> Column:
    """Compatible form, lower case, no punctuation, ends trimmed; blanks inside stay."""
    return F.regexp_replace(without_punctuation(F.lower(compatible_form(text))), r"(?U)^\s+|\s+$", "")


def normal_chars(text: Column) -> Column:
    """Compatible form without any blank or punctuation, lower case."""
    return F.lower(without_punctuation(F.regexp_replace(compatible_form(text), r"(?U)[\s\x1C-\x1F]+", "")))


def single_spaced(normal: Column) -> Column:
    """Words of a normalised text joined by one blank."""
    return F.trim(F.regexp_replace(normal, r"(?U)[\s\x1C-\x1F]+", " "))


def plain_phrase(text: str) -> str:
    """:func:`single_spaced` of :func:`normal_text` for one Python string."""
    return " ".join(unicodedata.normalize("NFKC", text or "").lower().translate({ord(c): None for c in PUNCTUATION}).split())


def alias_table(path: str | None = None, defaults: bool = True) -> dict[str, list[str]]:
    """Phrase to the phrases that count as it, normalised, each once and in order: the ALIASES, then those of a JSON file of phrase to phrase or list.

    A file's entry also counts as its own alias. Raises ValueError for a file of another shape.
    """
    out = {plain_phrase(k): list(dict.fromkeys(map(plain_phrase, v))) for k, v in ALIASES.items()} if defaults else {}
    if path is None:
        return out
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    if not isinstance(given, dict):
        raise ValueError("an alias table is a JSON object of phrase to list")
    for k, v in given.items():
        listed = [v] if isinstance(v, str) else v
        if not isinstance(listed, list) or not all(isinstance(x, str) for x in listed):
            raise ValueError(f"the aliases of {k!r} must be strings")
        name = plain_phrase(k)
        out[name] = list(dict.fromkeys([*out.get(name, []), name, *map(plain_phrase, listed)]))
    return out


def alias_digest(aliases: dict[str, list[str]]) -> str:
    """SHA-256 of an alias table as compact JSON with sorted keys."""
    return json_digest(aliases)


def has_cjk(text: Column) -> Column:
    return F.coalesce(text.rlike(CJK), F.lit(False))


# Spellings of the two languages.
LANGUAGES = {"zh": "zh", "cn": "zh", "chinese": "zh", "中文": "zh", "mandarin": "zh", "en": "en", "english": "en", "英文": "en"}


def language_of(lang: Column, phrase: Column) -> tuple[Column, Column]:
    """(language, where from): a known spelling, else by the phrase's script, else '' if there is no phrase."""
    spelled = F.coalesce(*[F.when(F.lower(F.trim(lang)) == a, b) for a, b in LANGUAGES.items()])
    text = F.trim(F.coalesce(phrase, F.lit("")))
    guessed = F.when(has_cjk(text), "zh").when(text != "", "en")
    origin = F.when(spelled.isNotNull(), "index_lang").when(guessed.isNotNull(), "inferred_from_wake_text").otherwise("missing_wake_text")
    return F.coalesce(spelled, guessed, F.lit("")), origin


def stream_names(streams: Column) -> Column:
    """The distinct stream names of a JSON object or list, in order; ``peak`` is ``original``. Null or unreadable JSON gives an empty array."""
    listed = F.from_json(streams, "array<variant>")
    name = lambda v: F.when(F.schema_of_variant(v).startswith("OBJECT"), F.coalesce(*[F.nullif(F.try_variant_get(v, f"$.{k}", "string"), F.lit("")) for k in ("stream", "name", "id")])).otherwise(F.try_variant_get(v, "$", "string"))
    names = F.when(F.trim(streams).startswith("{"), F.json_object_keys(streams)).when(F.trim(streams).startswith("["), F.transform(listed, name))
    plain = F.transform(F.coalesce(names, F.lit([]).cast("array<string>")), lambda n: F.when(F.trim(n).isin("peak", "original"), "original").otherwise(F.trim(n)))
    return F.array_distinct(F.filter(plain, lambda n: n != ""))


def edit_share(hyp: Column, ref: Column) -> Column:
    """Edits from ``hyp`` to ``ref`` per character of ``ref``; for an empty ``ref`` 0 if ``hyp`` is empty too, else 1."""
    return F.when(F.length(ref) == 0, F.when(F.length(hyp) == 0, 0.0).otherwise(1.0)).otherwise(F.levenshtein(hyp, ref) / F.length(ref))


def syllable_table(spark: SparkSession) -> dict[str, str]:
    """Toneless syllable of each Chinese character, from the ICU rules that Spark brings along."""
    icu = spark.sparkContext._jvm.com.ibm.icu.text.Transliterator.getInstance("Han-Latin; Latin-ASCII; Lower")
    chars = [chr(n) for n in range(0x4E00, 0xA000)]
    read = icu.transliterate("\n".join(chars)).split("\n")
    return {c: s.strip() for c, s in zip(chars, read, strict=True) if s.strip() != c}


def syllables(spark: SparkSession, chars: Column) -> Column:
    """Chinese characters of a normalised text replaced by their syllables; other characters stay."""
    table = spark.sparkContext.broadcast(str.maketrans(syllable_table(spark)))

    @F.pandas_udf("string")
    def spell(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else t.translate(table.value))

    return spell(chars)


def text_errors(pairs: DataFrame, hyp: str, ref: str, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """``pairs`` with the text-error record of ``hyp`` against ``ref``.

    Adds ``cer_route, cer_char, metric, alias_hit, cer_alias, wake_coverage, extra_ratio, core_hit``. Chinese references
    are compared by syllables, others with the best of their aliases (fewest edits per character, then shorter, then first in order).
    Nulls count as empty texts. Each different pair is worked out once; the result is looked up by the pair's digest, pairs that very many rows have are salted.
    """
    from voxsieve.operators.skew import heavy_keys, salted_left_join

    spark = pairs.sparkSession
    distinct = pairs.select(F.coalesce(hyp, F.lit("")).alias("_hyp"), F.coalesce(ref, F.lit("")).alias("_ref")).distinct()
    d = distinct.withColumns({"_hn": normal_text(F.col("_hyp")), "_rn": normal_text(F.col("_ref")), "_hc": normal_chars(F.col("_hyp")), "_rc": normal_chars(F.col("_ref"))})
    d = d.withColumns({"_he": single_spaced(F.col("_hn")), "_re": single_spaced(F.col("_rn")), "_zh": has_cjk(F.col("_ref"))})
    d = d.withColumns({"_hs": syllables(spark, F.col("_hc")), "_rs": syllables(spark, F.col("_rc"))})
    table = {k: list(dict.fromkeys(v)) for k, v in (aliases or ALIASES).items()}
    known = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(v))])
    own = F.when(F.col("_rc") != "", F.col("_rc")).otherwise(F.col("_re"))
    choices = F.array_distinct(F.concat(F.array("_re"), F.coalesce(F.try_element_at(known, F.col("_re")), F.lit([]).cast("array<string>")), F.array(own)))
    best = F.array_min(F.transform(choices, lambda a: F.struct(edit_share(F.col("_he"), a).alias("d"), F.length(a).alias("n"), a.alias("a"))))
    d = d.withColumn("_best", best)
    words = lambda c: F.filter(F.split(c, " "), lambda w: w != "")
    letters = lambda c: F.filter(F.split(F.regexp_replace(c, " ", ""), ""), lambda w: w != "")
    matched = words(F.col("_best.a"))
    d = d.withColumns(
        {
            "_rt": F.when(F.col("_zh"), letters(F.col("_rn"))).otherwise(words(F.col("_re"))),
            "_ht": F.when(F.col("_zh"), letters(F.col("_hn"))).otherwise(words(F.col("_he"))),
        }
    )
    d = d.withColumn("_cover", F.when(F.col("_zh"), F.col("_rt")).otherwise(matched))
    last = F.get("_cover", F.size("_cover") - 1)
    core = F.when(~F.col("_zh") & last.endswith("colmo"), "colmo").otherwise(last)
    hit = F.filter("_cover", lambda t: F.array_contains("_ht", t) | F.contains(F.col("_hc"), F.regexp_replace(without_punctuation(t), " ", "")))
    d = d.withColumns(
        {
            "cer_char": edit_share(F.col("_hc"), F.col("_rc")),
            "cer_route": F.when(F.col("_zh"), edit_share(F.col("_hs"), F.col("_rs"))).otherwise(F.col("_best.d")),
            "metric": F.when(F.col("_zh"), "toneless_pinyin_cer").otherwise("english_frozen_alias_cer"),
            "alias_hit": F.when(~F.col("_zh"), F.col("_best.a")),
            "cer_alias": F.when(~F.col("_zh"), F.col("_best.d")),
            "wake_coverage": F.coalesce(F.try_divide(F.size(hit), F.size("_cover")), F.lit(0.0)),
            "extra_ratio": F.greatest(F.lit(0), F.size("_ht") - F.size("_rt")) / F.greatest(F.lit(1), F.size("_ht")),
            "core_hit": F.coalesce((core != "") & F.contains(F.col("_hc"), core), F.lit(False)),
        }
    )
    added = ["cer_route", "cer_char", "metric", "alias_hit", "cer_alias", "wake_coverage", "extra_ratio", "core_hit"]
    digest = lambda a, b: F.sha2(F.concat(F.length(a).cast("string"), F.lit(":"), a, b), 256)
    clean = pairs.drop(*[c for c in added if c in pairs.columns])
    clean = clean.withColumns({"_pair": digest(F.coalesce(hyp, F.lit("")), F.coalesce(ref, F.lit(""))), "_spread": F.xxhash64(*[c for c in clean.columns if "map<" not in dict(clean.dtypes)[c]])})
    known = d.select(digest(F.col("_hyp"), F.col("_ref")).alias("_pair"), *added)
    return salted_left_join(clean, known, "_pair", "_spread", heavy_keys(clean, F.col("_pair"))).drop("_pair", "_spread")
