"""Visually identical text in one consistent form.

Texts are exploded to positioned code points, mapped through broadcast tables (decompositions and look-alikes),
their combining marks put in class order, recomposed, and built up to strings again. The tables come from the
Unicode data of Python by rule and have a fixed size (about 15,000 rows).
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Letters that look like a basic Latin letter in most typefaces, each with that letter.
STRICT = {
    "Cyrillic": ("АВЕЅІЈКМНОРСТУХаеорсухѕіјһԁԛԝѵ", "ABESIJKMHOPCTYXaeopcyxsijhdqwv"),
    "Greek": ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαγιορυνϲϳ", "ABEZHIKMNOPTYXayiopuvcj"),
    "Armenian": ("ՕՍՏԼօոսհցզյ", "OUSLonuhgqj"),
    "Cherokee": ("ᎠᎡᎢᎪᎫᎬᎮᎳᎷᎻᏀᏃᏙᏚᏞᏟᏢᏦ", "DRTAJEPWMHGZVSLCPK"),
    "Latin": ("ɑɡıɩʏᴄᴏᴠᴡᴢꞵ", "agiiycovwzb"),
}
# Letters that pass for a Latin letter only beside Latin ones.
LOOSE = {"Cyrillic": ("вкмнтпгиьз", "bkmhtnrub3"), "Greek": ("βεηκτχωμσ", "Benktxwuo")}
# Blanks that have no compatibility mapping to U+0020.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\u1680\u2028\u2029"
#: Characters without any effect on the eye: format and control characters, selectors, fillers.
INVISIBLE = r"[\p{Cf}[\p{Cc}&&[^\t-\r\x1C-\x1F\x85]]\x{034F}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180F}\x{3164}\x{FE00}-\x{FE0F}\x{FFA0}\x{E0100}-\x{E01EF}]"
#: Texts of only these characters are plain already: they neither map nor combine.
INERT = r"^[\x20-\x7E\x{A1}-\x{A7}\x{AB}\x{B0}\x{B1}\x{BB}\x{BF}-\x{FF}\x{2013}\x{2014}\x{2018}-\x{201D}\x{3001}-\x{3003}\x{3008}-\x{3011}\x{4E00}-\x{9FFF}]*\z"
#: Words (with their marks) and what stands between them.
WORDS = r"[\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}]+[\p{M}\x{FF9E}\x{FF9F}]*"
#: A word in pieces of about 512 characters, none of which begins with a character that may join the one before: marks, Hangul vowels and finals, half-width voice marks.
PIECES = r"(?s).{1,512}[\p{M}\x{1160}-\x{11FF}\x{FF9E}-\x{FFDC}]*"
#: Scripts whose letters can be taken for Latin ones; a word with other letters of them is truly in that script.
SCRIPTS = ("LATIN", "CYRILLIC", "GREEK", "ARMENIAN", "CHEROKEE", "COPTIC", "LISU", "CANADIAN", "TIFINAGH", "GEORGIAN", "RUNIC", "LYCIAN", "CARIAN", "OLD", "DESERET", "OSAGE", "ELBASAN")
#: Of these scripts the letters that only the public data names pass for Latin ones beside Latin ones only, as ordinary words consist of them.
LIVING = ("ARMENIAN", "GEORGIAN")


def look_alikes(spark: SparkSession) -> tuple[dict[str, str], dict[str, str]]:
    """(strict, loose) letters with the basic Latin letter each looks like.

    Beside the lists above these are all letters of SCRIPTS that Unicode's data of confusable characters, which Spark's class path brings along, gives the
    same look as a basic Latin letter. Of a letter's two forms the second follows the first's list.
    """
    strict = {a: b for x, y in STRICT.values() for a, b in zip(x, y, strict=True)}
    loose = {a: b for x, y in LOOSE.values() for a, b in zip(x, y, strict=True)}
    basic = [chr(n) for n in (*range(0x41, 0x5B), *range(0x61, 0x7B))]
    script = {c: unicodedata.name(c, "").split(" ")[0] for n in range(0x80, 0x11000) if unicodedata.category(c := chr(n))[0] == "L"}
    letters = [c for c, s in script.items() if s in SCRIPTS and unicodedata.normalize("NFKD", c) == c]
    look = spark.sparkContext._jvm.com.ibm.icu.text.SpoofChecker.Builder().build().getSkeleton("\n".join([*basic, *letters])).split("\n")
    latin: dict[str, str] = {}
    for c, x in zip(basic, look):
        latin[x] = latin.get(x, "") + c  # I and l look the same
    for c, x in zip(letters, look[len(basic) :], strict=True):
        if x in latin and c not in strict and c not in loose:
            usual = script[c] in LIVING or c.lower() in loose
            (loose if usual else strict)[c] = latin[x][-1 if c.islower() else 0]
    return strict, loose


@lru_cache(1)
def code_point_rows(spark: SparkSession) -> list[tuple[int, list[tuple]]]:
    """(code point, [(code point, combining class, kind, look-alike)...]) where the mapping isn't the identity or the kind isn't 'n'.

    Kinds: l Latin, s strict and w loose look-alike of a Latin letter, o another letter of these scripts, n anything else. What a letter looks like counts before
    what it is decomposed to.
    """
    strict, loose = look_alikes(spark)

    def one(c: str) -> tuple:
        kind = "n"
        if unicodedata.category(c)[0] == "L" and (script := unicodedata.name(c, "").split(" ")[0]) in SCRIPTS:
            kind = "s" if c in strict else "w" if c in loose else "l" if script == "LATIN" else "o"
        return ord(c), unicodedata.combining(c), kind, ord(strict.get(c) or loose.get(c) or c)

    rows = []
    for n in range(0x80, 0x110000):
        c = chr(n)
        if 0xAC00 <= n <= 0xD7A3 or 0xD800 <= n <= 0xDFFF or 0x4E00 <= n <= 0x9FFF:
            continue  # precomposed Hangul stays composed; surrogates aren't characters; ideographs map to themselves
        parts = [one(x) for x in (" " if c in BLANKS else unicodedata.normalize("NFKD", c))]
        if c in strict and len(parts) == 1:
            parts = [(*parts[0][:2], "s", ord(strict[c]))]
        if parts != [(n, 0, "n", n)]:
            rows.append((n, parts))
    rows += [(ord(c), [(32, 0, "n", 32)]) for c in BLANKS if ord(c) < 0x80]
    return rows + [(n, [one(chr(n))]) for n in range(0x80) if chr(n).isalpha()]


@lru_cache(1)
def compositions() -> dict[int, int]:
    """first * 2**21 + second code point: composed code point, for all canonical pairs that compose."""
    out = {}
    for n in range(0xA0, 0x110000):
        d = unicodedata.decomposition(chr(n))
        if d and d[0] != "<" and " " in d and unicodedata.normalize("NFC", chr(n)) == chr(n):
            a, b = (int(x, 16) for x in d.split())
            out[a << 21 | b] = n
    return out


def code_points(text: Column) -> Column:
    """The code points of a text as an array of int."""
    return F.transform(F.regexp_extract_all(F.hex(F.encode(text, "UTF-32")), F.lit("(.{8})"), 1), lambda h: F.conv(h, 16, 10).cast("int"))


def from_code_points(points: Column) -> Column:
    """The text of an array of code points."""
    return F.decode(F.unhex(F.array_join(F.transform(points, lambda c: F.lpad(F.hex(c), 8, "0")), "")), "UTF-32")


def _composed(points: Column, table: Column) -> Column:
    """Canonical composition of an ordered array of struct(cp, ccc): the composed code points."""
    state = "struct<done:array<int>,head:int,tail:array<int>,last:int>"
    none = F.expr("cast(array() as array<int>)")
    start = F.struct(none.alias("done"), F.lit(-1).alias("head"), none.alias("tail"), F.lit(0).alias("last")).cast(state)

    def flushed(s: Column) -> Column:
        return F.when(s["head"] < 0, F.concat(s["done"], s["tail"])).otherwise(F.concat(s["done"], F.array(s["head"]), s["tail"]))

    def step(s: Column, x: Column) -> Column:
        h, c = s["head"], x["cp"]
        pair = F.when((x["ccc"] > 0) | c.between(0x0900, 0x11FF) | (c > 0x11000), F.try_element_at(table, F.shiftleft(h.cast("long"), 21) + c))
        lv = F.when(h.between(0x1100, 0x1112) & c.between(0x1161, 0x1175), F.lit(0xAC00) + ((h - 0x1100) * 21 + (c - 0x1161)) * 28)
        lvt = F.when(h.between(0xAC00, 0xD7A3) & ((h - 0xAC00) % 28 == 0) & c.between(0x11A8, 0x11C2), h + (c - 0x11A7))
        free = (h >= 0) & F.when(x["ccc"] > 0, (F.size(s["tail"]) == 0) | (s["last"] < x["ccc"])).otherwise(F.size(s["tail"]) == 0)
        made = F.when(free, F.coalesce(pair, lv, lvt))
        joined = F.struct(s["done"].alias("done"), made.alias("head"), s["tail"].alias("tail"), s["last"].alias("last"))
        mark = F.struct(s["done"].alias("done"), h.alias("head"), F.concat(s["tail"], F.array(c)).alias("tail"), x["ccc"].alias("last"))
        fresh = F.struct(flushed(s).alias("done"), c.alias("head"), none.alias("tail"), F.lit(0).alias("last"))
        return F.when(made.isNotNull(), joined.cast(state)).when(x["ccc"] > 0, mark.cast(state)).otherwise(fresh.cast(state))

    return F.aggregate(points, start, step, flushed)


@lru_cache(1)
def _tables(spark: SparkSession) -> tuple[DataFrame, Column]:
    mapped = spark.createDataFrame(code_point_rows(spark), "cp int, parts array<struct<cp:int,ccc:int,kind:string,look:int>>")
    pairs = compositions()
    keys, values = (", ".join(f"{x}{kind}" for x in part) for part, kind in ((pairs, "L"), (pairs.values(), "")))
    return mapped, F.expr(f"map_from_arrays(array({keys}), array({values}))")  # one text costs less than thousands of calls into the JVM


def plain_forms(rows: DataFrame, text: str) -> DataFrame:
    """``tid, plain`` for each distinct text of ``rows`` that isn't plain by its characters alone; ``tid`` is its SHA-256.

    Distinct texts are found first (the one shuffle); their code points then stay in the same partition. A word of Latin letters and
    look-alikes becomes Latin; a word of look-alikes only does too, unless the text holds a word truly in
    such a script. Long words are exploded and recomposed in pieces, but judged whole. Nulls have no row, the empty text is plain.
    """
    spark = rows.sparkSession
    mapped, pairs = _tables(spark)
    odd = rows.where(F.col(text).isNotNull() & ~F.col(text).rlike(INERT))
    texts = odd.groupBy(F.sha2(F.col(text), 256).alias("tid")).agg(F.first(text).alias("text"))
    words = texts.select("tid", F.posexplode(F.regexp_extract_all(F.regexp_replace("text", INVISIBLE, ""), F.lit(WORDS), 0)).alias("word", "letters"))
    pieces = words.select("tid", F.posexplode(F.regexp_extract_all("letters", F.lit(PIECES), 0)).alias("at", "piece_text"), "word").select("tid", F.struct("word", "at").alias("piece"), "piece_text")
    points = pieces.select("tid", "piece", F.posexplode(code_points(F.col("piece_text"))).alias("pos", "cp"))
    same = F.array(F.struct(F.col("cp").alias("cp"), F.lit(0).alias("ccc"), F.lit("n").alias("kind"), F.col("cp").alias("look")))
    parts = points.join(F.broadcast(mapped), "cp", "left").select("tid", "piece", "pos", F.posexplode(F.coalesce("parts", same)).alias("sub", "p"))
    listed = parts.groupBy("tid", "piece").agg(
        F.sort_array(F.collect_list(F.struct("pos", "sub", F.col("p.cp").alias("cp"), F.col("p.ccc").alias("ccc"), F.col("p.look").alias("look")))).alias("all"),
        *[F.count_if(F.col("p.kind") == k).alias(f"n_{k}") for k in "lswo"],
    )
    has_marks = F.exists("all", lambda x: (x["ccc"] > 0) | x["cp"].between(0x0900, 0x11FF) | (x["cp"] > 0x11000))
    starts = F.transform("all", lambda x: F.when(x["ccc"] == 0, 1).otherwise(0))
    running = F.aggregate(starts, F.expr("cast(array() as array<int>)"), lambda acc, x: F.concat(acc, F.array(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)) + x)))
    ordered = F.sort_array(F.zip_with("all", running, lambda x, s: F.struct(s.alias("seg"), x["ccc"].alias("ccc"), x["pos"].alias("pos"), x["sub"].alias("sub"), x["cp"].alias("cp"), x["look"].alias("look"))))
    listed = listed.withColumn("all", F.when(has_marks, F.transform(ordered, lambda x: F.struct(x["cp"].alias("cp"), x["ccc"].alias("ccc"), x["look"].alias("look")))).otherwise(F.transform("all", lambda x: F.struct(x["cp"].alias("cp"), x["ccc"].alias("ccc"), x["look"].alias("look")))))

    def built(field: str) -> Column:
        chosen = F.transform("all", lambda x: F.struct(x[field].alias("cp"), x["ccc"].alias("ccc")))
        return from_code_points(F.when(has_marks, _composed(chosen, pairs)).otherwise(F.transform("all", lambda x: x[field])))

    # what a piece looks like as Latin is built wherever it has look-alikes; the whole word decides
    built_pieces = listed.select("tid", F.col("piece.word").alias("word"), "piece", *[f"n_{k}" for k in "lswo"], built("cp").alias("own"), F.when(F.col("n_s") + F.col("n_w") > 0, built("look")).alias("look"))
    of_word = built_pieces.groupBy("tid", "word").agg(F.sort_array(F.collect_list(F.struct("piece", "own", F.coalesce("look", "own").alias("look")))).alias("p"), *[F.sum(f"n_{k}").alias(f"n_{k}") for k in "lswo"])
    text_of = lambda field: F.array_join(F.transform("p", lambda x: x[field]), "")
    mixed = ((F.col("n_o") + F.col("n_w") == 0) & (F.col("n_s") > 0) & (F.col("n_l") > 0)) | ((F.col("n_o") == 0) & (F.col("n_w") > 0) & (F.col("n_l") > F.col("n_w") + F.col("n_s")))
    alone = (F.col("n_s") > 0) & (F.col("n_l") + F.col("n_o") + F.col("n_w") == 0)
    words = of_word.select(
        "tid",
        F.col("word").alias("piece"),
        text_of("own").alias("own"),
        F.when(mixed | alone, text_of("look")).alias("latin"),
        alone.alias("alone"),
        ((F.col("n_o") + F.col("n_w") > 0) & ~mixed).alias("foreign"),
    )
    whole = words.groupBy("tid").agg(F.sort_array(F.collect_list(F.struct("piece", "own", "latin", "alone"))).alias("w"), F.max("foreign").alias("foreign"))
    rebuilt = F.array_join(F.transform("w", lambda x: F.when(x["latin"].isNotNull() & ~(x["alone"] & F.col("foreign")), x["latin"]).otherwise(x["own"])), "")
    return whole.select("tid", rebuilt.alias("plain")).unionByName(texts.where(F.regexp_replace("text", INVISIBLE, "") == "").select("tid", F.lit("").alias("plain")))


def changed_rows(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` whose text differs from its plain form, with the column ``plain`` (which replaces one of that name).

    The lookup of plain forms is co-partitioned with the rows by the text's digest; texts that fill a large part of the rows are salted.
    """
    from voxsieve.operators.skew import heavy_keys, salts_for, salt_of

    odd = rows.where(F.col(text).isNotNull() & ~F.col(text).rlike(INERT)).withColumn("_tid", F.sha2(F.col(text), 256))
    forms = plain_forms(rows, text)
    hot = heavy_keys(odd, F.col("_tid"))
    left = odd.withColumn("_salt", salt_of(F.col("_tid"), F.xxhash64(*[c for c, kind in rows.dtypes if "map<" not in kind]), hot, 64))
    right = forms.withColumn("_salt", F.explode(salts_for(F.col("tid"), hot, 64))).withColumnsRenamed({"tid": "_tid", "plain": "_plain"})
    return left.join(right, ["_tid", "_salt"]).where(F.col("_plain") != F.col(text)).select(*[c for c in rows.columns if c.lower() != "plain"], F.col("_plain").alias("plain"))
