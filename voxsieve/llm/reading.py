"""The reading level of documents: a linear ranker learned from pairs, calibrated to levels by isotonic regression."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxsieve.session import settled

#: Labelled documents per script used to fit; of more, those with the smallest hash are taken.
MOST_LABELLED = 1000
#: Weight of the squared weights beside the loss of the pairs.
PENALTY = 1e-3
#: Size of the list of common words (and characters) that vocabulary features refer to.
COMMON_WORDS = 2000
#: The head of that list, the words that any text may use, and of these the ones that hold sentences together.
EVERYDAY_WORDS, FUNCTION_WORDS = 200, 60
#: Characters of a word that counts as long.
LONG, VERY_LONG = 8, 12

# Words that open a subordinate clause or link clauses.
LINKS_EN = "after although as because before if insofar irrespective moreover nevertheless notwithstanding once since that thereby therefore though unless until when whereas whereby which while who whose".split()
LINKS_ZH = "因为 虽然 但是 而且 从而 进而 使得 尽管 所以 如果 直到 由于 以及 然而 并且 其中 在于 对于 关于 倘若".split()
# Endings and characters typical of abstract nouns.
ABSTRACT_EN = "(?:tion|sion|ity|ness|ment|ance|ence|ology|isation|ization|ability|ism)s?"
ABSTRACT_ZH = "性 化 度 率 论 质 制 量 构 型 态 系 理 析 征".split()
FEATURES = "sentence_length clause_length clauses links syllables long_share very_long_share abstract_share function_share everyday_missing common_missing variety".split()
#: Scripts told apart: mostly Chinese characters, mostly words in Latin letters, anything else.
SCRIPTS = ("latin", "zh", "other")


def _clean(text: Column) -> Column:
    """The prose of a text: without tags, table rules, time marks, key=value pairs and heading marks."""
    return F.regexp_replace(text, r"<[^<>]{1,200}>|</?[A-Za-z!][^<>]*>|\[\d+(?:\.\d+)?\](?: *\w{1,12}:)?|https?://\S+|\b\w+=\S+|[|#>*_`~{}]+|-{2,}", " ")


def units(text: Column) -> Column:
    """Lower-case words of letters, and single Chinese characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\x{3400}-\x{9FFF}]|[\p{L}&&[^\x{3400}-\x{9FFF}]][\p{L}\p{M}'’&&[^\x{3400}-\x{9FFF}]]*"), 0)


def _quoted(words: list[str]) -> str:
    """The words as SQL literals; one expression text costs less than thousands of calls into the JVM."""
    return ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in words)


def _some(of: str, keep) -> Column:  # noqa: ANN001
    return F.size(F.filter(of, keep)).cast("double")


def segmented(documents: DataFrame) -> DataFrame:
    """``documents`` without ``text`` but with ``script``, ``words``, ``text_chars`` and ``marks``, the numbers that come from the text itself.

    ``marks``: sentences, clause marks, runs of letters, long runs, very long runs, link words or characters, groups of vowels. Everything stays in place and inside the JVM.
    """
    count = lambda p: F.regexp_count("_t", F.lit(p)).cast("double")
    d = documents.withColumn("_t", _clean(F.coalesce(F.col("text"), F.lit("")))).withColumn("words", units(F.col("_t")))
    # each step's columns are used several times in the next, so the optimiser keeps them apart and works them out once
    d = d.withColumns({"_zh": _some("words", lambda w: w.between("\u3400", "\u9fff")), "_latin": _some("words", lambda w: w < "\u0250")})
    d = d.withColumn("script", F.when(F.size("words") == 0, None).when(F.col("_zh") * 2 > F.size("words"), "zh").when(F.col("_latin") * 2 >= F.size("words"), "latin").otherwise("other"))
    is_zh = F.col("script") == "zh"
    only_zh = lambda p: F.when(is_zh, count(p)).otherwise(F.lit(0.0))
    marks = F.array(
        F.greatest(count(r"[.!?。！？]+(?=\s|$|[\"'”’)\x{3400}-\x{9FFF}])"), F.lit(1.0)),
        count(r"[,;:，；、：]"),
        F.greatest(only_zh(r"[\x{3400}-\x{9FFF}]+"), F.lit(1.0)),
        only_zh(r"[\x{3400}-\x{9FFF}]{12,}"),
        only_zh(r"[\x{3400}-\x{9FFF}]{20,}"),
        F.when(is_zh, count("|".join(LINKS_ZH))).otherwise(_some("words", lambda w: w.isin(LINKS_EN))),
        F.when(is_zh, F.lit(0.0)).otherwise(count(r"[AEIOUYaeiouyÀ-ÅÈ-ÏÒ-ÖÙ-Ýà-åè-ïò-öù-ýÿœæ]+")),
    )
    return d.withColumns({"marks": marks, "text_chars": F.length("text")}).drop("_t", "_zh", "_latin", *(["text"] if "text" in documents.columns else []))


def common_units(documents: DataFrame, n: int = COMMON_WORDS) -> dict[str, list[str]]:
    """Per script the ``n`` words or characters that occur in most of its documents, counted over all of them; ties by code point."""
    parts = documents if "words" in documents.columns else segmented(documents)
    counts = settled(parts.where("script is not null").select("script", F.explode(F.array_distinct("words")).alias("w")).groupBy("script", "w").agg(F.count(F.lit(1)).alias("c")), "word-counts")
    return {s: [r["w"] for r in counts.where(F.col("script") == s).orderBy(F.desc("c"), "w").limit(n).collect()] for s in SCRIPTS}


def with_features(documents: DataFrame, common: dict[str, list[str]]) -> DataFrame:
    """``documents`` (or :func:`segmented` ones) with ``script`` and ``f``, the features in the order of FEATURES.

    Syntax: words per sentence and per clause, clauses and links per sentence. Words: groups of vowels a word (Chinese: characters a run), long words (runs), abstract nouns, the share of
    function words (the FUNCTION_WORDS most common ones of the script), and how many different words aren't among the everyday and common ones. Empty and null texts have script null and features 0.
    """
    d = documents if "words" in documents.columns else segmented(documents)
    d = d.withColumns({"_kinds": F.array_distinct("words"), "_n": F.greatest(F.size("words"), F.lit(1)).cast("double")})
    is_zh, n = F.col("script") == "zh", F.col("_n")
    s, clauses, runs, long_runs, very_long_runs, links, vowels = (F.col("marks")[i] for i in range(7))
    k = F.greatest(F.size("_kinds"), F.lit(1)).cast("double")

    def by_script(of: str, test: str, most: int) -> Column:
        """How many of the words ``of`` pass ``test`` (in or not in) for their script's most common words."""
        lists = {x: _quoted(common.get(x, [])[:most] or [""]) for x in SCRIPTS}
        return F.coalesce(*[F.when(F.col("script") == x, F.expr(f"cast(size(filter({of}, w -> w {test} ({words}))) as double)")) for x, words in lists.items()], F.lit(0.0))

    f = F.array(
        F.log1p(n / s),
        F.log1p(n / (s + clauses)),
        clauses / s,
        links / s,
        F.when(is_zh, n / runs).otherwise(vowels / n),
        F.when(is_zh, long_runs / runs).otherwise(_some("words", lambda w: F.length(w) >= LONG) / n),
        F.when(is_zh, very_long_runs / runs).otherwise(_some("words", lambda w: F.length(w) >= VERY_LONG) / n),
        F.when(is_zh, _some("words", lambda w: w.isin(ABSTRACT_ZH))).otherwise(_some("words", lambda w: (F.length(w) >= 7) & w.rlike(ABSTRACT_EN + "$"))) / n,
        by_script("words", "in", FUNCTION_WORDS) / n,
        by_script("_kinds", "not in", EVERYDAY_WORDS) / k,
        by_script("_kinds", "not in", COMMON_WORDS) / k,
        k / F.sqrt(n),
    )
    return d.withColumn("f", F.transform(f, lambda x: F.coalesce(x.cast("double"), F.lit(0.0)))).drop("words", "marks", "_kinds", "_n")


@dataclass(frozen=True)
class Ranker:
    """score = weights . (f - mean) / scale; levels by linear interpolation between the knots (xs, ys)."""

    mean: list[float]
    scale: list[float]
    weights: list[float]
    xs: list[float]
    ys: list[float]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ np.array(self.weights)

    def levels(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.scores(x), self.xs, self.ys)


def fit_pairs(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, steps: int = 300) -> np.ndarray:
    """Weights that order all pairs of different level: logistic loss on score differences, accelerated gradient.

    The loss of all pairs is summed from the matrix of score differences, 512 rows at a time, so pairs of features are never built.
    """
    n, d = x.shape
    w, v, momentum = np.zeros(d), np.zeros(d), 0.0
    pairs = max(1, int(sum((y > level).sum() for level in y)))
    step = 4.0 / max(1e-9, np.square(np.ptp(x, axis=0)).sum() / 4 + 4 * penalty)
    for _ in range(steps):
        s, g = x @ v, np.zeros(n)
        for a in range(0, n, 512):
            above = y[a : a + 512, None] > y[None, :]
            pull = above / (1.0 + np.exp(np.clip(s[a : a + 512, None] - s[None, :], -35, 35)))
            g[a : a + 512] -= pull.sum(1)
            g += pull.sum(0)
        new = v - step * (x.T @ g / pairs + penalty * v)
        momentum, old = (1 + np.sqrt(1 + 4 * momentum**2)) / 2, momentum
        v, w = new + (old - 1) / momentum * (new - w) if old else new, new
    return w


def isotonic(score: np.ndarray, level: np.ndarray) -> tuple[list[float], list[float]]:
    """Knots of the non-decreasing fit of ``level`` on ``score``: pooled adjacent violators, one knot at each pool's middle."""
    order = np.lexsort((level, score))
    pools: list[list[float]] = []  # sum of levels, sum of scores, number
    for s, y in zip(score[order], level[order], strict=True):
        pools.append([y, s, 1])
        while len(pools) > 1 and pools[-2][0] / pools[-2][2] >= pools[-1][0] / pools[-1][2]:
            a = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], a, strict=True)]
    return [float(p[1] / p[2]) for p in pools], [float(p[0] / p[2]) for p in pools]


def fit(x: np.ndarray, y: np.ndarray) -> Ranker:
    """A ranker for graded examples; with fewer than two levels every score is 0 and the level their mean."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = (x - mean) / scale
    w = fit_pairs(z, y, PENALTY) if len(set(y)) > 1 else np.zeros(x.shape[1])
    xs, ys = isotonic(z @ w, y)
    return Ranker(mean.tolist(), scale.tolist(), w.tolist(), xs, ys)


def graded(documents: DataFrame, labels: DataFrame, common: dict[str, list[str]], most: int = MOST_LABELLED) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Per script the features and mean levels of at most ``most`` labelled documents; null levels don't count."""
    from pyspark.sql import Window

    level = labels.where("reading_level is not null and doc_id is not null").groupBy("doc_id").agg(F.avg("reading_level").alias("_level"))
    needed = ["doc_id", *(c for c in ("text", "words", "marks", "script") if c in documents.columns and (c != "script" or "words" in documents.columns))]
    rows = with_features(documents.select(*needed).join(level, "doc_id"), common)
    first = Window.partitionBy("script").orderBy(F.xxhash64("doc_id"), "doc_id")
    rows = rows.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= most).orderBy("script", "_r").select("script", "f", "_level").collect()
    out = {}
    for script in sorted({r["script"] for r in rows} - {None}):  # tested here: as a filter it would be worked out on all documents
        mine = [r for r in rows if r["script"] == script]
        out[script] = np.array([r["f"] for r in mine]), np.array([r["_level"] for r in mine])
    return out


def reading_levels(documents: DataFrame, labels: DataFrame, common: dict[str, list[str]] | None = None) -> DataFrame:
    """``documents`` without ``text``, with ``script, text_chars, score, level_estimate`` (1 easy to 5 hard) and ``level``, the rounded estimate.

    Texts are cut into words once and written as such; counts, the fit and the scores read these. The model is small and becomes a column expression, so all documents are scored where they lie. A script without labels borrows
    the other script's calibration; texts without words, and everything where nothing is labelled, have null scores.
    """
    documents = settled(segmented(documents), "segmented")
    common = common_units(documents) if common is None else common
    models = {s: fit(x, y) for s, (x, y) in graded(documents, labels, common).items()}
    d = with_features(documents, common)
    pick = lambda of: F.coalesce(*[F.when(F.col("script") == s, of(models.get(s) or next(iter(models.values())))) for s in SCRIPTS]) if models else F.lit(None)

    def score(m: Ranker) -> Column:
        weights = F.lit([w / s for w, s in zip(m.weights, m.scale, strict=True)])
        terms = F.zip_with(F.zip_with("f", F.lit(m.mean), lambda a, b: a - b), weights, lambda a, b: a * b)
        return F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)

    # step by step, so that nothing is worked out once per use
    d = d.withColumn("score", pick(score).cast("double"))
    d = d.withColumn("_i", pick(lambda m: F.size(F.filter(F.lit(m.xs), lambda x: x <= F.col("score")))).cast("int"))
    corner = lambda of, step: pick(lambda m: F.get(F.lit(of(m)), F.greatest(F.lit(0), F.least(F.lit(len(m.xs) - 1), F.col("_i") + step)))).cast("double")
    d = d.withColumns({"_x0": corner(lambda m: m.xs, -1), "_y0": corner(lambda m: m.ys, -1), "_x1": corner(lambda m: m.xs, 0), "_y1": corner(lambda m: m.ys, 0)})
    slope = F.coalesce(F.try_divide(F.col("_y1") - F.col("_y0"), F.col("_x1") - F.col("_x0")), F.lit(0.0))
    inside = F.greatest(F.least(F.col("score"), F.col("_x1")), F.col("_x0"))
    d = d.withColumn("level_estimate", F.when(F.col("score").isNotNull(), F.round(F.col("_y0") + slope * (inside - F.col("_x0")), 6)))
    return d.withColumn("level", F.round("level_estimate").cast("int")).drop("f", "_i", "_x0", "_y0", "_x1", "_y1")


def profile(levels: DataFrame, by: list[str]) -> DataFrame:
    """Documents, characters and mean estimate per group and level, over the whole corpus."""
    return levels.groupBy(*by, "level").agg(F.count(F.lit(1)).alias("n_documents"), F.sum("text_chars").alias("n_chars"), F.round(F.avg("level_estimate"), 4).alias("mean_estimate"))
