"""Mixing sources to target shares of tokens, with capped repeats, by a minimum-cost flow."""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxsieve.operators.ordered import running_total
from voxsieve.session import settled

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the public byte-level tokenizer cuts text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: More membership patterns than this are refused, as the flow holds one row per pattern on the driver; S sources have at most 2**S - 1, so 20 sources never reach it.
MOST_PATTERNS = 1 << 20
#: Up to so many patterns (some 100 bytes each) the spans are broadcast.
BROADCAST_PATTERNS = 100_000
#: What a smaller mix has to bring: a total less by one hundredth must bring the shares nearer by a thousandth.
SIZE_WEIGHT = 0.1
#: Texts per source and power of two of their size that may mend a source's tokens by one use more or less.
SPARE_TEXTS = 16


@lru_cache(2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(text: Column, path: str = TOKENIZER) -> Column:
    """The number of tokens of each text; null for null, 0 for ''. ``path`` must exist on every executor."""

    @F.pandas_udf("long")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _encoding(path)
        for s in parts:
            known = {t: len(enc.encode_ordinary(t)) for t in s.dropna().unique()}  # copies in a batch are encoded once
            yield s.map(known).astype("Int64")

    return count(text)


def plain_source(source: Column) -> Column:
    """One spelling per source: trimmed, lower case, words joined by underscores."""
    return F.regexp_replace(F.lower(F.trim(source)), r"[\s-]+", "_")


def membership(documents: DataFrame, targets: list[str], seed: int, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per different text: ``key, doc_id, n_tokens, pattern, h``.

    ``pattern`` is the ascending list of targets (numbers) whose sources hold the text, ``doc_id`` the smallest id
    with it, ``h`` a seeded hash for the drawing order. Texts are replaced by digest and size before the shuffle, and copies are combined
    before it. Null and empty texts, and texts that only unlisted sources hold, are left out.
    """
    number = F.array_position(F.lit(targets), plain_source(F.col("source")))
    sized = documents.where("text is not null and text <> ''").select("doc_id", F.sha2("text", 256).alias("key"), number.alias("t"), token_counts(F.col("text"), tokenizer).alias("n_tokens"))
    texts = sized.where("t > 0").groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.array_join(F.array_sort(F.collect_set("t")), ",").alias("pattern"))
    return texts.withColumn("h", F.xxhash64(F.lit(seed), "key"))


class Patterns:
    """Membership patterns as arrays: ``size`` in tokens and what each source may take of each pattern."""

    def __init__(self, patterns: dict[str, int], repeats: list[int]) -> None:
        self.names = sorted(patterns)
        self.size = np.array([patterns[p] for p in self.names], np.int64)
        members = np.zeros((len(self.names), len(repeats)), np.int64)
        for i, p in enumerate(self.names):
            members[i, [int(x) - 1 for x in p.split(",")]] = 1
        most = members * np.array(repeats, np.int64)
        self.most_uses = most.max(axis=1, initial=0)
        self.cap = most * self.size[:, None]


def _spread(amount: int, room: np.ndarray) -> np.ndarray:
    """``amount`` given out along ``room``, filling each place before the next."""
    return np.clip(amount - (np.cumsum(room) - room), 0, room)


def _flow(p: Patterns, quota: np.ndarray) -> np.ndarray:
    """The cheapest tokens of each pattern for each source that fill as much of ``quota`` as can be filled.

    The n-th use of a text costs n, the same for all patterns, so cheapest paths first means: a maximum flow with one use of
    each text, from there one with two, and so on. A path enters a source by a pattern with room and goes on from source to source, where a pattern
    gives to the next what it gave to the one before; all patterns between two sources are one arc, so paths are searched among the sources only.
    """
    flow, left, used = np.zeros_like(p.cap), quota.copy(), np.zeros_like(p.size)
    sources = range(len(quota))
    for level in range(1, int(p.most_uses.max(initial=0)) + 1):
        while left.any():
            spare = p.size * np.minimum(level, p.most_uses) - used
            enter = np.minimum(spare[:, None], p.cap - flow)
            entry = enter.sum(axis=0)
            came: dict[int, int | None] = {s: None for s in sources if entry[s] > 0}
            queue, end, gives = list(came), None, {}
            for a in queue:
                if left[a] > 0:
                    end = a
                    break
                move = np.minimum(flow[:, a : a + 1], p.cap - flow)
                for b in sources:
                    if b not in came and (n := int(move[:, b].sum())) > 0:
                        came[b], gives[b] = a, n
                        queue.append(b)
            if end is None:
                break
            path = [end]
            while came[path[-1]] is not None:
                path.append(came[path[-1]])
            path.reverse()
            amount = min([int(entry[path[0]]), int(left[end]), *[gives[b] for b in path[1:]]])
            put = _spread(amount, enter[:, path[0]])
            flow[:, path[0]] += put
            used += put
            for a, b in zip(path, path[1:]):
                put = _spread(amount, np.minimum(flow[:, a], p.cap[:, b] - flow[:, b]))
                flow[:, a] -= put
                flow[:, b] += put
            left[end] -= amount
    return flow


def route(patterns: dict[str, int], shares: list[float], repeats: list[int], total: int) -> tuple[dict[tuple[str, int], int], int]:
    """Tokens that each (pattern, target) gives to fill ``total``, and the tokens that could be placed.

    The n-th use of a text costs n, so every text is used once before any is used again. A text is
    used at most ``repeats[s]`` times for source s and at most the largest of these times in all.
    """
    p = Patterns(patterns, repeats)
    flow = _flow(p, np.array([int(total * x) for x in shares], np.int64))
    return {(p.names[i], int(s)): int(flow[i, s]) for i, s in zip(*np.nonzero(flow), strict=True)}, int(flow.sum())


def largest_total(patterns: dict[str, int], shares: list[float], repeats: list[int]) -> int:
    """The largest total for which every share can be met; targets without any text are passed over."""
    wanted = _fed(patterns, shares, repeats)
    if not any(wanted):
        return 0
    p = Patterns(patterns, repeats)
    low, high = 0, int(int(p.cap.sum()) / sum(wanted)) + 1
    while high - low > max(1, low // 1_000_000):
        mid = (low + high) // 2
        quota = np.array([int(mid * w) for w in wanted], np.int64)
        low, high = (mid, high) if _flow(p, quota).sum() >= quota.sum() else (low, mid)
    return low


def _fed(patterns: dict[str, int], shares: list[float], repeats: list[int]) -> list[float]:
    """The shares of the targets that have any text, 0 for the others."""
    fed = {int(x) - 1 for p, n in patterns.items() for x in p.split(",") if n > 0 and repeats[int(x) - 1] > 0}
    return [x if s in fed else 0.0 for s, x in enumerate(shares)]


def balanced_total(patterns: dict[str, int], shares: list[float], repeats: list[int], size_weight: float = SIZE_WEIGHT) -> int:
    """The total with the least ``missing share + size_weight * ln(corpus / total)``.

    ``missing share`` is the part of the total that sources at their repeat limit can't give. Tried are the size of the corpus (every text
    once) and, for each source, the size at which its own texts would just be enough, as the sum bends only where a source reaches its limit.
    A small source thus doesn't shrink the mix to its own size, while a large one that falls a little short does lower the total a little.
    """
    wanted = _fed(patterns, shares, repeats)
    if not any(wanted):
        return 0
    p = Patterns(patterns, repeats)
    corpus = int(p.size.sum())
    alone = [int(int(p.cap[:, s].sum()) / w) for s, w in enumerate(wanted) if w > 0]

    def loss(total: int) -> float:
        quota = np.array([int(total * w) for w in wanted], np.int64)
        return float(quota.sum() - _flow(p, quota).sum()) / total + size_weight * math.log(corpus / total)

    return min(sorted({corpus, *(n for n in alone if 0 < n < corpus)}, reverse=True), key=loss)


def _repairs(gaps: dict[str, int], spare: list) -> list[tuple[int, str, int]]:
    """(doc_id, source, -1 or 1): uses to drop or add until each gap is smaller than any text at hand; larger texts first."""
    out = []
    for source, gap in sorted(gaps.items()):
        sign = 1 if gap > 0 else -1
        for r in sorted((r for r in spare if r["source"] == source and r["sign"] == sign), key=lambda r: (-r["n_tokens"], r["doc_id"])):
            if r["n_tokens"] <= abs(gap):
                gap -= sign * r["n_tokens"]
                out.append((r["doc_id"], source, sign))
    return out


def mix(
    documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 11, tokenizer: str = TOKENIZER, every_share_met: bool = False, size_weight: float = SIZE_WEIGHT
) -> tuple[DataFrame, DataFrame]:
    """(chosen, shares) of a mix whose sources have their target shares of the tokens.

    ``chosen``: ``doc_id, source, repeats, n_tokens``, a text for each source that uses it. ``shares``: per target its
    share, tokens at hand, quota, tokens, actual share and numbers of texts and uses. Without ``total_tokens`` the total is that of
    :func:`balanced_total`, about the size of the corpus: sources whose repeats run out fall short, the others keep their proportions, and the report
    says so. With ``every_share_met`` it is the largest for which ``max_repeats`` lets every share be met, however small.
    Per pattern the texts lie in seeded order on a line as long as their tokens; a source takes a span of it, going
    round again for repeats, and with it each text whose middle lies there. Single uses are then added or dropped (of the smallest texts of each power of two, a
    bounded number) until a source's quota is met to within its smallest text. Empty tables give an empty mix.
    """
    spark = documents.sparkSession
    rows = [r for r in targets.where("source is not null").orderBy("source").collect()]  # one row per source
    names, shares, repeats = [plain_source_name(r["source"]) for r in rows], [float(r["target_share"] or 0) for r in rows], [int(r["max_repeats"] or 0) for r in rows]
    texts = settled(membership(documents, names or [""], seed, tokenizer).where("n_tokens > 0"), "mix-texts")
    sizes = texts.groupBy("pattern").agg(F.sum("n_tokens").alias("n")).limit(MOST_PATTERNS + 1).collect()
    if len(sizes) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} membership patterns")
    patterns = {r["pattern"]: int(r["n"]) for r in sizes}
    if total_tokens is None:
        total_tokens = largest_total(patterns, shares, repeats) if every_share_met else balanced_total(patterns, shares, repeats, size_weight)
    given, _ = route(patterns, shares, repeats, total_tokens) if patterns else ({}, 0)
    spans, at = [], dict.fromkeys(patterns, 0)
    for p in sorted(patterns):
        members = [int(x) - 1 for x in p.split(",")]
        of = []
        for s in members:
            n = given.get((p, s), 0)
            of.append((names[s], at[p], at[p] + n, repeats[s]))
            at[p] += n
        spans.append((p, of, patterns[p], max(repeats[s] for s in members)))
    placed = spark.createDataFrame(spans, "pattern string, spans array<struct<source:string,lo:long,hi:long,most:int>>, size long, most_uses int")
    placed = F.broadcast(placed) if len(spans) <= BROADCAST_PATTERNS else placed
    lined = running_total(texts, ["pattern"], "h", ["key"], "n_tokens", "start").join(placed, "pattern")
    turn = lambda bound: F.ceil((bound - F.col("start") - F.col("n_tokens") / 2) / F.col("size"))
    each = F.transform("spans", lambda x: F.struct(x["source"].alias("source"), x["most"].alias("most"), (turn(x["hi"]) - turn(x["lo"])).cast("int").alias("repeats")))
    lined = lined.withColumn("each", each).withColumn("uses", F.aggregate("each", F.lit(0), lambda n, x: n + x["repeats"]))
    uses = settled(lined.select("doc_id", "n_tokens", "h", "uses", "most_uses", F.explode("each").alias("e")).select("doc_id", "n_tokens", "h", "uses", "most_uses", "e.*"), "mix-uses")
    quotas = {n: int(total_tokens * x) for n, x in zip(names, shares, strict=True)}
    tokens = {r["source"]: int(r["t"]) for r in uses.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("t")).collect()}
    gaps = {n: quotas[n] - t for n, t in tokens.items() if quotas[n] != t}
    signed = uses.withColumn("sign", F.coalesce(*[F.when(F.col("source") == n, 1 if g > 0 else -1) for n, g in gaps.items()], F.lit(0)))
    can = F.when(F.col("sign") > 0, (F.col("repeats") < F.col("most")) & (F.col("uses") < F.col("most_uses"))).otherwise((F.col("sign") < 0) & (F.col("repeats") > 0))
    nth = F.row_number().over(Window.partitionBy("source", "sign", F.floor(F.log2("n_tokens"))).orderBy("n_tokens", "h", "doc_id"))
    spare = signed.where(can).withColumn("nth", nth).where(F.col("nth") <= SPARE_TEXTS).select("doc_id", "source", "sign", "n_tokens").collect() if gaps else []
    fixes = _repairs(gaps, spare)
    chosen = uses.select("doc_id", "source", "repeats", "n_tokens")
    if fixes:
        table = F.broadcast(spark.createDataFrame(fixes, "doc_id " + dict(documents.dtypes)["doc_id"] + ", source string, more int"))
        chosen = chosen.join(table, ["doc_id", "source"], "left").select("doc_id", "source", (F.col("repeats") + F.coalesce("more", F.lit(0))).alias("repeats"), "n_tokens")
    chosen = chosen.where("repeats > 0")
    wanted = spark.createDataFrame([(n, x, r, sum(v for p, v in patterns.items() if str(i + 1) in p.split(",")), quotas[n]) for i, (n, x, r) in enumerate(zip(names, shares, repeats, strict=True))], "source string, target_share double, max_repeats int, available_tokens long, quota_tokens long")
    used = chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count(F.lit(1)).alias("n_texts"), F.sum("repeats").cast("long").alias("n_uses"), F.max("repeats").alias("most_repeats"))
    all_tokens = used.agg(F.sum("tokens").alias("all_tokens"))
    report = wanted.join(used, "source", "left").join(F.broadcast(all_tokens)).na.fill(0, ["tokens", "n_texts", "n_uses", "most_repeats"])
    return chosen, report.withColumn("actual_share", F.coalesce(F.try_divide(F.col("tokens"), F.col("all_tokens")), F.lit(0.0))).drop("all_tokens")


def plain_source_name(name: str) -> str:
    """:func:`plain_source` for one name."""
    import re

    return re.sub(r"[\s-]+", "_", name.strip().lower())
