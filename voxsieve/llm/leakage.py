"""Evaluation items inside training documents: a scan of token windows against a broadcast set of item n-grams."""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxsieve.session import scratch_path

#: Characters of all items in one index (at most two seeds a character, some 150 MB of words and hashes); more items are taken in blocks.
BLOCK_CHARS = 1_000_000
#: Words of an item in one segment; longer items are cut into segments that overlap by three windows.
SEGMENT = 5_000
#: Characters of documents that a worker holds at once.
HELD_CHARS = 2_000_000

_CJK = "㐀-䶿一-鿿豈-﫿\U00020000-\U0003fa1f"
_WORD = re.compile(rf"[{_CJK}]|[^\W_{_CJK}]+")
_HYPHEN = re.compile(r"(?<=[^\W\d_])[-‐‑]\s*\n\s*(?=[^\W\d_])|(?<=\w)[-‐‑](?=\w)")
_APOSTROPHE = re.compile(r"['’ʼ‘`´]")
_IS_CJK = re.compile(rf"[{_CJK}]")
#: Marks and format characters, which never count.
_UNSEEN = {n: None for n in range(0x80, 0x110000) if unicodedata.category(chr(n)) in ("Mn", "Me", "Cf")}


@dataclass(frozen=True)
class Rule:
    """A leak: ``window`` consecutive tokens of an item with at most ``edits`` tokens replaced, left out or put in."""

    window: int
    edits: int

    @property
    def seed(self) -> int:
        """A window with so few changes keeps an unchanged run of this length, wherever the changes are."""
        return -(-(self.window - self.edits) // (self.edits + 1))


WORDS, CHARACTERS = Rule(12, 2), Rule(24, 3)


def tokens(text: str) -> list[str]:
    """Words, and single Chinese characters, without case, accents, punctuation, blanks and invisible characters.

    A word broken by a hyphen at a line's end is one word; apostrophes and hyphens inside a word fall out.
    """
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text).translate(_UNSEEN)
    text = _HYPHEN.sub("", _APOSTROPHE.sub("", text))
    return _WORD.findall(text.casefold())


def rule_for(item: list[str]) -> Rule:
    """Chinese items are compared by characters, others by words."""
    return CHARACTERS if 2 * sum(bool(_IS_CJK.match(t)) for t in item) > len(item) else WORDS


#: Odd multiplier of the window hash and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


_known_powers: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """At least the first ``n`` powers of the multiplier and of its inverse, modulo 2**64; kept per process."""
    if not _known_powers or len(_known_powers[0]) < n:
        row = [np.concatenate(([np.uint64(1)], np.full(n - 1, x, np.uint64))) for x in (_BASE, _INVERSE)]
        _known_powers[:] = [np.multiply.accumulate(x) for x in row]
    return _known_powers


class _Hashed:
    """A row of tokens without blanks, whose windows' hashes come from one running sum."""

    def __init__(self, row: list[str]) -> None:
        codes = np.frombuffer("".join(row).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        size = 1 << max(16, int(len(codes)).bit_length())
        up, self.down = _powers(size)
        self.starts = np.concatenate(([0], np.cumsum(np.fromiter(map(len, row), np.int64, len(row)))))
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum((codes + np.uint64(1)) * up[: len(codes)], dtype=np.uint64)))

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hashes of the characters from ``begin`` to before ``end``; equal strings have equal hashes wherever they lie."""
        return (self.sums[end] - self.sums[begin]) * self.down[begin]


class Index:
    """The seeds of some items: hashes of n-grams without blanks in one sorted array, with item number, position and words.

    A word in two parts, or two words in one, don't break an unchanged run, so runs are looked up as strings. A run begins where a
    document's word begins. Where its last word is joined to the next, the n-gram one longer ends with a word, so both lengths are indexed.
    A hash only finds candidates; their words are compared. 21 bytes a seed.
    """

    #: Most characters by which the places that may begin a run are told from others.
    HEAD = 8

    def __init__(self, items: list[tuple[int, str | list[str]]]) -> None:
        rows = [(key, t if isinstance(t, list) else tokens(t or "")) for key, t in items]
        self.items = [(key, t, rule_for(t)) for key, t in rows if t]
        found: dict[str, list] = {n: [] for n in ("hash", "item", "at", "words", "head", "length")}
        for n, (_, t, rule) in enumerate(self.items):
            if len(t) < rule.window - rule.edits:
                continue
            h = _Hashed(t)
            for k in (rule.seed, rule.seed + 1):
                begin, end = h.starts[: len(t) - k + 1], h.starts[k:]
                length = np.minimum(end - begin, self.HEAD)
                new = (h.of(begin, end), np.full(len(begin), n, np.int32), np.arange(len(begin), dtype=np.int32), np.full(len(begin), k, np.int8), h.of(begin, begin + length), length)
                for name, x in zip(found, new, strict=True):
                    found[name].append(x)
        whole = {n: np.concatenate(x) if x else np.zeros(0, np.int64) for n, x in found.items()}
        self.bits = max(12, (8 * len(whole["hash"])).bit_length())
        self.heads = {}
        for length in np.unique(whole["length"]).tolist():
            self.heads[length] = np.zeros(1 << self.bits, bool)
            self.heads[length][self._slot(whole["head"][whole["length"] == length])] = True
        order = np.argsort(whole["hash"], kind="stable")
        self.hash, self.item, self.at, self.words = (whole[n][order] for n in ("hash", "item", "at", "words"))
        self.most_words = 2 * int(self.words.max(initial=0))

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes * np.uint64(_BASE)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _hits(self, docs: list[list[str]]) -> dict[int, list[tuple[int, int, int, int, int]]]:
        """Per document (item number, position, words; position, words) of the unchanged runs of a seed's length in an item and in the document."""
        row = [t for d in docs for t in d]
        if not row or not len(self.hash):
            return {}
        h = _Hashed(row)
        ends = np.cumsum([len(d) for d in docs])
        begin = h.starts[:-1]
        likely = np.zeros(len(row), bool)
        for length, slots in self.heads.items():
            fits = begin + length <= h.starts[-1]
            likely[fits] |= slots[self._slot(h.of(begin[fits], begin[fits] + length))]
        at = np.flatnonzero(likely)
        doc_of = np.searchsorted(ends, at, side="right")
        out: dict[int, list[tuple[int, int, int, int, int]]] = {}
        for m in range(1, self.most_words + 1):
            inside = at + m <= ends[doc_of]
            j = at[inside]
            hashes = h.of(h.starts[j], h.starts[j + m])
            low, high = np.searchsorted(self.hash, hashes, "left"), np.searchsorted(self.hash, hashes, "right")
            for x in np.flatnonzero(high > low):
                d, place = int(doc_of[inside][x]), int(j[x])
                for y in range(low[x], high[x]):
                    n, i, words = int(self.item[y]), int(self.at[y]), int(self.words[y])
                    theirs, mine = self.items[n][1][i : i + words], row[place : place + m]
                    if theirs == mine or (words + 1) // 2 <= m <= 2 * words and _same_words(theirs, mine):
                        out.setdefault(d, []).append((n, i, words, place - int(ends[d] - len(docs[d])), m))
        return out

    def search(self, docs: list[list[str]]) -> Iterator[tuple[int, dict[int, list[tuple[int, int]]]]]:
        """(number of the document, item key to the token spans that hold the item's words) of the documents that leak."""
        for d, hits in self._hits(docs).items():
            if spans := self._spans(docs[d], hits):
                yield d, spans

    def leaks(self, text: str) -> dict[int, list[tuple[int, int]]]:
        """Item key to the token spans of ``text`` that hold the item's words, apart and in order."""
        return dict(self.search([tokens(text)])).get(0, {})

    def _spans(self, doc: list[str], hits: list[tuple[int, int, int, int, int]]) -> dict[int, list[tuple[int, int]]]:
        found: dict[int, list[tuple[int, int]]] = {}
        near = {(n, i, j) for n, i, _, j, _ in hits}
        for n, i, words, j, m in sorted(hits, key=lambda h: (h[3], h[0], h[1], h[2])):
            key, item, rule = self.items[n]
            if (n, i - 1, j - 1) in near and item[i - 1] == doc[j - 1]:
                continue  # the same unchanged run was tried from its start
            a, b = i + words, j + m
            while a < len(item) and b < len(doc) and item[a] == doc[b]:
                a, b = a + 1, b + 1
            most = 2 * rule.window + rule.edits
            known = found.setdefault(key, [])
            if known and known[-1][0] <= j - most and b + most <= known[-1][1]:
                continue  # it can't reach beyond what is known
            left = _reach(item[:i][::-1], doc[max(0, j - most) : j][::-1], rule, True)
            right = _reach(item[a : a + rule.window], doc[b : b + most], rule, False)
            held = [e for e in range(rule.edits + 1) if left[e][0] + a - i + right[rule.edits - e][0] >= rule.window]
            if held:
                known.append((j - max(left[e][1] for e in held), b + max(right[rule.edits - e][1] for e in held)))
        return {key: _merged(spans) for key, spans in found.items() if spans}


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans in order, those that overlap or touch joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _same_words(item: list[str], doc: list[str]) -> bool:
    """Whether both are the same words, of which some stand in two parts on one side."""
    a = b = 0
    while a < len(item) and b < len(doc):
        if item[a] == doc[b]:
            a, b = a + 1, b + 1
        elif b + 1 < len(doc) and item[a] == doc[b] + doc[b + 1]:
            a, b = a + 1, b + 2
        elif a + 1 < len(item) and doc[b] == item[a] + item[a + 1]:
            a, b = a + 2, b + 1
        else:
            return False
    return a == len(item) and b == len(doc)


def _reach(item: list[str], doc: list[str], rule: Rule, backwards: bool) -> list[tuple[int, int]]:
    """For 0..edits changes: the most tokens of ``item`` passed from its start, and the tokens of ``doc`` up to the farthest equal one.

    A word that one side has in two parts counts as equal. Of several ways to the farthest equal token the shortest in ``doc`` counts.
    """
    most = rule.window
    level = {(0, 0)}
    equal = {(0, 0)}
    out = []
    join = (lambda a, b: b + a) if backwards else (lambda a, b: a + b)
    for e in range(rule.edits + 1):
        stack, seen = list(level), set(level)
        while stack:
            a, b = stack.pop()
            steps = []
            if a < len(item) and b < len(doc) and item[a] == doc[b]:
                steps = [(a + 1, b + 1)]
            else:
                if a < len(item) and b + 1 < len(doc) and item[a] == join(doc[b], doc[b + 1]):
                    steps.append((a + 1, b + 2))
                if a + 1 < len(item) and b < len(doc) and doc[b] == join(item[a], item[a + 1]):
                    steps.append((a + 2, b + 1))
            for s in steps:
                if s[0] <= most:
                    equal.add(s)
                    if s not in seen:
                        seen.add(s)
                        stack.append(s)
        out.append((max(seen)[0], max(equal, key=lambda s: (s[0], -s[1]))[1]))
        if e < rule.edits:
            level = {s for a, b in seen for s in ((a + 1, b + 1), (a + 1, b), (a, b + 1)) if s[0] <= len(item) and s[1] <= len(doc)} | seen
    return out


def placed_tokens(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """:func:`tokens` with the characters of ``text`` that each comes from."""
    chars, origin = [], []
    for i, c in enumerate(text):
        for x in c if c.isascii() else unicodedata.normalize("NFKD", c).translate(_UNSEEN):
            chars.append(x)
            origin.append(i)
    for pattern in (_APOSTROPHE, _HYPHEN):
        kept, last = [], 0
        for m in pattern.finditer("".join(chars)):
            kept += range(last, m.start())
            last = m.end()
        kept += range(last, len(chars))
        chars, origin = [chars[i] for i in kept], [origin[i] for i in kept]
    folded = [(x, i) for c, i in zip(chars, origin, strict=True) for x in c.casefold()]
    found = list(_WORD.finditer("".join(x for x, _ in folded)))
    return [m.group() for m in found], [(folded[m.start()][1], folded[m.end() - 1][1] + 1) for m in found]


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` with its token spans cut out; each leaves one blank."""
    places = placed_tokens(text)[1]
    parts, last = [], 0
    for a, b in _merged(spans):
        parts.append(text[last : places[a][0]])
        last = places[b - 1][1]
    return " ".join([*parts, text[last:]]) if parts else text


def _segments(items: DataFrame, key: str, text: str, blocks: int) -> DataFrame:
    """``block, key, words``: the items' words, long items in overlapping segments, dealt to ``blocks`` by a hash."""
    kind = dict(items.dtypes)[key]
    step, over = SEGMENT, 3 * CHARACTERS.window

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, t in zip(pdf["key"], pdf["text"], strict=True):
                words = tokens(t)
                rows += [(k, "\n".join(words[a : a + step])) for a in range(0, max(1, len(words) - over), step - over)]
            yield pd.DataFrame(rows, columns=["key", "words"])

    some = items.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text <> ''")
    return some.mapInPandas(cut, f"key {kind}, words string").withColumn("block", F.pmod(F.xxhash64("key", "words"), F.lit(blocks)).cast("int"))


def _indexes(items: DataFrame, key: str, text: str, block_chars: int) -> Callable[[], Iterator[Index]]:
    """What a worker calls to get the indexes of all items, one after the other.

    Items of up to ``block_chars`` characters in all make one index, which is broadcast. More are written to the shared folder in blocks of about that
    size, each read by the workers for as many documents as they hold; neither the driver nor a worker ever holds more than one block.
    """
    spark = items.sparkSession
    total = items.agg(F.sum(F.length(text))).first()[0] or 0
    if total <= block_chars:
        rows = items.select(key, text).where(F.col(text).isNotNull()).collect() if total else []
        shared = spark.sparkContext.broadcast(Index([(r[0], r[1]) for r in sorted(rows)]))
        return lambda: iter([shared.value])
    blocks = math.ceil(total / block_chars)
    path = scratch_path(spark, "leak-items")
    _segments(items, key, text, blocks).repartition(min(blocks, 10_000), "block").write.partitionBy("block").parquet(path)

    def read() -> Iterator[Index]:
        import pyarrow.parquet as pq
        from pyarrow import fs as pafs

        where, base = pafs.FileSystem.from_uri(path)
        for folder in sorted(x.path for x in where.get_file_info(pafs.FileSelector(base)) if x.type == pafs.FileType.Directory):
            names = [x.path for x in where.get_file_info(pafs.FileSelector(folder)) if x.path.endswith(".parquet")]
            rows = [r for n in sorted(names) for r in pq.ParquetFile(where.open_input_file(n)).read(["key", "words"]).to_pylist()]
            yield Index([(r["key"], r["words"].split("\n")) for r in rows if r["words"]])

    return read


def _scanned(documents: DataFrame, items: DataFrame, doc_key: str, item_key: str, text: str, block_chars: int, rows_of: Callable, schema: str, all_documents: bool) -> DataFrame:
    """``documents`` mapped where they lie: ``rows_of(id, text, spans per item)`` of those that leak, or of all."""
    indexes = _indexes(items, item_key, text, block_chars)
    names = [c.split()[0] for c in schema.split(", ")]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def done(held: list[tuple]) -> pd.DataFrame:
            docs = [tokens(t or "") for _, t in held]
            found: list[dict] = [{} for _ in held]
            for index in indexes():
                for d, spans in index.search(docs):
                    for k, v in spans.items():
                        found[d][k] = _merged(found[d].get(k, []) + v)
            rows = [r for (d, t), f in zip(held, found, strict=True) if f or all_documents for r in rows_of(d, t, f)]
            return pd.DataFrame(rows, columns=names)

        held: list[tuple] = []
        size = 0
        for pdf in batches:
            for d, t in zip(pdf["doc"], pdf["text"], strict=True):
                held.append((d, t))
                size += len(t or "")
                if size > HELD_CHARS:
                    yield done(held)
                    held, size = [], 0
        yield done(held)

    texts = documents.select(F.col(doc_key).alias("doc"), F.col(text).alias("text"))
    return (texts if all_documents else texts.where("text <> ''")).mapInPandas(scan, schema)


def leaks(documents: DataFrame, items: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, item_id, n_spans, longest_span``: each document with each item it holds; spans in tokens, from the first equal one to the last.

    Documents are scanned where they lie, without a shuffle, and their words taken once, however many blocks the items make (see :func:`_indexes`).
    Every window with few enough changes contains an unchanged run of :attr:`Rule.seed` tokens, also if words are split or joined by blanks, so the n-gram hits miss
    nothing; each hit is then checked exactly. Passages that overlap or touch are one span. Null
    and empty texts, and items shorter than a window less its changes, give no rows; repeated documents each give theirs.
    """
    types = dict(documents.dtypes), dict(items.dtypes)
    schema = f"doc_id {types[0][doc_key]}, item_id {types[1][item_key]}, n_spans int, longest_span int"
    rows = lambda d, _, found: [(d, k, len(v), max(b - a for a, b in v)) for k, v in found.items()]
    return _scanned(documents, items, doc_key, item_key, text, block_chars, rows, schema, False)


def cleaned(documents: DataFrame, items: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, n_cut, text``: all documents, with every leaked span cut out of the text; null texts stay null."""
    schema = f"doc_id {dict(documents.dtypes)[doc_key]}, n_cut int, text string"

    def rows(d: object, t: str | None, found: dict) -> list[tuple]:
        spans = _merged([s for v in found.values() for s in v])
        return [(d, len(spans), without_spans(t, spans) if spans else t)]

    return _scanned(documents, items, doc_key, item_key, text, block_chars, rows, schema, True)


def without_leaks(documents: DataFrame, found: DataFrame, doc_key: str = "doc_id") -> DataFrame:
    """The documents that leak nothing."""
    return documents.join(found.select(F.col("doc_id").alias("_leaking")).distinct(), F.col(doc_key) == F.col("_leaking"), "left_anti")


def item_report(found: DataFrame) -> DataFrame:
    """Per item the number of documents that leak it and the longest span found."""
    return found.groupBy("item_id").agg(F.count_distinct("doc_id").alias("n_documents"), F.max("longest_span").alias("longest_span"))
