import random

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.duck import ROOT
from voxsieve.llm import leakage as lk
from voxsieve.llm.queries import p6_found


def apart(window, doc, most):
    """Whether some part of ``doc`` is at most ``most`` changes from ``window``."""
    row = [0] * (len(doc) + 1)
    for i, w in enumerate(window, 1):
        new = [i]
        for j, x in enumerate(doc, 1):
            new.append(min(row[j - 1] + (w != x), row[j] + 1, new[j - 1] + 1))
        row = new
        if min(row) > most:
            return True
    return min(row) > most


def brute(item, doc):
    rule = lk.rule_for(item)
    return any(not apart(item[i : i + rule.window], doc, rule.edits) for i in range(len(item) - rule.window + 1))


def test_all_pairs_of_the_small_tables(spark):
    docs, items = (pd.read_parquet(f"{ROOT}/sf0.001/{t}.parquet") for t in ("documents", "eval_items"))
    split = {i: lk.tokens(t) for i, t in zip(docs.doc_id, docs.text)}
    vocabulary = {i: set(t) for i, t in split.items()}
    want = set()
    for key, text in zip(items.item_id, items.text):
        item = lk.tokens(text)
        rule = lk.rule_for(item)
        for i, doc in split.items():
            if sum(t in vocabulary[i] for t in item) >= rule.window - rule.edits and brute(item, doc):
                want.add((i, key))
    assert {tuple(r) for r in p6_found(spark, f"{ROOT}/sf0.001").collect()} == want and want


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**9), st.booleans())
def test_edited_passages(seed, chinese):
    """A window with any mix of changes, in any surroundings, from a small vocabulary full of near hits."""
    rng = random.Random(seed)
    words = [chr(0x4E00 + i) for i in range(12)] if chinese else [f"w{i}" for i in range(9)]
    item = [rng.choice(words) for _ in range(rng.randint(10, 60))]
    at = rng.randrange(len(item))
    part = item[at : at + rng.randint(8, 30)]
    for _ in range(rng.randint(0, 5)):
        k = rng.randrange(len(part) + 1)
        part = rng.choice([part[:k] + part[k + 1 :], part[:k] + [rng.choice(words)] + part[k:], part[:k] + [rng.choice(words)] + part[k + 1 :]])
    doc = [rng.choice(words) for _ in range(rng.randint(0, 30))] + part + [rng.choice(words) for _ in range(rng.randint(0, 30))]
    index = lk.Index([(1, " ".join(item))])
    assert (1 in index.leaks(" ".join(doc))) == brute(item, doc)


def apart_but_for_blanks(window, doc, most):
    """Like :func:`apart`; a word that one side has in two parts is no change."""
    row = [0] * (len(doc) + 1)
    rows = [row]
    for i, w in enumerate(window, 1):
        new = [i]
        for j, x in enumerate(doc, 1):
            best = min(row[j - 1] + (w != x), row[j] + 1, new[j - 1] + 1)
            if j > 1 and w == doc[j - 2] + x:
                best = min(best, row[j - 2])
            if i > 1 and x == window[i - 2] + w:
                best = min(best, rows[i - 2][j - 1])
            new.append(best)
        row = new
        rows.append(row)
    return min(row) > most


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**9))
def test_splits_and_joins_mixed_with_changes(seed):
    """No leak is missed when words of a passage are also split or joined; what is found is one, with a joined pair at the window's edge whole."""
    rng = random.Random(seed)
    words = [f"w{i}x{i * 7}" for i in range(40)] if rng.random() < 0.7 else [f"a{c}{c}b" for c in "cdefghi"]
    item = [rng.choice(words) for _ in range(rng.randint(12, 40))]
    at = rng.randrange(len(item) - 11)
    part = []
    i = at
    end = min(len(item), at + rng.randint(12, 16))
    changes = rng.sample(range(at, end), rng.randint(0, 3))
    while i < end:
        if i in changes:
            part.append("other")
            i += 1
        elif rng.random() < 0.3 and i + 1 < end and i + 1 not in changes:
            part.append(item[i] + item[i + 1])
            i += 2
        elif rng.random() < 0.4:
            cut = rng.randrange(1, len(item[i]))
            part += [item[i][:cut], item[i][cut:]]
            i += 1
        else:
            part.append(item[i])
            i += 1
    doc = [rng.choice(words) for _ in range(rng.randint(0, 8))] + part + [rng.choice(words) for _ in range(rng.randint(0, 8))]
    got = 1 in lk.Index([(1, " ".join(item))]).leaks(" ".join(doc))
    wide = lambda size: any(not apart_but_for_blanks(item[i : i + size], doc, 2) for i in range(len(item) - size + 1))
    if wide(12):
        assert got
    if got:
        assert wide(12) or wide(13)


def test_splits_between_changes_leave_no_seed_of_whole_words():
    item = [f"word{c * 3}" for c in "abcdefghijkl"]
    index = lk.Index([(1, " ".join(item))])
    split = lambda w: f"{w[:3]} {w[3:]}"
    assert index.leaks(" ".join("other" if i in (3, 7) else split(w) if i == 10 else w for i, w in enumerate(item)))
    assert index.leaks(" ".join(split(w) if i in (3, 7, 10) else w for i, w in enumerate(item)))
    assert index.leaks(" ".join(map(split, item)))
    assert index.leaks(" ".join(a + b for a, b in zip(item[::2], item[1::2])))
    assert not index.leaks(" ".join("other" if i in (3, 7, 9) else split(w) for i, w in enumerate(item)))


def test_what_does_not_count():
    item = "When Marek followed the tidy ferry, an island mended twelve old hammocks beyond Petra's café."
    index = lk.Index([(7, item)])
    for doc in (item.upper(), item.replace(" ", "\n> "), "When Marek fol-\nlowed the tidy ferry an is­land mended twelve old ham​mocks beyond Petra’s café", item.replace("followed", "fol lowed").replace("the tidy", "thetidy"), "x " * 5000 + item):
        assert list(index.leaks(doc)) == [7], doc[:80]
    assert not index.leaks("When Marek followed the tidy ferry, an island mended") and not index.leaks("") and not lk.Index([]).leaks(item)


def test_blocks_nulls_and_other_columns(spark):
    text = " ".join(f"w{i}" for i in range(20))
    items = spark.createDataFrame([(i, text if i < 3 else " ".join(f"v{i}x{k}" for k in range(20)), "c") for i in range(6)] + [(9, None, "c"), (10, "", "c"), (11, "too short", "c")], "item_id long, text string, doc_id string")
    docs = spark.createDataFrame([(1, text, 1), (1, text, 1), (2, None, 1), (3, "", 1), (4, "other words", 1)], "doc_id long, text string, item_id int")
    for size in (30, 10**6):
        got = lk.leaks(docs, items, block_chars=size)
        assert sorted((r.doc_id, r.item_id) for r in got.collect()) == sorted([(1, i) for i in range(3)] * 2)
    assert [r.doc_id for r in lk.without_leaks(docs, got).orderBy("doc_id").collect()] == [2, 3, 4]
    assert {r.item_id: (r.n_documents, r.longest_span) for r in lk.item_report(got).collect()} == dict.fromkeys(range(3), (1, 20))
    assert lk.leaks(docs.limit(0), items).count() == 0 and lk.leaks(docs, items.limit(0)).count() == 0
    assert "Exchange" not in lk.leaks(docs.select("doc_id", F.col("text")), items)._jdf.queryExecution().executedPlan().toString()


def test_spans_are_exact():
    fill = lambda tag, n: [f"{tag}{i}" for i in range(n)]
    item = fill("w", 40)
    index = lk.Index([(1, " ".join(item))])
    at = lambda doc: index.leaks(" ".join(doc))[1]
    assert at(fill("x", 20) + item[3:15] + fill("y", 20)) == [(20, 32)]
    assert at(fill("x", 20) + item[3:9] + ["other"] + item[10:16] + fill("y", 20)) == [(20, 33)]
    assert at(fill("x", 20) + item[:13] + fill("y", 50) + item[13:] + ["z"]) == [(20, 33), (83, 110)]
    scattered = [w if i % 7 else f"q{i}" for i, w in enumerate(item)]
    assert at(fill("x", 5) + scattered) == [(6, 45)]  # the first word is changed
    assert at(item * 2) == [(0, 80)]


def test_places_of_tokens_and_cut_texts(spark):
    for text in pd.read_parquet(f"{ROOT}/sf0.01/documents.parquet").text.dropna():
        words, places = lk.placed_tokens(text)
        assert words == lk.tokens(text)
        assert all(a < b <= c for (a, b), (c, _) in zip(places, places[1:], strict=False))
    item = "When Marek followed the tidy ferry, an island mended twelve old hammocks beyond Petra's café."
    docs = spark.createDataFrame([(1, f"Before: {item} And after."), (1, f"Before: {item} And after."), (2, None), (3, ""), (4, "Nothing here.")], "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id int, text string")
    got = sorted(map(tuple, lk.cleaned(docs, items).collect()))
    assert [r[:2] for r in got] == [(1, 1), (1, 1), (2, 0), (3, 0), (4, 0)]
    assert [r[2] for r in got if r[0] != 2] == ["Before:  . And after."] * 2 + ["", "Nothing here."]
    assert lk.leaks(lk.cleaned(docs, items), items).count() == 0


def test_many_blocks_and_long_items(spark):
    """More items than one block takes, and one item longer than a segment, give the rows of a single index."""
    rng = random.Random(8)
    words = [f"word{i}" for i in range(3000)]
    long_item = [rng.choice(words) for _ in range(12_000)]
    items = [(0, " ".join(long_item))] + [(i, " ".join(rng.choice(words) for _ in range(30))) for i in range(1, 60)]
    docs = []
    for i in range(120):
        source = items[i % 60][1].split()
        at = rng.randrange(len(source) - 14)
        docs.append((i, " ".join(rng.choices(words, k=30) + source[at : at + rng.choice([8, 14])] + rng.choices(words, k=30))))
    docs.append((999, " ".join(long_item[4900:5100])))
    d, t = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one, many = (sorted(map(tuple, lk.leaks(d, t, block_chars=n).collect())) for n in (10**7, 4_000))
    assert one == many and (999, 0, 1, 200) in many
