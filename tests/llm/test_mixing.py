import random
import time

import pytest
from pyspark.sql import functions as F

from tests.duck import ROOT
from voxsieve.llm import mixing as mx
from voxsieve.llm.queries import p7_mix, p7_shares
from voxsieve.sources.tables import table


def test_tokens_round_trip(spark):
    enc = mx._encoding(mx.TOKENIZER)
    for t in ("Hello  world's 123\n\n小路", "", " \t ", "x" * 3000):
        assert enc.decode(enc.encode_ordinary(t)) == t
    d = spark.createDataFrame([("Hello world",), ("",), (None,)], "t string")
    assert [r[0] for r in d.select(mx.token_counts(F.col("t"))).collect()] == [2, 0, None]


def brute_cost(patterns, quotas, repeats, steps):
    """Cheapest cost of placing all quotas, by trying every split (tiny cases)."""
    best = None

    def go(left, cost, ps):
        nonlocal best
        if not ps:
            if not any(left):
                best = cost if best is None else min(best, cost)
            return
        (p, n), rest = ps[0], ps[1:]
        members = [int(x) - 1 for x in p.split(",")]
        top = max(repeats[s] for s in members)

        def split(i, given, left):
            if i == len(members):
                used = sum(given)
                if used <= n * top:
                    level, cost2 = 1, 0
                    while used > 0:
                        cost2 += level * min(used, n)
                        used, level = used - n, level + 1
                    go(left, cost + cost2, rest)
                return
            s = members[i]
            for x in range(0, min(left[s], n * repeats[s]) + 1, steps):
                split(i + 1, [*given, x], [v - x if j == s else v for j, v in enumerate(left)])

        split(0, [], left)

    go(list(quotas), 0, sorted(patterns.items()))
    return best


def test_flow_is_cheapest():
    rng = random.Random(3)
    for _ in range(25):
        patterns = {p: rng.randint(1, 4) for p in rng.sample(["1", "2", "1,2"], rng.randint(1, 3))}
        repeats = [rng.randint(1, 3), rng.randint(1, 3)]
        quotas = [rng.randint(0, 5), rng.randint(0, 5)]
        total = sum(quotas) or 1
        given, placed = mx.route(patterns, [q / total + 1e-12 for q in quotas], repeats, total)
        best = brute_cost(patterns, quotas, repeats, 1)
        if best is None:
            assert placed < sum(quotas)
            continue
        assert placed == sum(quotas)
        cost = 0
        for p, n in patterns.items():
            used, level = sum(x for (q, _), x in given.items() if q == p), 1
            while used > 0:
                cost += level * min(used, n)
                used, level = used - n, level + 1
        assert cost == best
        assert all(x <= patterns[p] * repeats[s] for (p, s), x in given.items())


def test_many_patterns_in_time():
    rng = random.Random(4)
    sources = 13
    patterns = {}
    while len(patterns) < 5000:
        p = ",".join(str(x) for x in sorted(rng.sample(range(1, sources + 1), rng.randint(1, sources))))
        patterns[p] = rng.randint(1, 10**9)
    shares, repeats = [1 / sources] * sources, [rng.randint(1, 6) for _ in range(sources)]
    began = time.perf_counter()
    total = mx.balanced_total(patterns, shares, repeats)
    given, placed = mx.route(patterns, shares, repeats, total)
    assert time.perf_counter() - began < 30
    assert placed == sum(int(total * x) for x in shares) and total == sum(patterns.values())
    for p, n in patterns.items():
        uses = [given.get((p, int(x) - 1), 0) for x in p.split(",")]
        assert sum(uses) <= n * max(repeats[int(x) - 1] for x in p.split(","))


def test_every_share_met(spark):
    root = f"{ROOT}/sf0.1"
    _, shares = mx.mix(table(spark, root, "documents"), table(spark, root, "mix_targets"), every_share_met=True)
    shares = {r.source: r for r in shares.collect()}
    for r in shares.values():
        assert abs(r.actual_share - r.target_share) < 0.003 and r.most_repeats <= r.max_repeats
    assert max(r.most_repeats / r.max_repeats for r in shares.values()) == 1  # a larger total would need more repeats


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_shares_of_the_tables(spark, sf):
    root = f"{ROOT}/{sf}"
    shares = {r.source: r for r in p7_shares(spark, root).collect()}
    at_hand = sum(r.available_tokens for r in shares.values())
    smallest = {r.source: r.n for r in p7_mix(spark, root).groupBy("source").agg(F.min("n_tokens").alias("n")).collect()}
    assert sum(r.tokens for r in shares.values()) > 0.85 * at_hand
    for r in shares.values():
        full = r.tokens == r.available_tokens * r.max_repeats
        assert full or abs(r.actual_share - r.target_share) < 0.01
        assert full or abs(r.tokens - r.quota_tokens) < max(smallest[r.source], 64)  # the smallest text may have no use left
        assert r.most_repeats <= r.max_repeats
    chosen = p7_mix(spark, root)
    assert chosen.groupBy("doc_id", "source").count().where("count > 1").count() == 0
    assert {r.source: r.t for r in chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("t")).collect()} == {k: r.tokens for k, r in shares.items()}


def test_repairs_leave_less_than_any_text_at_hand():
    rng = random.Random(5)
    for _ in range(200):
        sizes = [rng.randint(1, 400) for _ in range(rng.randint(0, 30))]
        gap = rng.randint(-900, 900)
        spare = [{"doc_id": i, "source": "a", "sign": 1 if gap > 0 else -1, "n_tokens": n} for i, n in enumerate(sizes)]
        done = mx._repairs({"a": gap}, spare)
        assert len({d for d, _, _ in done}) == len(done)
        left = abs(gap) - sum(sizes[d] for d, _, _ in done)
        assert left >= 0 and all(n > left for i, n in enumerate(sizes) if i not in {d for d, _, _ in done})


def test_the_total_weighs_size_against_shares():
    # a tenth that is nearly absent doesn't shrink the mix of 1,000, half of it would; one that nearly suffices lowers it a little
    assert mx.balanced_total({"1": 990, "2": 10}, [0.9, 0.1], [1, 1]) == 1000 and mx.balanced_total({"1": 990, "2": 10}, [0.5, 0.5], [1, 1]) == 20
    assert mx.balanced_total({"1": 540, "2": 460}, [0.5, 0.5], [1, 1]) == 920
    assert mx.balanced_total({}, [0.5], [1]) == 0 and mx.balanced_total({"1": 5}, [1.0], [0]) == 0


def small(spark):
    docs = [(i, f"text number {i} " + "word " * (i % 7), "A-b" if i % 3 else " a_B ") for i in range(200)] + [(1000 + i, f"text number {i} " + "word " * (i % 7), "c") for i in range(40)] + [(2000, None, "c"), (2001, "", "c"), (2002, "lost", None), (2003, "lost too", "other"), (0, "text number 0 ", "a b")]
    targets = [("a_b", 0.5, 1), ("c", 0.5, 4), ("empty", 0.0, 2), (None, 0.1, 1)]
    return spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("pattern", F.lit("clash")), spark.createDataFrame(targets, "source string, target_share double, max_repeats int")


def test_overlapping_sources_and_seed(spark):
    docs, targets = small(spark)
    chosen, shares = mx.mix(docs, targets)
    got = {r.source: r for r in shares.collect()}
    assert got["c"].actual_share == pytest.approx(0.5, abs=0.02) and got["empty"].tokens == 0
    assert {r.doc_id for r in chosen.collect()} <= {r.doc_id for r in docs.where("text <> ''").collect()} - {2002, 2003}
    again, _ = mx.mix(docs, targets)
    other, _ = mx.mix(docs, targets, seed=12)
    key = lambda d: sorted(map(tuple, d.collect()))
    assert key(chosen) == key(again) != key(other)
    per_text = chosen.groupBy("doc_id").agg(F.sum("repeats").alias("n"))
    assert per_text.agg(F.max("n")).first()[0] <= 4


def test_too_large_a_total_and_empty_tables(spark):
    docs, targets = small(spark)
    _, shares = mx.mix(docs, targets, total_tokens=10**6)
    got = {r.source: r for r in shares.collect()}
    assert got["c"].tokens <= 4 * got["c"].available_tokens and got["a_b"].tokens < got["a_b"].quota_tokens
    for d, t in ((docs.limit(0), targets), (docs, targets.limit(0))):
        chosen, shares = mx.mix(d, t)
        assert chosen.count() == 0 and shares.where("tokens > 0").count() == 0
