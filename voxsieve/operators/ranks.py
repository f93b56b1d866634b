"""Ranks by repeated elimination: the winner of a group, the winner of the rest, and so on to the last candidate.

Margins aren't transitive, so this is no sort, and a rank depends on all earlier ones. Each group goes through one clustered pass
that keeps the error window and the order of the evidence metrics from one rank to the next.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TIE = 1e-12
#: Pools above this size are narrowed by arrays instead of lists; the comparisons are the same.
_ARRAYS_FROM = 128


def _near(gap: float, margin: float) -> bool:
    return gap < margin - 1e-15 or abs(gap) <= TIE


def _narrow(pool: list[int], values: list[float], array: np.ndarray, margin: float) -> list[int]:
    """The members of ``pool`` near the least value; all if one of them lacks a value (NaN)."""
    if len(pool) > _ARRAYS_FROM:
        at = np.array(pool)
        v = array[at]
        if np.isnan(v).any():
            return pool
        gap = v - v.min()
        return at[(gap < margin - 1e-15) | (np.abs(gap) <= TIE)].tolist()
    have = [values[i] for i in pool]
    if any(v != v for v in have):
        return pool
    best = min(have)
    return [i for i, v in zip(pool, have, strict=True) if _near(v - best, margin)]


def elimination(error: np.ndarray, evidence: list[tuple[np.ndarray, float]], quality: list[tuple[np.ndarray, float]], enhanced: np.ndarray | None, delta: float) -> list[int]:
    """The rows of one group in the order in which they win. Rows come in the order of the last tie-break.

    Metrics are pairs of values (smaller is better, NaN is missing) and margin; of ``evidence`` the first that all of the window have counts.
    A rank costs the window's members near the best evidence, not the whole window.
    """
    n = len(error)
    if n == 1:
        return [0]
    by_error = np.argsort(error, kind="stable").tolist()
    errors = error.tolist()
    proofs = [(v.tolist(), margin, []) for v, margin in evidence]
    tests = [(v.tolist(), v, margin) for v, margin in quality]
    prefer = None if enhanced is None else enhanced.tolist()
    gone, window, order = [False] * n, {}, []
    first = admitted = 0
    while len(order) < n:
        while gone[by_error[first]]:
            first += 1
        most = errors[by_error[first]] + (delta + TIE)
        while admitted < n and errors[by_error[admitted]] <= most:
            i = by_error[admitted]
            window[i] = None
            for values, _, found in proofs:
                if values[i] == values[i]:
                    insort(found, (values[i], i))
            admitted += 1
        for _, margin, found in proofs:
            if len(found) == len(window):
                best = found[0][0]
                end = bisect_left(found, True, key=lambda x: not _near(x[0] - best, margin))  # noqa: B023
                pool = [i for _, i in found[:end]]
                break
        else:
            pool = list(window)
        for values, array, margin in tests:
            if len(pool) == 1:
                break
            pool = _narrow(pool, values, array, margin)
        if prefer is not None:
            pool = [i for i in pool if prefer[i]] or pool
        won = min(pool)
        order.append(won)
        gone[won] = True
        del window[won]
        for values, _, found in proofs:
            if values[won] == values[won]:
                del found[bisect_left(found, (values[won], won))]
    return order


def _spans(hot: DataFrame, keys: list[str], reach: float) -> DataFrame:
    """``hot`` with ``_span`` and ``_before``: the parts of a group that no error window joins, and the rows in the parts before.

    Where the next larger error is out of reach, everything below is ranked before anything above, so the parts are ranked apart. Only the
    counts per error value are ordered by a window.
    """
    levels = hot.groupBy(*keys, "cer_route").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*keys).orderBy("cer_route")
    begins = F.coalesce((F.col("cer_route") > F.lag("cer_route").over(w) + F.lit(reach)).cast("int"), F.lit(0))
    levels = levels.withColumn("_begins", begins).withColumn("_span", F.sum("_begins").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    sizes = levels.groupBy(*keys, "_span").agg(F.sum("_c").alias("_c"))
    before = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_c").over(before), F.lit(0)))
    same = lambda a, b, on: [a[k].eqNullSafe(b[k]) for k in on]
    levels = levels.alias("l").join(sizes.alias("s"), same(levels, sizes, [*keys, "_span"])).select(*[F.col(f"l.{k}").alias(f"_l_{k}") for k in [*keys, "cer_route"]], "l._span", "s._before")
    return hot.join(levels, [F.col(k).eqNullSafe(F.col(f"_l_{k}")) for k in [*keys, "cer_route"]]).drop(*[f"_l_{k}" for k in [*keys, "cer_route"]])


def clustered_ranks(d: DataFrame, keys: list[str], evidence: list[float], quality: list[float], delta: float, prefer: bool, hot: list) -> DataFrame:
    """``keys, candidate_id, stage_rank`` of all rows of ``d``, each group in one task (see :func:`elimination`).

    ``d`` has ``cer_route``, the metrics as ``_e0, ...`` and ``_m0, ...`` (smaller is better), whose margins are given, ``_enhanced`` and the last tie-break
    ``_last``. Groups whose first key is in ``hot`` are first cut where their errors lie too far apart for any window.
    """
    kinds = dict(d.dtypes)
    is_hot = F.col(keys[0]).isin(hot)
    whole = (d.where(~is_hot | F.col(keys[0]).isNull()) if hot else d).withColumns({"_span": F.lit(0).cast("long"), "_before": F.lit(0).cast("long")})
    if hot:
        whole = whole.unionByName(_spans(d.where(is_hot), keys, delta + TIE))
    clustered = whole.repartition(*keys, "_span").sortWithinPartitions(*keys, "_span", "_last").drop("_last")
    numbers = {"cer_route", *(f"_e{i}" for i in range(len(evidence))), *(f"_m{i}" for i in range(len(quality)))}

    def ranked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[dict[str, np.ndarray]] = []
        now = None

        def flush() -> dict[str, np.ndarray]:
            g = held[0] if len(held) == 1 else {n: np.concatenate([h[n] for h in held]) for n in held[0]}
            won = elimination(g["cer_route"], [(g[f"_e{i}"], m) for i, m in enumerate(evidence)], [(g[f"_m{i}"], m) for i, m in enumerate(quality)], g["_enhanced"] if prefer else None, delta)
            return {n: g[n][won] for n in (*keys, "candidate_id")} | {"stage_rank": g["_before"][won] + np.arange(1, len(won) + 1)}

        for pdf in batches:
            cols = {n: pdf[n].to_numpy(dtype="float64" if n in numbers else None) for n in pdf.columns}
            done, at = [], 0
            for key, run in groupby(zip(*(cols[k].tolist() for k in keys), cols["_span"].tolist(), strict=True)):
                if held and key != now:
                    done.append(flush())
                    held.clear()
                now, end = key, at + sum(1 for _ in run)
                held.append({n: v[at:end] for n, v in cols.items()})
                at = end
            if done:
                yield pd.DataFrame({n: np.concatenate([x[n] for x in done]) for n in done[0]})
        if held:
            yield pd.DataFrame(flush())

    return clustered.mapInPandas(ranked, ", ".join(f"{k} {kinds[k]}" for k in (*keys, "candidate_id")) + ", stage_rank int")
