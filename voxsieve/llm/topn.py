"""The best N items of every group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_scores(rows: DataFrame, group: str, item: str, score: str, excluded_if_set: str | None = None) -> DataFrame:
    """One row ``group_key, item, score`` per item of a group with its lowest finite score.

    Rows without group, item or finite score, and rows whose ``excluded_if_set`` is set, are left out. Copies of an item are
    combined before the shuffle, which hashes on group and item, so neither a big group nor a much copied item
    meets in one task.
    """
    if excluded_if_set:
        rows = rows.where(F.col(excluded_if_set).isNull())
    finite = F.col(score).isNotNull() & ~F.isnan(score) & (F.abs(score) < float("inf"))
    kept = rows.where(finite & F.col(group).isNotNull() & F.col(item).isNotNull())
    # adding 0.0 turns -0.0 into 0.0, so that the two tie
    return kept.groupBy(F.col(group).alias("group_key"), F.col(item).alias("item")).agg(F.min(F.col(score) + F.lit(0.0)).alias("score"))


def top_n(scores: DataFrame, n: int) -> DataFrame:
    """``group_key, item, score, rank_no`` of the ``n`` lowest scores per group; ties by ``item`` in code-point order.

    Ranks come from a SQL row_number with a rank filter, which the optimiser turns into a group limit: each task passes
    on at most ``n`` rows of a group to the shuffle, and the limit is applied once more after it. Groups with fewer items give fewer rows; an empty
    table gives none. ``n`` < 1 gives none.
    """
    return scores.sparkSession.sql(
        """
        SELECT group_key, item, score, rank_no
        FROM (SELECT *, row_number() OVER (PARTITION BY group_key ORDER BY score ASC, item ASC) AS rank_no FROM {scores})
        WHERE rank_no <= {n}
        """,
        scores=scores,
        n=n,
    )
