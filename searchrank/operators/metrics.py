"""Ranking metrics: positions by score, DCG@k, NDCG@k and their means.

Discount (``first_two_undiscounted=True``, the default): position 1 and 2
weigh 1, position p >= 2 weighs 1/log2(p).  With ``False`` position p
weighs 1/log2(p + 1).  Gain is linear (the grade itself).  The ideal DCG
is the DCG of the search's own grades sorted descending; a search whose
ideal DCG is 0 scores 0 and stays in the mean.

Scale: the DCG of the predicted order only needs each search's top k rows,
taken with ``row_number() <= k`` (partial per-group limit before the
shuffle).  The ideal DCG never sorts rows at all: it is derived from the
per-(search, grade) counts, a pre-aggregation that collapses any search to
a handful of rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchrank.operators.sequence import _null_safe, top_k_within

DEFAULT_TIEBREAK = ("prop_id", "position")


def discount(pos: Column, first_two_undiscounted: bool = True) -> Column:
    if first_two_undiscounted:
        return F.when(pos <= 1, F.lit(1.0)).otherwise(1.0 / F.log2(pos.cast("double")))
    return 1.0 / F.log2(pos.cast("double") + 1.0)


def _prefix_discounts(k: int, first_two_undiscounted: bool) -> list[float]:
    """prefix[n] = sum of the discounts of positions 1..n, n = 0..k."""
    out = [0.0]
    for p in range(1, k + 1):
        if first_two_undiscounted:
            d = 1.0 if p == 1 else 1.0 / math.log2(p)
        else:
            d = 1.0 / math.log2(p + 1)
        out.append(out[-1] + d)
    return out


def _order(score: str, tiebreak: Sequence[str], descending: bool = True) -> list[Column]:
    first = F.col(score).desc_nulls_last() if descending else F.col(score).asc_nulls_last()
    return [first] + [F.col(c).asc_nulls_last() for c in tiebreak]


def dcg(df: DataFrame, by: str = "srch_id", score: str = "pred", grade: str = "relevance_grade",
        k: int = 5, first_two_undiscounted: bool = True,
        tiebreak: Sequence[str] = DEFAULT_TIEBREAK, out: str = "dcg") -> DataFrame:
    """DCG@k of each group in descending ``score`` order: (by, out)."""
    top = top_k_within(df.select(by, score, grade, *tiebreak), by,
                       _order(score, tiebreak), k, out="_pos")
    gain = F.col(grade).cast("double") * discount(F.col("_pos"), first_two_undiscounted)
    return top.groupBy(by).agg(F.sum(gain).alias(out))


def ideal_dcg(df: DataFrame, by: str = "srch_id", grade: str = "relevance_grade", k: int = 5,
              first_two_undiscounted: bool = True, out: str = "idcg") -> DataFrame:
    """DCG@k of each group's grades sorted descending, from grade counts."""
    prefix = _prefix_discounts(k, first_two_undiscounted)
    pre = F.array(*[F.lit(x) for x in prefix])
    counts = df.groupBy(by, grade).agg(F.count(F.lit(1)).alias("_n"))
    # rows of a group ordered by grade desc occupy positions (before, before+n]
    w = (Window.partitionBy(by).orderBy(F.col(grade).desc())
               .rowsBetween(Window.unboundedPreceding, -1))
    span = counts.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    lo = F.least(F.col("_before"), F.lit(k)).cast("int")
    hi = F.least(F.col("_before") + F.col("_n"), F.lit(k)).cast("int")
    part = F.col(grade).cast("double") * (F.element_at(pre, hi + 1) - F.element_at(pre, lo + 1))
    return span.groupBy(by).agg(F.sum(part).alias(out))


def ndcg(df: DataFrame, by: str = "srch_id", score: str = "pred", grade: str = "relevance_grade",
         k: int = 5, first_two_undiscounted: bool = True,
         tiebreak: Sequence[str] = DEFAULT_TIEBREAK, out: str = "ndcg") -> DataFrame:
    """NDCG@k per group: (by, dcg, idcg, ndcg); rows without a group are one group."""
    # one projection feeds both branches, so their scans/exchanges are shared
    base = df.select(*dict.fromkeys([by, score, grade, *tiebreak]))
    d = dcg(base, by, score, grade, k, first_two_undiscounted, tiebreak)
    i = ideal_dcg(base, by, grade, k, first_two_undiscounted)
    j = _null_safe(i, d, [by], "left").withColumn("dcg", F.coalesce(F.col("dcg"), F.lit(0.0)))
    val = F.when(F.col("idcg") == 0, F.lit(0.0)).otherwise(F.col("dcg") / F.col("idcg"))
    return j.select(by, "dcg", "idcg", val.alias(out))


def mean_ndcg(df: DataFrame, by: str = "srch_id", score: str = "pred",
              grade: str = "relevance_grade", k: int = 5, first_two_undiscounted: bool = True,
              tiebreak: Sequence[str] = DEFAULT_TIEBREAK, group: Sequence[str] = (),
              out: str = "mean_ndcg") -> DataFrame:
    """Mean NDCG@k over searches, optionally per extra ``group`` columns.

    ``group`` columns must be constant inside a search (e.g. a model name
    or a partition id attached to every row of the search).
    """
    if group:
        per = _ndcg_grouped(df, [by, *group], score, grade, k, first_two_undiscounted, tiebreak)
        return per.groupBy(*group).agg(F.avg("ndcg").alias(out),
                                       F.count(F.lit(1)).alias("n_searches"))
    per = ndcg(df, by, score, grade, k, first_two_undiscounted, tiebreak)
    return per.agg(F.avg("ndcg").alias(out), F.count(F.lit(1)).alias("n_searches"))


def _ndcg_grouped(df, keys, score, grade, k, first_two_undiscounted, tiebreak):
    # composite grouping key: reuse ndcg() on a struct of the keys
    packed = df.withColumn("_g", F.struct(*keys))
    per = ndcg(packed, "_g", score, grade, k, first_two_undiscounted, tiebreak)
    return per.select(*[F.col(f"_g.{c}").alias(c) for c in keys], "ndcg")


def weighted_mean(df: DataFrame, value: str, weight: str, out: str = "weighted_mean") -> DataFrame:
    """sum(value * weight) / sum(weight): e.g. per-partition means weighted by rows."""
    return df.agg((F.sum(F.col(value) * F.col(weight)) / F.sum(F.col(weight))).alias(out))


def add_rank(df: DataFrame, by: str = "srch_id", score: str = "pred",
             tiebreak: Sequence[str] = DEFAULT_TIEBREAK, descending: bool = True,
             out: str = "rank") -> DataFrame:
    """Position of every row in ``score`` order inside its search (skew-safe)."""
    from searchrank.operators.sequence import row_number_within
    return row_number_within(df, by, _order(score, tiebreak, descending), out=out)
