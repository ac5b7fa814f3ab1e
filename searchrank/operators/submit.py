"""Ordered outputs per search and their integrity checks.

A submission lists, for every search, its hotels best-first.  The order
is carried in an explicit ``rank`` column (it would not survive a
distributed write otherwise) and the written files are range-partitioned
by ``(srch_id, rank)`` so that reading them back in file order gives the
global order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchrank.operators.sequence import row_number_within


def ranked(df: DataFrame, score: str = "pred", by: str = "srch_id", item: str = "prop_id",
           tiebreak: Sequence[str] = ("prop_id",), descending: bool = True) -> DataFrame:
    """(by, item, rank): items of each search by ``score`` (best first)."""
    first = F.col(score).desc_nulls_last() if descending else F.col(score).asc_nulls_last()
    order = [first] + [F.col(c).asc_nulls_last() for c in tiebreak]
    cols = list(dict.fromkeys([by, item, score, *tiebreak]))
    out = row_number_within(df.select(*cols), by, order, out="rank")
    return out.select(by, item, "rank")


def baseline(df: DataFrame, by: str = "srch_id", item: str = "prop_id",
             score: str = "price_per_person", tiebreak: Sequence[str] = ("prop_id",)) -> DataFrame:
    """Order by a single feature, highest first (price per person by default)."""
    return ranked(df, score=score, by=by, item=item, tiebreak=tiebreak)


def ideal_order(df: DataFrame, by: str = "srch_id", item: str = "prop_id",
                tiebreak: Sequence[str] = ("prop_id", "position")) -> DataFrame:
    """Hotels of each search by (booked, clicked) descending: the best possible order."""
    order = [F.col("booking_bool").desc(), F.col("click_bool").desc()] + \
            [F.col(c).asc_nulls_last() for c in tiebreak]
    cols = list(dict.fromkeys([by, item, "booking_bool", "click_bool", *tiebreak]))
    out = row_number_within(df.select(*cols), by, order, out="rank")
    return out.select(by, item, "rank")


def check(source: DataFrame, output: DataFrame, by: str = "srch_id",
          item: str = "prop_id") -> DataFrame:
    """One-row integrity report of an ordering against its source.

    rows_in/rows_out must match, every (search, item) pair must survive
    (as a multiset), and ranks must be 1..n inside each search.
    """
    a = source.groupBy(by, item).agg(F.count(F.lit(1)).alias("_in"))
    b = output.groupBy(by, item).agg(
        F.count(F.lit(1)).alias("_out"), F.min("rank").alias("_lo"), F.max("rank").alias("_hi"),
        F.count("rank").alias("_ranked"))
    pairs = a.alias("a").join(b.alias("b"), F.col(f"a.{by}").eqNullSafe(F.col(f"b.{by}"))
                              & F.col(f"a.{item}").eqNullSafe(F.col(f"b.{item}")), "full")
    n_in, n_out = F.coalesce("_in", F.lit(0)), F.coalesce("_out", F.lit(0))
    per = pairs.groupBy(F.coalesce(f"a.{by}", f"b.{by}").alias("_by")).agg(
        F.sum(n_in).alias("rows_in"), F.sum(n_out).alias("n"),
        F.sum(F.greatest(n_in - n_out, F.lit(0))).alias("missing"),
        F.sum(F.greatest(n_out - n_in, F.lit(0))).alias("extra"), F.sum("_ranked").alias("ranked"),
        F.min("_lo").alias("lo"), F.max("_hi").alias("hi"))
    # ranks 1..n: as many as rows, from 1 to n, none twice
    good = (F.col("lo") == 1) & (F.col("hi") == F.col("n")) & (F.col("ranked") == F.col("n"))
    double = output.groupBy(by, "rank").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(by).distinct()
    per = per.join(double.select(F.col(by).alias("_dup"), F.lit(True).alias("_double")),
                   F.col("_by").eqNullSafe(F.col("_dup")), "left")
    bad = (F.col("n") > 0) & (~F.coalesce(good, F.lit(False)) | F.col("_double").isNotNull())
    zero = F.lit(0).cast("long")
    return per.agg(F.coalesce(F.sum("rows_in"), zero).alias("rows_in"),
                   F.coalesce(F.sum("n"), zero).alias("rows_out"),
                   F.coalesce(F.sum("missing"), zero).alias("missing_pairs"),
                   F.coalesce(F.sum("extra"), zero).alias("extra_pairs"),
                   F.count_if(bad).alias("bad_rank_searches"))


def write_submission(df: DataFrame, path: str, by: str = "srch_id", fmt: str = "csv",
                     num_files: int | None = None) -> None:
    """Write (by, item, rank) sorted by (by, rank) across range-partitioned files."""
    keys = [F.col(by), F.col("rank")]
    out = (df.repartitionByRange(num_files, *keys) if num_files
           else df.repartitionByRange(*keys)).sortWithinPartitions(*keys)
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
