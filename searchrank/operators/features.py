"""Feature engineering of the search log.

Plan shape at scale
-------------------
* Per-country first quartiles: exact order statistics from pre-aggregated
  value counts (``stats.group_quantile``); the result has one row per
  country and reaches the rows through a join that AQE turns into a
  broadcast once it has measured the table.
* Every per-search statistic (three means and standard deviations, the
  promotion sum and max) of the single steps comes from ONE ``groupBy(srch_id)``
  with partial aggregation and ONE join back, in which a hot search is split.
* ``build`` counts the rows of each search.  Searches of at most a partition's
  share meet in one shuffle, where windows take ranks and statistics; the others
  keep the split joins, and their dense ranks come from the distinct (search,
  value) pairs, ranked by a global range sort (``sequence.dense_rank_within``).
* ``build`` writes the row-level table once and reads the sparse-column
  null counts as observed metrics of that write; country quartiles come from
  the written rows, so the log is derived once; the min/max of
  ``hotel_quality`` is one pass over five narrow columns and enters the
  scaling as literals.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchrank.functions import clean
from searchrank.operators import stats
from searchrank.operators.sequence import _null_safe, dense_rank_within, row_number_within
from searchrank.operators.skew import cut, hot_searches, join_statistics

# Fixed values of the feature recipe.
SPARSE_THRESHOLD = 0.9
SPARSE_KEEP = ("visitor_hist_starrating", "visitor_hist_adr_usd",
               "srch_query_affinity_score", "gross_bookings_usd")
IMPUTE_COLUMNS = ("prop_location_score2", "prop_location_score1")
IMPUTE_BY = "prop_country_id"
IMPUTE_Q = 0.25
#: Countries up to which the staged quantile table is broadcast.
QUANTILE_ROWS = 100_000
RATIO_EPS = 0.0001
ZSCORE_EPS = 0.00001
ZSCORE_COLUMNS = ("prop_starrating", "score1d2", "prop_review_score")
QUALITY_WEIGHTS = {
    "normalized_prop_starrating": 0.3,
    "normalized_score1d2": 0.4,
    "normalized_prop_review_score": 0.3,
}
SOURCE_DROP = ("prop_location_score1", "prop_starrating", "prop_review_score", "price_usd",
               "srch_room_count", "prop_log_historical_price", "srch_length_of_stay",
               "srch_children_count", "srch_adults_count", "room_count", "promotion_flag")


# --- single steps -------------------------------------------------------------

def has_history(df: DataFrame) -> DataFrame:
    """Not-null flags of the visitor history columns."""
    return (df.withColumn("has_hist_starrating",
                          F.col("visitor_hist_starrating").isNotNull().cast("int"))
              .withColumn("has_hist_adr_usd", F.col("visitor_hist_adr_usd").isNotNull().cast("int")))


def country_quantiles(df: DataFrame, cols: Sequence[str] = IMPUTE_COLUMNS, by: str = IMPUTE_BY,
                      q: float = IMPUTE_Q, method: str = "nearest") -> DataFrame:
    """(by, <col>_q...) quantile table used for imputation (A1)."""
    return stats.group_quantile(df, by, list(cols), q, method, suffix="_q")


def impute_group_quantile(df: DataFrame, cols: Sequence[str] = IMPUTE_COLUMNS,
                          by: str = IMPUTE_BY, q: float = IMPUTE_Q, method: str = "nearest",
                          table: DataFrame | None = None) -> DataFrame:
    """Fill nulls of ``cols`` with their group's quantile (F1).

    A group without any value keeps its nulls.  ``table`` lets a test set
    reuse quantiles fitted on the training set.
    """
    table = table if table is not None else country_quantiles(df, cols, by, q, method)
    j = df.join(table, by, "left")
    out = [F.coalesce(F.col(c), F.col(f"{c}_q")).alias(c) if c in cols else F.col(c)
           for c in df.columns]
    return j.select(*out)


def location_ratio(df: DataFrame) -> DataFrame:
    """score1d2 = (score2 + eps) / (score1 + eps), NaN scores as 0 (F2)."""
    s2 = F.nanvl(F.col("prop_location_score2"), F.lit(0.0))
    s1 = F.nanvl(F.col("prop_location_score1"), F.lit(0.0))
    return _ratio(df.withColumn("prop_location_score2", s2).withColumn("prop_location_score1", s1))


def _ratio(df: DataFrame) -> DataFrame:
    return df.withColumn("score1d2", F.try_divide(F.col("prop_location_score2") + RATIO_EPS,
                                                  F.col("prop_location_score1") + RATIO_EPS))


def zero_fill(df: DataFrame, cols: Sequence[str] = ZSCORE_COLUMNS) -> DataFrame:
    """Null -> 0 before normalising."""
    return clean.fill_null(df, {c: 0.0 for c in cols})


def _search_stat_exprs(zcols: Sequence[str], promo: str | None) -> list[Column]:
    aggs = []
    for c in zcols:
        aggs += [F.avg(c).alias(f"_mean_{c}"), F.stddev_samp(c).alias(f"_std_{c}")]
    if promo:
        aggs += [F.sum(promo).cast("long").alias("promotion_count"),
                 (F.max(promo) > 0).cast("int").alias("promotion_any")]
    return aggs


def _zscore_cols(zcols: Sequence[str], eps: float) -> list[Column]:
    return [((F.col(c) - F.col(f"_mean_{c}")) / (F.col(f"_std_{c}") + eps)).alias(f"normalized_{c}")
            for c in zcols]


def _statistics(df: DataFrame, by: str, zcols: Sequence[str], promo: str | None) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("_rows"), *_search_stat_exprs(zcols, promo))


def _staged_statistics(df: DataFrame, by: str, zcols: Sequence[str], promo: str | None) -> DataFrame:
    from searchrank.sources.io import materialize
    return materialize(_statistics(df, by, zcols, promo), "search-statistics")


def search_statistics(df: DataFrame, by: str = "srch_id", zcols: Sequence[str] = ZSCORE_COLUMNS,
                      promo: str | None = "promotion_flag", eps: float = ZSCORE_EPS) -> DataFrame:
    """z-scores of ``zcols`` and promotion count/any per search, one pass.

    A one-row search has no sample deviation, so its z-scores are null; rows
    without a search are one search.  The statistics are written once, one row
    per search, and a hot search is split when they are joined back.
    """
    st = _staged_statistics(df, by, zcols, promo)
    j = join_statistics(df, st, by)
    extra = _zscore_cols(zcols, eps) + ([F.col("promotion_count"), F.col("promotion_any")]
                                        if promo else [])
    return j.select(*[F.col(c) for c in df.columns], *extra)


def zscore_within(df: DataFrame, cols: Sequence[str] = ZSCORE_COLUMNS, by: str = "srch_id",
                  eps: float = ZSCORE_EPS) -> DataFrame:
    return search_statistics(df, by, cols, None, eps)


def promotion_features(df: DataFrame, by: str = "srch_id", flag: str = "promotion_flag") -> DataFrame:
    return join_statistics(df, _staged_statistics(df, by, (), flag), by)


def weighted_sum(df: DataFrame, weights: dict[str, float] = QUALITY_WEIGHTS,
                 out: str = "hotel_quality") -> DataFrame:
    """sum(col * weight); null when any input is null."""
    terms = [F.col(c) * w for c, w in weights.items()]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return df.withColumn(out, total)


def minmax(df: DataFrame, col: str = "hotel_quality", out: str | None = None,
           bounds: tuple[float, float] | None = None) -> DataFrame:
    """(x - min) / (max - min) over the whole frame; null when max == min.

    ``bounds`` are known (min, max) values; otherwise they come from a
    one-row aggregate used as scalar subqueries.
    """
    out = out or f"normalized_{col}"
    if bounds is not None:
        lo, hi = F.lit(bounds[0]).cast("double"), F.lit(bounds[1]).cast("double")
    else:
        lo = df.agg(F.min(col)).scalar()
        hi = df.agg(F.max(col)).scalar()
    return df.withColumn(out, F.try_divide(F.col(col) - lo, hi - lo))


def price_features(df: DataFrame) -> DataFrame:
    """price_per_person, avg_price_per_day, ump, price_diff, starrating_diff,
    total_price (F7-F12).  Division by zero gives null."""
    return df.select("*", *_price_cols(_total_price()).values())


def _total_price() -> Column:
    return F.col("price_usd") * F.col("srch_room_count")


def _price_cols(total: Column) -> dict[str, Column]:
    """The price features by name, from the row's total price."""
    price = F.col("price_usd")
    guests = F.coalesce(F.col("srch_adults_count") + F.col("srch_children_count"), F.lit(1))
    cols = {
        "price_per_person": F.try_divide(total, guests),
        "avg_price_per_day": F.try_divide(price, F.col("srch_length_of_stay")),
        "ump": F.exp("prop_log_historical_price") - price,
        "price_diff": F.col("visitor_hist_adr_usd") - price,
        "starrating_diff": F.col("visitor_hist_starrating") - F.col("prop_starrating"),
        "total_price": total,
    }
    return {n: c.alias(n) for n, c in cols.items()}


def rank_features(df: DataFrame, by: str = "srch_id") -> DataFrame:
    """price_rank (cheapest = 1) and star_rank (most stars = 1), dense.

    Both ranks come from ONE global range sort: the distinct (search, value)
    pairs of the two columns are stacked (stars negated, so ascending order
    serves both), numbered per (search, column), and joined back per column.
    The numbering pass is staged once by ``row_number_within``, so the two
    joins read the same written ranks instead of sorting twice.
    """
    price, star = _ranks(df, by)
    out = _null_safe(_null_safe(df, price, [by, "price_usd"], "left"), star, [by, "prop_starrating"], "left")
    return out.select(*df.columns, "price_rank", "star_rank")


def _ranks(df: DataFrame, by: str) -> tuple[DataFrame, DataFrame]:
    """(by, price_usd, price_rank) and (by, prop_starrating, star_rank), a row per value."""
    price = (df.select(by, F.col("price_usd").alias("_v")).where(F.col("_v").isNotNull())
               .distinct().withColumn("_c", F.lit(0)))
    star = (df.select(by, (-F.col("prop_starrating")).alias("_v")).where(F.col("_v").isNotNull())
              .distinct().withColumn("_c", F.lit(1)))
    ranked = row_number_within(price.unionByName(star), [by, "_c"], [F.col("_v").asc()], out="_r")
    return (ranked.where(F.col("_c") == 0).select(by, F.col("_v").alias("price_usd"), F.col("_r").alias("price_rank")),
            ranked.where(F.col("_c") == 1).select(by, (-F.col("_v")).alias("prop_starrating"),
                                                  F.col("_r").alias("star_rank")))


def _search_values(df: DataFrame, st: DataFrame, by: str) -> DataFrame:
    """Per (search, price, stars) of the rows: both ranks and the search's statistics.

    Narrow rows meet the ranks and the statistics here, so that the wide rows
    are shuffled once, to this table, and not to each of the three.
    """
    price, star = _ranks(df, by)
    few = df.select(by, "price_usd", "prop_starrating").distinct()
    few = _null_safe(_null_safe(few, price, [by, "price_usd"], "left"), star, [by, "prop_starrating"], "left")
    return join_statistics(few, st, by)


def _statistic_windows(by: str) -> dict[str, Column]:
    """``_search_stat_exprs`` over each row's search."""
    search = Window.partitionBy(by)
    out = {}
    for c in ZSCORE_COLUMNS:
        out |= {f"_mean_{c}": F.avg(c).over(search), f"_std_{c}": F.stddev_samp(c).over(search)}
    return out | {"promotion_count": F.sum("promotion_flag").over(search).cast("long"),
                  "promotion_any": (F.max("promotion_flag").over(search) > 0).cast("int")}


def _with_statistics(rows: DataFrame, hot: DataFrame, by: str) -> DataFrame:
    """Every row with its search's statistics: by windows, hot searches by a split join."""
    plain, few = cut(rows, hot, by)
    out = plain.withColumns(_statistic_windows(by))
    if few is None:
        return out
    st = _staged_statistics(few, by, ZSCORE_COLUMNS, "promotion_flag")
    return out.unionByName(join_statistics(few, st, by).select(*out.columns))


def _with_search_values(rows: DataFrame, hot: DataFrame, by: str) -> DataFrame:
    """Every row with its score ratio, both ranks and its search's statistics.

    An ordinary search meets in one shuffle, which serves ranks and statistics; the
    ratio is taken behind it, as its sources are the shorter values.  The rows of
    hot searches meet their values in ``_search_values``.
    """
    plain, few = cut(rows, hot, by)
    search = Window.partitionBy(by)
    price, star = F.col("price_usd"), -F.col("prop_starrating")
    plain = zero_fill(_ratio(plain.repartition(F.col(by))), ["score1d2"])
    out = plain.select(
        "*",
        F.when(price.isNotNull(), F.dense_rank().over(search.orderBy(price.asc_nulls_last()))).cast("long").alias("price_rank"),
        F.when(star.isNotNull(), F.dense_rank().over(search.orderBy(star.asc_nulls_last()))).cast("long").alias("star_rank"))
    out = out.withColumns(_statistic_windows(by))
    if few is None:
        return out
    few = zero_fill(_ratio(few), ["score1d2"])
    st = _staged_statistics(few, by, ZSCORE_COLUMNS, "promotion_flag")
    j = _null_safe(few, _search_values(few, st, by), [by, "price_usd", "prop_starrating"], "inner")
    return out.unionByName(j.select(*out.columns))


def final_projection(df: DataFrame) -> DataFrame:
    """Drop source columns and competitor columns (F16); absent names are ignored."""
    return clean.drop_matching(df.drop(*SOURCE_DROP))


# --- the whole recipe ------------------------------------------------------------

@dataclass
class FeatureStats:
    """Statistics fitted on one set and optionally reused on another."""
    dropped: list[str] = field(default_factory=list)
    quantiles: DataFrame | None = None
    bounds: tuple[float, float] | None = None


def _with_scores(df: DataFrame, quant: DataFrame | None, method: str) -> DataFrame:
    """Imputed location scores and their ratio, nulls as zero where z-scores are taken."""
    if quant is not None and quant.count() <= QUANTILE_ROWS:
        quant = F.broadcast(quant)   # wide rows meet it where they are
    out = impute_group_quantile(df, IMPUTE_COLUMNS, IMPUTE_BY, IMPUTE_Q, method, table=quant)
    return zero_fill(location_ratio(out), ZSCORE_COLUMNS)


def _bounds(rows: DataFrame, hot: DataFrame, by: str) -> tuple[float, float]:
    """min/max of hotel_quality over all rows, from the columns it needs."""
    few = rows.select(by, "promotion_flag", *ZSCORE_COLUMNS)
    return tuple(_scored(_with_statistics(few, hot, by), few.columns).agg(F.min("hotel_quality"), F.max("hotel_quality")).first())


def _scored(j: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``cols`` of rows joined to their search's statistics, z-scores, promotions and the weighted quality."""
    extra = _zscore_cols(ZSCORE_COLUMNS, ZSCORE_EPS) + [F.col("promotion_count"), F.col("promotion_any")]
    return weighted_sum(j.select(*[F.col(c) for c in cols], *extra), QUALITY_WEIGHTS, "hotel_quality")


def _written(df: DataFrame, cols: Sequence[Column | str], name: str) -> tuple[DataFrame, list[str]]:
    """``cols`` of ``df``, staged; and the sparse columns of ``df``, counted during the write."""
    from pyspark.sql import Observation

    from searchrank.sources.io import materialize as _write
    obs = Observation(name)
    got = _write(df.observe(obs, F.count(F.lit(1)).alias("_rows"), *clean.null_count_exprs(df.columns)).select(*cols), name, True)
    limit = SPARSE_THRESHOLD * obs.get["_rows"]
    return got, [c for c in df.columns if obs.get[c] > limit and c not in SPARSE_KEEP]


def fit_stats(df: DataFrame, method: str = "nearest", by: str = "srch_id") -> FeatureStats:
    """Sparse-column drop list, country quartiles and quality min/max of a raw log.

    A test set built with them shares columns, imputation and scaling with
    the set they were fitted on.
    """
    from searchrank.sources.io import materialize as _write
    # the few columns that the statistics need are written once, and all null counts observed meanwhile
    few, dropped = _written(has_history(df), [by, "promotion_flag", IMPUTE_BY, *IMPUTE_COLUMNS,
                                              "prop_starrating", "prop_review_score"], "fit-rows")
    q = _write(country_quantiles(few, IMPUTE_COLUMNS, IMPUTE_BY, IMPUTE_Q, method), "country-quantiles")
    return FeatureStats(dropped=dropped, quantiles=q, bounds=_bounds(_with_scores(few, q, method), hot_searches(few, by), by))


def build(df: DataFrame, fitted: FeatureStats | None = None, method: str = "nearest",
          materialize: bool = True, by: str = "srch_id") -> DataFrame:
    """Raw log -> engineered table (F1-F16).

    Without ``fitted`` every statistic is fitted on ``df`` itself.

    Jobs: (1) the rows are written once, projected to the columns that are
    still needed; the raw null counts that decide the sparse-column drop are
    *observed* during that write.  (2) the country quartiles, from the written
    files, unless fitted.  (3) the rows of each search, counted (partial aggregation),
    which name the hot ones.  (4) the min/max of
    hotel_quality, from the few columns it needs, unless fitted.  The wide rows
    are shuffled once, where ranks and statistics are taken by windows (hot searches:
    by split joins); the imputation, the
    price features, the normalisation and the final projection stay lazy.  With
    ``materialize=False`` only the counts are written here.
    """
    from searchrank.sources.io import materialize as _write

    out = has_history(df)
    raw_cols = list(out.columns)
    dropped, quant, bounds = ((fitted.dropped, fitted.quantiles, fitted.bounds) if fitted is not None
                              else (None, None, None))
    if materialize:
        # the room count is only read for the total price
        keep = [c for c in clean.drop_matching(out).columns if c not in ("srch_room_count", "room_count")]
        keep.append(_total_price().alias("total_price"))
        if dropped is None:
            out, dropped = _written(out, keep, "features-rows")
        else:
            out = _write(out.select(*keep), "features-rows", True)
        if quant is None:
            quant = _write(country_quantiles(out, IMPUTE_COLUMNS, IMPUTE_BY, IMPUTE_Q, method), "country-quantiles")
    else:
        if dropped is None:
            _, dropped = clean.drop_sparse(out, SPARSE_THRESHOLD, SPARSE_KEEP)
        out = out.withColumn("total_price", _total_price())
    hot = hot_searches(out, by)
    out = _with_scores(out, quant, method)
    if bounds is None and materialize:
        bounds = _bounds(out, hot, by)
    late = _price_cols(F.col("total_price"))
    names = [c for c in raw_cols if c in out.columns and c not in SOURCE_DROP] + ["score1d2", *late]
    # sources of the features are read after the shuffle, whether they are sparse or not
    sources = [c for c in out.columns if c in SOURCE_DROP and c != "promotion_flag"]
    kept = [c for c in names if c not in dropped or c in ("visitor_hist_adr_usd", "visitor_hist_starrating")]
    rows = out.select(*dict.fromkeys([*[c for c in kept if c not in late and c != "score1d2"], *sources,
                                      "prop_location_score2", "promotion_flag", "total_price"]))
    j = _with_search_values(rows, hot, by).withColumns({n: c for n, c in late.items() if n != "total_price"})
    out = _scored(j, [*kept, "prop_starrating", "prop_review_score", "price_rank", "star_rank"])
    out = minmax(out, "hotel_quality", "normalized_hotel_quality", bounds=bounds)
    return final_projection(out.drop(*dropped))
