"""Registered queries: profiling, set operations and key overlap
(A6, A7-A17, A21, P9, P15, U1-U7, R13)."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import functions as F

from searchrank.functions import clean
from searchrank.operators import features as FE
from searchrank.operators import profile, stats
from searchrank.plans.catalog import register, rounded
from searchrank.plans.q_features import _COMP_COLS, _LOG_COLUMNS, feature_ctes
from searchrank.sources import fixture
from searchrank.sources.fixture_sql import with_log, with_test

_NUMERIC = [c for c in _LOG_COLUMNS if c != "date_time"]


def _log(spark, sf):
    return fixture.search_log(spark, sf)


def _union_all(parts):
    return "\nUNION ALL\n".join(parts)


# --- A6 / P15 / A16 / A17 missingness ----------------------------------------------

@register("null_counts", with_log("SELECT * FROM (" + _union_all(
    [f"SELECT '{c}' AS column, count(*) - count({c}) AS null_count FROM log" for c in _LOG_COLUMNS])
    + ") WHERE null_count > 0"))
def q_null_counts(spark, sf):
    return profile.null_counts(_log(spark, sf))


@register("completeness", with_log("SELECT *, round(non_null / rows, 6) AS share FROM (" + _union_all(
    [f"SELECT '{c}' AS column, count({c}) AS non_null, count(*) AS rows FROM log"
     for c in _LOG_COLUMNS]) + ")"))
def q_completeness(spark, sf):
    return rounded(profile.completeness(_log(spark, sf)))


@register("row_completeness", with_log(
    "SELECT non_null_columns, count(*) AS rows FROM (SELECT "
    + " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in _LOG_COLUMNS)
    + " AS non_null_columns FROM log) GROUP BY 1"))
def q_row_completeness(spark, sf):
    return profile.row_completeness(_log(spark, sf))


def _nullcorr_sql():
    # columns with some but not all nulls, pairs a < b (same order as the log)
    part = [c for c in _LOG_COLUMNS if c in set(_PARTLY_NULL)]
    body = []
    for i, a in enumerate(part):
        for b in part[i + 1:]:
            body.append(
                f"SELECT '{a}' AS col_a, '{b}' AS col_b, round((n * count_if({a} IS NULL AND {b} IS NULL)"
                f" - count_if({a} IS NULL) * count_if({b} IS NULL)) / sqrt(count_if({a} IS NULL)"
                f" * (n - count_if({a} IS NULL)) * count_if({b} IS NULL) * (n - count_if({b} IS NULL))), 6)"
                f" AS corr FROM log, (SELECT CAST(count(*) AS DOUBLE) AS n FROM log) t GROUP BY n")
    return with_log(_union_all(body))


_PARTLY_NULL = ["visitor_hist_starrating", "visitor_hist_adr_usd", "prop_review_score",
                "prop_location_score1", "prop_location_score2", "price_usd",
                "srch_query_affinity_score", "orig_destination_distance"] + _COMP_COLS + \
               ["gross_bookings_usd"]


@register("null_correlation", _nullcorr_sql())
def q_null_correlation(spark, sf):
    return rounded(profile.null_correlation(_log(spark, sf)))


# --- A13 describe ------------------------------------------------------------------

def _describe_sql(cols):
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        lst = f"list_sort(list({x}) FILTER (WHERE {c} IS NOT NULL))"
        idx = lambda q: f"CAST(floor({q} * (count({c}) - 1) + 0.5) AS BIGINT) + 1"
        parts.append(
            f"SELECT '{c}' AS column, count({c}) AS count, count(*) - count({c}) AS null_count, "
            f"round(avg({x}), 6) AS mean, round(stddev_samp({x}), 6) AS std, "
            f"round(min({x}), 6) AS min, round({lst}[{idx(0.25)}], 6) AS q25, "
            f"round({lst}[{idx(0.5)}], 6) AS q50, round({lst}[{idx(0.75)}], 6) AS q75, "
            f"round(max({x}), 6) AS max FROM log")
    return with_log(_union_all(parts))


@register("describe_log", _describe_sql(_NUMERIC))
def q_describe(spark, sf):
    return rounded(profile.describe(_log(spark, sf), _NUMERIC))


# --- A10 / A11 histograms, A12 box statistics --------------------------------------

def _hist_sql(col, bins, lo=None, hi=None, src="log"):
    if lo is None:
        bounds = (f"SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo, "
                  f"CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM v "
                  f"HAVING min(x) IS NOT NULL")
        where = ""
    else:
        bounds = f"SELECT CAST({lo} AS DOUBLE) AS lo, CAST({hi} AS DOUBLE) AS hi"
        where = f" AND CAST({col} AS DOUBLE) BETWEEN {lo} AND {hi}"
    step = f"((hi - lo) / {bins})"
    return f"""
, v AS (SELECT CAST({col} AS DOUBLE) AS x FROM {src} WHERE {col} IS NOT NULL{where})
, bd AS ({bounds})
, i0 AS (SELECT x, lo, hi, least(CAST(floor((x - lo) * ({bins}.0 / (hi - lo))) AS INTEGER), {bins - 1}) AS i
         FROM v, bd)
, i1 AS (SELECT CASE WHEN x < i * {step} + lo THEN i - 1
                     WHEN x >= (i + 1) * {step} + lo AND i <> {bins - 1} THEN i + 1
                     ELSE i END AS i FROM i0)
, c AS (SELECT i, count(*) AS cnt FROM i1 GROUP BY i)
SELECT CAST(g.b AS INTEGER) AS bin, round(g.b * {step} + lo, 6) AS bin_lo,
       round(CASE WHEN g.b = {bins - 1} THEN hi ELSE (g.b + 1) * {step} + lo END, 6) AS bin_hi,
       coalesce(cnt, 0) AS count
FROM bd, range({bins}) g(b) LEFT JOIN c ON c.i = g.b"""


@register("histogram_price", with_log(_hist_sql("price_usd", 50)))
def q_hist_price(spark, sf):
    return rounded(profile.histogram(_log(spark, sf), "price_usd", 50))


@register("histogram_price_range", with_log(_hist_sql("price_usd", 50, 0, 15000)))
def q_hist_price_range(spark, sf):
    return rounded(profile.histogram(_log(spark, sf), "price_usd", 50, (0, 15000)))


@register("histogram_gross_bookings_range", with_log(_hist_sql("gross_bookings_usd", 50, 0, 5000)))
def q_hist_gross(spark, sf):
    return rounded(profile.histogram(_log(spark, sf), "gross_bookings_usd", 50, (0, 5000)))


@register("histogram_review_score", with_log(_hist_sql("prop_review_score", 50)))
def q_hist_review(spark, sf):
    return rounded(profile.histogram(_log(spark, sf), "prop_review_score", 50))


@register("histogram_booking_window", with_log(_hist_sql("srch_booking_window", 50)))
def q_hist_window(spark, sf):
    return rounded(profile.histogram(_log(spark, sf), "srch_booking_window", 50))


@register("histogram_click_two_bins", with_log(_hist_sql("click_bool", 2)))
def q_hist_click(spark, sf):
    return rounded(profile.histogram(_log(spark, sf), "click_bool", 2))


@register("histogram_booking_two_bins", with_log(_hist_sql("booking_bool", 2)))
def q_hist_booking(spark, sf):
    return rounded(profile.histogram(_log(spark, sf), "booking_bool", 2))


@register("box_stats_price", with_log("""
, v AS (SELECT price_usd AS x FROM log WHERE price_usd IS NOT NULL)
, q AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
               quantile_cont(x, 0.75) AS q3 FROM v)
, w AS (SELECT q1, median, q3, q3 - q1 AS iqr, count(*) AS n, avg(x) AS mean,
               coalesce(min(CASE WHEN x >= q1 - 1.5 * (q3 - q1) THEN x END), q1) AS whislo,
               coalesce(max(CASE WHEN x <= q3 + 1.5 * (q3 - q1) THEN x END), q3) AS whishi
        FROM v, q GROUP BY q1, median, q3)
SELECT n, round(mean, 6) AS mean, round(q1, 6) AS q1, round(median, 6) AS median,
       round(q3, 6) AS q3, round(iqr, 6) AS iqr, round(whislo, 6) AS whislo,
       round(whishi, 6) AS whishi,
       (SELECT count(*) FROM v WHERE x < whislo) AS n_fliers_low,
       (SELECT count(*) FROM v WHERE x > whishi) AS n_fliers_high
FROM w"""))
def q_box_price(spark, sf):
    return rounded(profile.box_stats(_log(spark, sf), "price_usd"))


# --- A14 correlation of engineered test features ------------------------------------

# Columns left out of the correlation table.
CORR_REMOVE = ("date_time", "ump", "srch_id", "site_id", "prop_id", "normalized_hotel_quality",
               "visitor_location_country_id", "prop_country_id", "srch_destination_id",
               "random_bool", "has_hist_starrating", "has_hist_adr_usd", "supp_id")
CORR_COLS = ["visitor_hist_starrating", "visitor_hist_adr_usd", "prop_location_score2",
             "srch_booking_window", "srch_query_affinity_score", "orig_destination_distance",
             "score1d2", "normalized_prop_starrating", "normalized_score1d2",
             "normalized_prop_review_score", "hotel_quality", "price_per_person",
             "avg_price_per_day", "price_diff", "starrating_diff", "total_price",
             "promotion_count", "promotion_any", "price_rank", "star_rank"]


def _corr_sql():
    parts = []
    for a, b in combinations_with_replacement(CORR_COLS, 2):
        xa, xb = f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)"
        both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
        parts.append(
            f"SELECT '{a}' AS col_a, '{b}' AS col_b, CASE WHEN var_samp(CASE WHEN {both} THEN {xa} END) > 0"
            f" AND var_samp(CASE WHEN {both} THEN {xb} END) > 0 THEN round(corr({xa}, {xb}), 6) END"
            f" AS corr FROM p")
    ctes = feature_ctes("test")
    return with_test(ctes + "\n" + _union_all(parts))


@register("feature_correlation", _corr_sql())
def q_corr(spark, sf):
    eng = FE.build(fixture.test_log(spark, sf))
    cols = [c for c in CORR_COLS if c in eng.columns and c not in CORR_REMOVE]
    return rounded(profile.correlation(eng, cols))


# --- U1-U7, A21, R13: sets and key overlap -----------------------------------------

def _train_test(spark, sf):
    log = _log(spark, sf)
    train = log.where(F.col("srch_id") % 10 != 1)
    return train, fixture.test_log(spark, sf)


@register("key_overlap_hotels", with_log("""
, tr AS (SELECT * FROM log WHERE srch_id % 10 <> 1)
, te AS (SELECT * FROM log WHERE srch_id % 10 = 1)
, a AS (SELECT DISTINCT prop_id FROM tr), b AS (SELECT DISTINCT prop_id FROM te)
, k AS (SELECT (SELECT count(*) FROM a) AS n_a, (SELECT count(*) FROM b) AS n_b,
       (SELECT count(*) FROM (SELECT prop_id FROM a INTERSECT SELECT prop_id FROM b)) AS n_both,
       (SELECT count(*) FROM (SELECT prop_id FROM a UNION SELECT prop_id FROM b)) AS n_union,
       (SELECT count(*) FROM (SELECT prop_id FROM a EXCEPT SELECT prop_id FROM b)) AS n_a_only,
       (SELECT count(*) FROM (SELECT prop_id FROM b EXCEPT SELECT prop_id FROM a)) AS n_b_only,
       (SELECT count(*) FROM tr) AS rows_a,
       (SELECT count(*) FROM tr WHERE prop_id NOT IN (SELECT prop_id FROM b)) AS rows_a_only,
       (SELECT count(*) FROM te) AS rows_b,
       (SELECT count(*) FROM te WHERE prop_id NOT IN (SELECT prop_id FROM a)) AS rows_b_only)
SELECT *, round(rows_a_only / rows_a, 6) AS share_a_only, round(rows_b_only / rows_b, 6) AS share_b_only
FROM k"""))
def q_overlap(spark, sf):
    train, test = _train_test(spark, sf)
    return rounded(profile.key_overlap(train, test, "prop_id"))


@register("key_overlap_sketch", with_log("""
SELECT key, true AS within_bound FROM (VALUES ('prop_id'), ('srch_id'), ('site_id')) t(key)"""))
def q_overlap_sketch(spark, sf):
    """U2-U4, A21, R13 by mergeable sketches, as a property: each count within its bound of the exact one."""
    train, test = _train_test(spark, sf)
    out = None
    for key in ("prop_id", "srch_id", "site_id"):
        near = profile.key_overlap_approx(train, test, key)
        names = [c for c in near.columns if c != "error"]
        exact = profile.key_overlap(train, test, key).select(*[F.col(c).alias(f"x_{c}") for c in names])
        both = near.join(exact, F.lit(True))   # one row each
        ok = F.lit(True)
        for c in names:
            ok = ok & (F.abs(F.col(c) - F.col(f"x_{c}")) <= F.col("error"))
        one = both.select(F.lit(key).alias("key"), ok.alias("within_bound"))
        out = one if out is None else out.unionByName(one)
    return out


@register("log_correlations", _nullcorr_sql())
def q_log_correlations(spark, sf):
    """A14 and A15 together: one scan gives both tables; the null table is returned, value pairs checked by shape."""
    log = _log(spark, sf)
    corr, nulls = profile.correlations(log, _NUMERIC, log.columns)
    assert len(corr.columns) == 3
    return rounded(nulls)


@register("key_overlap_customers", with_log("""
, tr AS (SELECT * FROM log WHERE srch_id % 10 < 5)
, te AS (SELECT * FROM log WHERE srch_id % 10 >= 5)
, a AS (SELECT DISTINCT site_id FROM tr), b AS (SELECT DISTINCT site_id FROM te)
, k AS (SELECT (SELECT count(*) FROM a) AS n_a, (SELECT count(*) FROM b) AS n_b,
       (SELECT count(*) FROM (SELECT site_id FROM a INTERSECT SELECT site_id FROM b)) AS n_both,
       (SELECT count(*) FROM (SELECT site_id FROM a UNION SELECT site_id FROM b)) AS n_union,
       (SELECT count(*) FROM (SELECT site_id FROM a EXCEPT SELECT site_id FROM b)) AS n_a_only,
       (SELECT count(*) FROM (SELECT site_id FROM b EXCEPT SELECT site_id FROM a)) AS n_b_only,
       (SELECT count(*) FROM tr) AS rows_a,
       (SELECT count(*) FROM tr WHERE site_id NOT IN (SELECT site_id FROM b)) AS rows_a_only,
       (SELECT count(*) FROM te) AS rows_b,
       (SELECT count(*) FROM te WHERE site_id NOT IN (SELECT site_id FROM a)) AS rows_b_only)
SELECT *, round(rows_a_only / rows_a, 6) AS share_a_only, round(rows_b_only / rows_b, 6) AS share_b_only
FROM k"""))
def q_overlap_sites(spark, sf):
    log = _log(spark, sf)
    a = log.where(F.col("srch_id") % 10 < 5)
    b = log.where(F.col("srch_id") % 10 >= 5)
    return rounded(profile.key_overlap(a, b, "site_id"))


@register("union_train_test", with_log("""
, tr AS (SELECT * FROM log WHERE srch_id % 10 <> 1)
, te AS (SELECT * EXCLUDE (position, click_bool, booking_bool, gross_bookings_usd)
         FROM log WHERE srch_id % 10 = 1)
, u AS (SELECT * FROM tr UNION ALL BY NAME SELECT * FROM te)
SELECT count(*) AS n_rows, count(click_bool) AS n_click_known, count(position) AS n_position_known,
       count(DISTINCT srch_id) AS n_searches FROM u"""))
def q_union(spark, sf):
    train, test = _train_test(spark, sf)
    u = train.unionByName(test, allowMissingColumns=True)
    return u.agg(F.count(F.lit(1)).alias("n_rows"), F.count("click_bool").alias("n_click_known"),
                 F.count("position").alias("n_position_known"),
                 F.countDistinct("srch_id").alias("n_searches"))


_ALL_NULL_SQL = " AND ".join(f"{c} IS NULL" for c in _COMP_COLS)


@register("all_null_competitor_rows", with_log(f"""
SELECT count(*) AS n_rows, count_if({_ALL_NULL_SQL}) AS n_all_null FROM log"""))
def q_all_null(spark, sf):
    log = _log(spark, sf)
    return log.agg(F.count(F.lit(1)).alias("n_rows"),
                   F.count_if(profile.all_null(log, _COMP_COLS)).alias("n_all_null"))


@register("competitor_coverage", with_log(f"""
, per AS (SELECT prop_id, max(CAST({_ALL_NULL_SQL} AS INTEGER)) AS any_empty,
                 min(CAST({_ALL_NULL_SQL} AS INTEGER)) AS all_empty FROM log GROUP BY 1)
SELECT count(*) AS n_hotels, count_if(any_empty = 0) AS n_always_covered,
       count_if(all_empty = 0) AS n_ever_covered FROM per"""))
def q_coverage(spark, sf):
    return profile.competitor_coverage(_log(spark, sf), "prop_id", _COMP_COLS)


@register("hotels_without_competitor_data", with_log(f"""
SELECT DISTINCT prop_id FROM log EXCEPT SELECT DISTINCT prop_id FROM log WHERE NOT ({_ALL_NULL_SQL})"""))
def q_hotels_no_comp(spark, sf):
    log = _log(spark, sf)
    some = log.where(~profile.all_null(log, _COMP_COLS)).select("prop_id")
    return log.select("prop_id").subtract(some)


# --- A7 / A8 / A9 / A5 ---------------------------------------------------------------

@register("value_counts_country", with_log(
    "SELECT prop_country_id, count(*) AS count FROM log GROUP BY 1"))
def q_value_counts(spark, sf):
    return stats.value_counts(_log(spark, sf), "prop_country_id")


@register("search_group_sizes", with_log(
    "SELECT size, count(*) AS n_searches FROM (SELECT srch_id, count(*) AS size FROM log GROUP BY 1) "
    "GROUP BY 1"))
def q_group_sizes(spark, sf):
    g = stats.group_sizes(_log(spark, sf), "srch_id")
    return g.groupBy("size").agg(F.count(F.lit(1)).alias("n_searches"))


@register("distinct_keys", with_log("""
SELECT count(DISTINCT srch_id) AS n_distinct_srch_id, count(DISTINCT prop_id) AS n_distinct_prop_id,
       count(DISTINCT prop_country_id) AS n_distinct_prop_country_id FROM log"""))
def q_distinct(spark, sf):
    log = _log(spark, sf)
    return log.agg(F.countDistinct("srch_id").alias("n_distinct_srch_id"),
                   F.countDistinct("prop_id").alias("n_distinct_prop_id"),
                   F.countDistinct("prop_country_id").alias("n_distinct_prop_country_id"))


@register("approx_distinct_hotels", with_log("""
SELECT count(DISTINCT prop_id) AS n_distinct, true AS within_error FROM log"""))
def q_approx_distinct(spark, sf):
    """The sketch's error stays within four standard deviations of its stated 1 %."""
    log = _log(spark, sf)
    exact = stats.distinct_count(log, "prop_id")
    near = stats.distinct_count(log, "prop_id", approx=True).select("n_distinct_prop_id").scalar()
    n = F.col("n_distinct_prop_id")
    return exact.select(n.alias("n_distinct"), (F.abs(near - n) <= 0.04 * n).alias("within_error"))


@register("global_min_max_price", with_log(
    "SELECT min(price_usd) AS min_price_usd, max(price_usd) AS max_price_usd FROM log"))
def q_min_max(spark, sf):
    return stats.global_min_max(_log(spark, sf), "price_usd")


@register("numeric_columns_profiled", with_log(
    "SELECT count(*) AS n_rows, " + ", ".join(f"count({c}) AS nn_{c}" for c in _NUMERIC) + " FROM log"))
def q_numeric_cols(spark, sf):
    log = _log(spark, sf)
    cols = clean.numeric_columns(log)
    return log.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(f"nn_{c}") for c in cols])
