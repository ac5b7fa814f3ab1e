"""Registered queries: cleaning rules and engineered features."""

from __future__ import annotations

from pyspark.sql import functions as F

from searchrank.functions import clean
from searchrank.operators import features as FE
from searchrank.operators import stats
from searchrank.plans.catalog import register, rounded
from searchrank.sources import fixture
from searchrank.sources.fixture_sql import with_log

R = 6  # rounding digits of the oracles

_COMP_COLS = [f"comp{k}_{p}" for k in range(1, 9) for p in ("rate", "inv", "rate_percent_diff")]
_SRC_DROP = [c for c in FE.SOURCE_DROP if c != "room_count"]


def _nearest_sql(col: str, name: str, q: float = 0.25, src: str = "b") -> str:
    return f"""
, v_{name} AS (SELECT prop_country_id, {col} AS x,
                      row_number() OVER (PARTITION BY prop_country_id ORDER BY {col}) - 1 AS i,
                      count(*) OVER (PARTITION BY prop_country_id) AS n
               FROM {src} WHERE {col} IS NOT NULL)
, {name} AS (SELECT prop_country_id, max(CASE WHEN i = floor({q} * (n - 1) + 0.5) THEN x END) AS {name}
             FROM v_{name} GROUP BY 1)"""


def feature_ctes(source: str = "log") -> str:
    """CTE chain of the engineered table of ``source``, ending in "p" (all columns, nothing dropped)."""
    return f"""
, b AS (SELECT *, CAST(visitor_hist_starrating IS NOT NULL AS INTEGER) AS has_hist_starrating,
               CAST(visitor_hist_adr_usd IS NOT NULL AS INTEGER) AS has_hist_adr_usd FROM {source})""" + _nearest_sql("prop_location_score2", "q2") + _nearest_sql("prop_location_score1", "q1") + """
, imp AS (SELECT b.* REPLACE (coalesce(b.prop_location_score2, q2.q2) AS prop_location_score2,
                             coalesce(b.prop_location_score1, q1.q1) AS prop_location_score1)
          FROM b LEFT JOIN q2 ON b.prop_country_id = q2.prop_country_id
                 LEFT JOIN q1 ON b.prop_country_id = q1.prop_country_id)
, r AS (SELECT *, (prop_location_score2 + 0.0001) / nullif(prop_location_score1 + 0.0001, 0) AS score1d2
        FROM imp)
, z AS (SELECT * REPLACE (coalesce(prop_starrating, 0) AS prop_starrating,
                          coalesce(prop_review_score, 0) AS prop_review_score,
                          coalesce(score1d2, 0) AS score1d2) FROM r)
, s AS (SELECT srch_id, avg(prop_starrating) AS m1, stddev_samp(prop_starrating) AS s1,
               avg(score1d2) AS m2, stddev_samp(score1d2) AS s2,
               avg(prop_review_score) AS m3, stddev_samp(prop_review_score) AS s3,
               CAST(sum(promotion_flag) AS BIGINT) AS promotion_count,
               CAST(max(promotion_flag) > 0 AS INTEGER) AS promotion_any
        FROM z GROUP BY 1)
, f AS (SELECT z.*, (prop_starrating - m1) / (s1 + 0.00001) AS normalized_prop_starrating,
               (score1d2 - m2) / (s2 + 0.00001) AS normalized_score1d2,
               (prop_review_score - m3) / (s3 + 0.00001) AS normalized_prop_review_score,
               promotion_count, promotion_any
        FROM z JOIN s ON z.srch_id = s.srch_id)
, q AS (SELECT *, normalized_prop_starrating * 0.3 + normalized_score1d2 * 0.4
                  + normalized_prop_review_score * 0.3 AS hotel_quality FROM f)
, mm AS (SELECT min(hotel_quality) AS lo, max(hotel_quality) AS hi FROM q)
, p AS (SELECT q.*, (hotel_quality - lo) / nullif(hi - lo, 0) AS normalized_hotel_quality,
          price_usd * srch_room_count
            / nullif(coalesce(srch_adults_count + srch_children_count, 1), 0) AS price_per_person,
          price_usd / nullif(srch_length_of_stay, 0) AS avg_price_per_day,
          exp(prop_log_historical_price) - price_usd AS ump,
          visitor_hist_adr_usd - price_usd AS price_diff,
          visitor_hist_starrating - prop_starrating AS starrating_diff,
          price_usd * srch_room_count AS total_price,
          CASE WHEN price_usd IS NOT NULL THEN
            dense_rank() OVER (PARTITION BY srch_id ORDER BY price_usd ASC NULLS LAST) END AS price_rank,
          CASE WHEN prop_starrating IS NOT NULL THEN
            dense_rank() OVER (PARTITION BY srch_id ORDER BY prop_starrating DESC NULLS LAST) END
            AS star_rank
        FROM q CROSS JOIN mm)"""


FEATURE_CTES = feature_ctes()


def _round_list(cols):
    return ", ".join(f"round({c}, {R}) AS {c}" for c in cols)


def _engineered_spark(spark, sf):
    return FE.build(fixture.search_log(spark, sf))


ENGINEERED_DROP = ", ".join(_SRC_DROP + _COMP_COLS)
DOUBLE_OUT = ["visitor_hist_starrating", "visitor_hist_adr_usd", "prop_location_score2",
              "srch_query_affinity_score", "orig_destination_distance", "gross_bookings_usd",
              "score1d2", "normalized_prop_starrating", "normalized_score1d2",
              "normalized_prop_review_score", "hotel_quality", "normalized_hotel_quality",
              "price_per_person", "avg_price_per_day", "ump", "price_diff", "starrating_diff",
              "total_price"]


@register("features_engineered", with_log(FEATURE_CTES + f"""
SELECT * EXCLUDE ({ENGINEERED_DROP}) REPLACE ({_round_list(DOUBLE_OUT)}) FROM p"""))
def q_engineered(spark, sf):
    return rounded(_engineered_spark(spark, sf))


@register("features_has_history", with_log("""
SELECT CAST(visitor_hist_starrating IS NOT NULL AS INTEGER) AS has_hist_starrating,
       CAST(visitor_hist_adr_usd IS NOT NULL AS INTEGER) AS has_hist_adr_usd, count(*) AS n_rows
FROM log GROUP BY 1, 2"""))
def q_has_history(spark, sf):
    d = FE.has_history(fixture.search_log(spark, sf))
    return d.groupBy("has_hist_starrating", "has_hist_adr_usd").agg(F.count(F.lit(1)).alias("n_rows"))


def _sparse_sql():
    from searchrank.sources.fixture_sql import LOG_SELECT  # noqa: F401
    cols = _LOG_COLUMNS + ["has_hist_starrating", "has_hist_adr_usd"]
    keep = ", ".join(f"'{c}'" for c in FE.SPARSE_KEEP)
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, count(*) AS n_rows FROM b"
        for c in cols)
    return with_log(f"""
, b AS (SELECT *, CAST(visitor_hist_starrating IS NOT NULL AS INTEGER) AS has_hist_starrating,
               CAST(visitor_hist_adr_usd IS NOT NULL AS INTEGER) AS has_hist_adr_usd FROM log)
, c AS ({parts})
SELECT column_name, null_count, n_rows,
       null_count > 0.9 * n_rows AND column_name NOT IN ({keep}) AS dropped
FROM c""")


_LOG_COLUMNS = [
    "srch_id", "prop_id", "position", "supp_id", "date_time", "site_id",
    "visitor_location_country_id", "prop_country_id", "srch_destination_id", "random_bool",
    "visitor_hist_starrating", "visitor_hist_adr_usd", "prop_starrating", "prop_review_score",
    "prop_location_score1", "prop_location_score2", "prop_log_historical_price", "price_usd",
    "promotion_flag", "srch_length_of_stay", "srch_booking_window", "srch_adults_count",
    "srch_children_count", "srch_room_count", "srch_query_affinity_score",
    "orig_destination_distance"] + _COMP_COLS + ["click_bool", "booking_bool", "gross_bookings_usd"]


@register("sparse_columns", _sparse_sql())
def q_sparse(spark, sf):
    d = FE.has_history(fixture.search_log(spark, sf))
    rep = clean.sparse_report(d, FE.SPARSE_THRESHOLD, FE.SPARSE_KEEP)
    return rep.select(F.col("column").alias("column_name"), "null_count",
                      F.col("rows").alias("n_rows"), "dropped")


@register("country_quartiles", with_log(
    _nearest_sql("prop_location_score2", "q2", src="log")
    + _nearest_sql("prop_location_score1", "q1", src="log") + """
SELECT coalesce(q2.prop_country_id, q1.prop_country_id) AS prop_country_id,
       q2 AS prop_location_score2_q, q1 AS prop_location_score1_q
FROM q2 FULL OUTER JOIN q1 ON q2.prop_country_id = q1.prop_country_id"""))
def q_country_quartiles(spark, sf):
    return FE.country_quantiles(fixture.search_log(spark, sf))


@register("country_quartiles_linear", with_log("""
SELECT prop_country_id,
       round(quantile_cont(prop_location_score2, 0.25), 6) AS prop_location_score2_q,
       round(quantile_cont(prop_location_score1, 0.25), 6) AS prop_location_score1_q
FROM log GROUP BY 1"""))
def q_country_quartiles_linear(spark, sf):
    return rounded(FE.country_quantiles(fixture.search_log(spark, sf), method="linear"))


@register("price_quantiles_by_country", with_log("""
SELECT prop_country_id, q, round(value, 6) AS value FROM (
  SELECT prop_country_id, CAST(0.1 AS DOUBLE) AS q, quantile_disc(price_usd, 0.1) AS value FROM log GROUP BY 1
  UNION ALL
  SELECT prop_country_id, CAST(0.5 AS DOUBLE), quantile_cont(price_usd, 0.5) FROM log GROUP BY 1
  UNION ALL
  SELECT prop_country_id, CAST(0.9 AS DOUBLE), quantile_cont(price_usd, 0.9) FROM log GROUP BY 1)"""))
def q_price_quantiles(spark, sf):
    log = fixture.search_log(spark, sf)
    lo = stats.quantiles_long(log, ["prop_country_id"], ["price_usd"], [0.1], "disc")
    hi = stats.quantiles_long(log, ["prop_country_id"], ["price_usd"], [0.5, 0.9], "linear")
    out = lo.unionByName(hi).select("prop_country_id", F.round("q", 1).alias("q"), "value")
    return rounded(out)


@register("impute_location_scores", with_log(FEATURE_CTES + """
SELECT srch_id, position, round(prop_location_score1, 6) AS prop_location_score1,
       round(prop_location_score2, 6) AS prop_location_score2 FROM imp"""))
def q_impute(spark, sf):
    d = FE.impute_group_quantile(fixture.search_log(spark, sf))
    return rounded(d.select("srch_id", "position", "prop_location_score1", "prop_location_score2"))


@register("location_ratio", with_log(FEATURE_CTES + """
SELECT srch_id, position, round(score1d2, 6) AS score1d2 FROM r"""))
def q_ratio(spark, sf):
    d = FE.location_ratio(FE.impute_group_quantile(fixture.search_log(spark, sf)))
    return rounded(d.select("srch_id", "position", "score1d2"))


@register("search_zscores", with_log(FEATURE_CTES + """
SELECT srch_id, position, round(normalized_prop_starrating, 6) AS normalized_prop_starrating,
       round(normalized_score1d2, 6) AS normalized_score1d2,
       round(normalized_prop_review_score, 6) AS normalized_prop_review_score FROM f"""))
def q_zscores(spark, sf):
    d = FE.impute_group_quantile(fixture.search_log(spark, sf))
    d = FE.zero_fill(FE.location_ratio(d))
    d = FE.zscore_within(d)
    return rounded(d.select("srch_id", "position", "normalized_prop_starrating",
                            "normalized_score1d2", "normalized_prop_review_score"))


@register("hotel_quality", with_log(FEATURE_CTES + """
SELECT srch_id, position, round(hotel_quality, 6) AS hotel_quality,
       round(normalized_hotel_quality, 6) AS normalized_hotel_quality FROM p"""))
def q_quality(spark, sf):
    d = FE.impute_group_quantile(fixture.search_log(spark, sf))
    d = FE.weighted_sum(FE.zscore_within(FE.zero_fill(FE.location_ratio(d))))
    d = FE.minmax(d, "hotel_quality", "normalized_hotel_quality")
    return rounded(d.select("srch_id", "position", "hotel_quality", "normalized_hotel_quality"))


@register("price_features", with_log(FEATURE_CTES + """
SELECT srch_id, position, round(price_per_person, 6) AS price_per_person,
       round(avg_price_per_day, 6) AS avg_price_per_day, round(ump, 6) AS ump,
       round(price_diff, 6) AS price_diff, round(starrating_diff, 6) AS starrating_diff,
       round(total_price, 6) AS total_price FROM p"""))
def q_price(spark, sf):
    d = FE.price_features(FE.zero_fill(fixture.search_log(spark, sf), ["prop_starrating"]))
    return rounded(d.select("srch_id", "position", "price_per_person", "avg_price_per_day", "ump",
                            "price_diff", "starrating_diff", "total_price"))


@register("promotion_features", with_log("""
SELECT srch_id, CAST(sum(promotion_flag) AS BIGINT) AS promotion_count,
       CAST(max(promotion_flag) > 0 AS INTEGER) AS promotion_any FROM log GROUP BY 1"""))
def q_promotion(spark, sf):
    d = FE.promotion_features(fixture.search_log(spark, sf))
    return d.select("srch_id", "promotion_count", "promotion_any").distinct()


@register("rank_features", with_log(FEATURE_CTES + """
SELECT srch_id, position, price_rank, star_rank FROM p"""))
def q_ranks(spark, sf):
    d = FE.rank_features(FE.zero_fill(fixture.search_log(spark, sf), ["prop_starrating"]))
    return d.select("srch_id", "position", "price_rank", "star_rank")


@register("price_rank_desc", with_log("""
SELECT srch_id, position, CASE WHEN price_usd IS NOT NULL THEN
  dense_rank() OVER (PARTITION BY srch_id ORDER BY price_usd DESC NULLS LAST) END AS price_rank_desc
FROM log"""))
def q_price_rank_desc(spark, sf):
    from searchrank.operators.sequence import dense_rank_within
    d = dense_rank_within(fixture.search_log(spark, sf), "srch_id", "price_usd", True,
                          out="price_rank_desc")
    return d.select("srch_id", "position", "price_rank_desc")


@register("competitor_columns_dropped", with_log(f"""
SELECT count(*) AS n_rows FROM (SELECT * EXCLUDE ({', '.join(_COMP_COLS)}) FROM log)"""))
def q_drop_competitors(spark, sf):
    d = clean.drop_matching(fixture.search_log(spark, sf))
    assert not any(c.startswith("comp") for c in d.columns)
    return d.agg(F.count(F.lit(1)).alias("n_rows"))
