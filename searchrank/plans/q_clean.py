"""Registered queries: readers/writers and cleaning.

The text-polluted log (nullable numeric columns as strings, nulls spelled
NULL / NA / empty) is derived from the driver tables by Spark; parsing it
back must give the original values, which is what the oracles state.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from searchrank.functions import clean
from searchrank.operators import submit
from searchrank.plans.catalog import register, rounded
from searchrank.session import scratch_path
from searchrank.sources import fixture, io
from searchrank.sources.fixture_sql import with_log, with_test

CHECK_COLS = ["price_usd", "visitor_hist_adr_usd", "prop_review_score", "prop_location_score1",
              "srch_query_affinity_score", "orig_destination_distance", "gross_bookings_usd",
              "comp3_rate", "comp3_inv", "comp3_rate_percent_diff"]

_TOKEN_SQL = ("CASE (srch_id + position) % 3 WHEN 0 THEN 'NULL' WHEN 1 THEN 'NA' ELSE '' END")


def _original_sql(cast_double: bool = True) -> str:
    cols = ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in CHECK_COLS)
    return with_log(f"SELECT srch_id, position, {cols} FROM log")


def _check(df):
    return rounded(df.select("srch_id", "position",
                             *[F.col(c).cast("double").alias(c) for c in CHECK_COLS]))


@register("null_token_counts", with_log(
    "SELECT " + ", ".join(
        f"count_if({c} IS NULL AND {_TOKEN_SQL} = 'NULL') AS {c}" for c in CHECK_COLS)
    + " FROM log"))
def q_null_tokens(spark, sf):
    d = clean.null_tokens(fixture.polluted_log(spark, sf), tokens=("NULL",))
    return d.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in CHECK_COLS])


@register("parse_to_double", _original_sql())
def q_to_double(spark, sf):
    d = clean.to_double(fixture.polluted_log(spark, sf), CHECK_COLS)
    return _check(d)


@register("coerce_all_strings", _original_sql())
def q_coerce(spark, sf):
    d = clean.coerce_numeric(fixture.polluted_log(spark, sf))
    assert not clean.string_columns(d)
    return _check(d)


@register("replace_then_cast", _original_sql())
def q_replace_cast(spark, sf):
    d = clean.replace_then_cast(fixture.polluted_log(spark, sf), CHECK_COLS)
    return _check(d)


@register("fill_null_and_nan", with_log("""
SELECT count(*) AS n_rows, round(sum(coalesce(price_usd, 0.0)), 4) AS price_filled,
       round(sum(coalesce(prop_review_score, 0.0)), 4) AS review_filled,
       count(prop_review_score) AS review_non_null FROM log"""))
def q_fill(spark, sf):
    log = fixture.search_log(spark, sf)
    # NaN stands for a missing price here; fill_nan turns it to 0, nulls stay untouched
    d = log.withColumn("price_usd", F.coalesce(F.col("price_usd"), F.lit(float("nan"))))
    d = clean.fill_nan(d, ["price_usd"], 0.0)
    kept = d.agg(F.count("prop_review_score").alias("review_non_null"))
    d = clean.fill_null(d, {"prop_review_score": 0.0})
    out = d.agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("price_usd"), 4).alias("price_filled"),
                F.round(F.sum("prop_review_score"), 4).alias("review_filled"))
    return out.select("*", kept.scalar().alias("review_non_null"))


@register("csv_roundtrip_null_tokens", _original_sql())
def q_csv(spark, sf):
    path = scratch_path(spark, f"polluted-csv-{uuid.uuid4().hex}")
    io.write_table(fixture.polluted_log(spark, sf), path, fmt="csv")
    back = io.read_log(spark, path, fmt="csv")
    return _check(back)


@register("parquet_roundtrip_bucketed", with_log("""
SELECT srch_id, prop_id, position, supp_id, price_usd, visitor_hist_adr_usd, click_bool FROM log"""))
def q_parquet(spark, sf):
    path = scratch_path(spark, f"log-parquet-{uuid.uuid4().hex}")
    io.write_table(fixture.search_log(spark, sf), path, bucket_key="srch_id")
    back = io.read_log(spark, path, fmt="parquet")
    return back.select("srch_id", "prop_id", "position", "supp_id", "price_usd", "visitor_hist_adr_usd", "click_bool")


@register("submission_csv_roundtrip", with_test("""
SELECT srch_id, prop_id, row_number() OVER (PARTITION BY srch_id
         ORDER BY price_usd DESC NULLS LAST, prop_id, supp_id) AS rank FROM test"""))
def q_submission_csv(spark, sf):
    sub = submit.ranked(fixture.test_log(spark, sf), score="price_usd",
                        tiebreak=("prop_id", "supp_id"))
    path = scratch_path(spark, f"submission-{uuid.uuid4().hex}")
    submit.write_submission(sub, path)
    back = spark.read.option("header", True).schema(
        "srch_id bigint, prop_id bigint, rank bigint").csv(path)
    return back


@register("drop_listed_columns", with_log("""
SELECT column_name, cast(n AS BIGINT) AS n_values FROM (
  UNPIVOT (SELECT count(COLUMNS(* EXCLUDE (price_usd, promotion_flag))) FROM log) ON COLUMNS(*)
  INTO NAME column_name VALUE n)"""))
def q_drop(spark, sf):
    log = fixture.search_log(spark, sf)
    # the list names one column the log does not have; it must be ignored
    d = log.drop("price_usd", "room_count", "promotion_flag")
    # every column that is left, with its number of values
    one = d.agg(*[F.count(c).alias(c) for c in d.columns])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_values"))
                                          for c in d.columns])).alias("x")).select("x.*")


@register("fill_within_search", with_log("""
SELECT srch_id, position,
       last_value(price_usd IGNORE NULLS) OVER (PARTITION BY srch_id
           ORDER BY position, prop_id, supp_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price_usd_ffill,
       first_value(price_usd IGNORE NULLS) OVER (PARTITION BY srch_id
           ORDER BY position, prop_id, supp_id
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS price_usd_bfill
FROM log"""))
def q_fill_within(spark, sf):
    from searchrank.operators.sequence import fill_within
    log = fixture.search_log(spark, sf).select("srch_id", "position", "prop_id", "supp_id",
                                               "price_usd")
    order = ["position", "prop_id", "supp_id"]
    f = fill_within(log, "srch_id", order, ["price_usd"], "forward", "_ffill")
    f = fill_within(f, "srch_id", order, ["price_usd"], "backward", "_bfill")
    return f.select("srch_id", "position", "price_usd_ffill", "price_usd_bfill")


@register("price_cap_filter", with_log("""
SELECT count(*) AS n_rows, count(DISTINCT srch_id) AS n_searches FROM log WHERE price_usd < 20000"""))
def q_cap(spark, sf):
    d = clean.cap_filter(fixture.search_log(spark, sf), "price_usd", 20000.0)
    return d.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("srch_id").alias("n_searches"))


@register("sample_searches", with_log("""
SELECT count(DISTINCT srch_id) AS n_searches, CAST(0 AS BIGINT) AS n_cut_searches, true AS share_fits FROM log"""))
def q_sample(spark, sf):
    """P13 as properties: a 10 % sample takes whole searches, about a tenth of them."""
    from searchrank.operators import split
    log = fixture.search_log(spark, sf).select("srch_id")
    kept = split.sample(log, 0.1, seed=7, key="srch_id").groupBy("srch_id").agg(F.count(F.lit(1)).alias("kept"))
    per = log.groupBy("srch_id").agg(F.count(F.lit(1)).alias("n")).join(kept, "srch_id", "left")
    share = F.count("kept") / F.count(F.lit(1))
    tol = 5 * F.sqrt(F.lit(0.1 * 0.9) / F.count(F.lit(1)))
    return per.agg(F.count(F.lit(1)).alias("n_searches"),
                   F.count_if(F.col("kept") != F.col("n")).alias("n_cut_searches"),
                   (F.abs(share - 0.1) <= tol).alias("share_fits"))


@register("sample_search_rows")
def q_sample_rows(spark, sf):
    """Rows per search of the 10 % sample."""
    from searchrank.operators import split
    log = fixture.search_log(spark, sf).select("srch_id")
    return split.sample(log, 0.1, seed=7, key="srch_id").groupBy("srch_id").agg(F.count(F.lit(1)).alias("n_rows"))
