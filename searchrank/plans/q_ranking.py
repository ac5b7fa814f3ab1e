"""Registered queries: labels, splits, NDCG, orderings."""

from __future__ import annotations

from pyspark.sql import functions as F

from searchrank.functions import labels
from searchrank.operators import metrics, split, submit
from searchrank.plans.catalog import register, rounded
from searchrank.sources import fixture
from searchrank.sources.fixture_sql import with_log, with_test

GRADE_SQL = ("CASE WHEN booking_bool = 1 THEN 5 WHEN click_bool = 1 THEN 1 ELSE 0 END")


def graded_log(spark, sf):
    return labels.relevance_grade(fixture.search_log(spark, sf))


# --- R1 / R2: labels -------------------------------------------------------

@register("relevance_grade_counts", with_log(f"""
SELECT {GRADE_SQL} AS relevance_grade, count(*) AS n_rows,
       count(DISTINCT srch_id) AS n_searches
FROM log GROUP BY 1"""))
def q_grade_counts(spark, sf):
    g = graded_log(spark, sf)
    return g.groupBy("relevance_grade").agg(F.count(F.lit(1)).alias("n_rows"),
                                            F.countDistinct("srch_id").alias("n_searches"))


@register("relevance_weight_counts", with_log("""
SELECT 5 * booking_bool + click_bool AS weight, count(*) AS n_rows
FROM log GROUP BY 1"""))
def q_weight_counts(spark, sf):
    w = labels.relevance_weight(fixture.search_log(spark, sf))
    return w.groupBy("weight").agg(F.count(F.lit(1)).alias("n_rows"))


# --- R5 / R6: splits ---------------------------------------------------------

@register("holdout_split_sizes", with_log("""
SELECT CASE WHEN srch_id % 10 = 1 THEN 'valid' ELSE 'train' END AS part,
       count(*) AS n_rows, count(DISTINCT srch_id) AS n_searches
FROM log GROUP BY 1"""))
def q_holdout(spark, sf):
    # one pass: the holdout filter of split.mod_split as a flag
    part = F.when(F.col("srch_id") % 10 == 1, "valid").otherwise("train").alias("part")
    return fixture.search_log(spark, sf).select(part, "srch_id").groupBy("part").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("srch_id").alias("n_searches"))


@register("hash_split_sizes", with_log("""
SELECT count(*) AS n_rows, count(DISTINCT srch_id) AS n_searches, CAST(0 AS BIGINT) AS n_on_both_sides,
       true AS share_fits FROM log"""))
def q_hash_split(spark, sf):
    """R6 as properties: nothing is lost, no search is on both sides, the share is near 20 %."""
    log = fixture.search_log(spark, sf).select("srch_id")
    train, test = split.hash_split(log, "srch_id", 0.2, seed=42)
    per = train.withColumn("t", F.lit(0)).unionByName(test.withColumn("t", F.lit(1))).groupBy("srch_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi"))
    share = F.avg(F.col("hi").cast("double"))
    # five standard errors of the share of searches
    tol = 5 * F.sqrt(F.lit(0.2 * 0.8) / F.count(F.lit(1)))
    return per.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_searches"),
                   F.count_if(F.col("lo") != F.col("hi")).alias("n_on_both_sides"),
                   (F.abs(share - 0.2) <= tol).alias("share_fits"))


# --- R3 / R4: DCG and NDCG ---------------------------------------------------

def _ndcg_sql(score_order: str, k: int = 5, method1: bool = True, where: str = "") -> str:
    disc = ("CASE WHEN {p} = 1 THEN 1.0 ELSE 1.0 / log2({p}) END" if method1
            else "1.0 / log2({p} + 1)")
    return with_log(f"""
, g AS (SELECT srch_id, prop_id, position, price_usd, prop_starrating, prop_review_score,
               {GRADE_SQL} AS grade FROM log {where})
, r AS (SELECT *, row_number() OVER (PARTITION BY srch_id ORDER BY {score_order}) AS pos FROM g)
, d AS (SELECT srch_id,
               sum(CASE WHEN pos <= {k} THEN grade * {disc.format(p='pos')} ELSE 0 END) AS dcg
        FROM r GROUP BY srch_id)
, ir AS (SELECT *, row_number() OVER (PARTITION BY srch_id ORDER BY grade DESC) AS ipos FROM g)
, i AS (SELECT srch_id,
               sum(CASE WHEN ipos <= {k} THEN grade * {disc.format(p='ipos')} ELSE 0 END) AS idcg
        FROM ir GROUP BY srch_id)
""")


PRICE_ORDER_SQL = "price_usd DESC NULLS LAST, prop_id, position"


@register("ndcg5_price_baseline", _ndcg_sql(PRICE_ORDER_SQL) + """
SELECT round(avg(CASE WHEN idcg = 0 THEN 0 ELSE dcg / idcg END), 6) AS mean_ndcg,
       count(*) AS n_searches
FROM i LEFT JOIN d USING (srch_id)""")
def q_ndcg_price(spark, sf):
    g = graded_log(spark, sf)
    return rounded(metrics.mean_ndcg(g, score="price_usd"))


@register("ndcg5_price_holdout", _ndcg_sql(PRICE_ORDER_SQL, where="WHERE srch_id % 10 = 1") + """
SELECT round(avg(CASE WHEN idcg = 0 THEN 0 ELSE dcg / idcg END), 6) AS mean_ndcg,
       count(*) AS n_searches
FROM i LEFT JOIN d USING (srch_id)""")
def q_ndcg_holdout(spark, sf):
    _, valid = split.mod_split(graded_log(spark, sf), "srch_id", 10, 1)
    return rounded(metrics.mean_ndcg(valid, score="price_usd"))


@register("ndcg5_alt_discount", _ndcg_sql(PRICE_ORDER_SQL, method1=False) + """
SELECT round(avg(CASE WHEN idcg = 0 THEN 0 ELSE dcg / idcg END), 6) AS mean_ndcg,
       count(*) AS n_searches
FROM i LEFT JOIN d USING (srch_id)""")
def q_ndcg_alt(spark, sf):
    g = graded_log(spark, sf)
    return rounded(metrics.mean_ndcg(g, score="price_usd", first_two_undiscounted=False))


@register("ndcg10_stars", _ndcg_sql(
    "prop_starrating DESC NULLS LAST, prop_id, position", k=10) + """
SELECT round(avg(CASE WHEN idcg = 0 THEN 0 ELSE dcg / idcg END), 6) AS mean_ndcg,
       count(*) AS n_searches
FROM i LEFT JOIN d USING (srch_id)""")
def q_ndcg_stars(spark, sf):
    g = graded_log(spark, sf)
    return rounded(metrics.mean_ndcg(g, score="prop_starrating", k=10))


@register("ndcg5_per_search", _ndcg_sql(PRICE_ORDER_SQL) + """
SELECT srch_id, round(coalesce(dcg, 0), 6) AS dcg, round(idcg, 6) AS idcg,
       round(CASE WHEN idcg = 0 THEN 0 ELSE coalesce(dcg, 0) / idcg END, 6) AS ndcg
FROM i LEFT JOIN d USING (srch_id)""")
def q_ndcg_per_search(spark, sf):
    g = graded_log(spark, sf)
    return rounded(metrics.ndcg(g, score="price_usd"))


@register("ndcg5_by_country", with_log(f"""
, g AS (SELECT srch_id, prop_country_id, prop_id, position, price_usd, {GRADE_SQL} AS grade FROM log)
, r AS (SELECT *, row_number() OVER (PARTITION BY prop_country_id, srch_id
                                     ORDER BY {PRICE_ORDER_SQL}) AS pos,
                  row_number() OVER (PARTITION BY prop_country_id, srch_id
                                     ORDER BY grade DESC) AS ipos FROM g)
, s AS (SELECT prop_country_id, srch_id,
               sum(CASE WHEN pos <= 5 THEN grade * CASE WHEN pos = 1 THEN 1.0 ELSE 1.0 / log2(pos) END
                   ELSE 0 END) AS dcg,
               sum(CASE WHEN ipos <= 5 THEN grade * CASE WHEN ipos = 1 THEN 1.0 ELSE 1.0 / log2(ipos) END
                   ELSE 0 END) AS idcg
        FROM r GROUP BY 1, 2)
SELECT prop_country_id, round(avg(CASE WHEN idcg = 0 THEN 0 ELSE dcg / idcg END), 6) AS mean_ndcg,
       count(*) AS n_searches
FROM s GROUP BY 1"""))
def q_ndcg_by_country(spark, sf):
    g = graded_log(spark, sf)
    return rounded(metrics.mean_ndcg(g, score="price_usd", group=["prop_country_id"]))
