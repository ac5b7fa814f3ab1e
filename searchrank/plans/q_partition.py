"""Registered queries: country partitions, ordered outputs, integrity checks
(R7-R10, R12, R14, R15, A20, W5, W6, O1-O3, P10-P12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from searchrank.functions import labels
from searchrank.operators import features as FE
from searchrank.operators import metrics, partition, submit
from searchrank.operators.sequence import running_within, top_k_within
from searchrank.plans.q_features import feature_ctes
from searchrank.plans.catalog import register, rounded
from searchrank.plans.q_ranking import GRADE_SQL
from searchrank.sources import fixture
from searchrank.sources.fixture_sql import with_log, with_test

MAP_CTES = """
, cc AS (SELECT prop_country_id, count(*) AS n_rows FROM log GROUP BY 1)
, iso AS (SELECT prop_country_id FROM cc ORDER BY n_rows DESC, prop_country_id LIMIT 1)
, rest AS (SELECT * FROM cc WHERE prop_country_id NOT IN (SELECT prop_country_id FROM iso))
, run AS (SELECT *, sum(n_rows) OVER (ORDER BY n_rows DESC, prop_country_id
                                     ROWS UNBOUNDED PRECEDING) AS cum_rows FROM rest)
, tot AS (SELECT sum(n_rows) AS total FROM rest)
, pmap AS (
  SELECT prop_country_id, n_rows, CAST(cum_rows AS BIGINT) AS cum_rows,
         CAST(least(floor(cum_rows / floor(total / 12)), 11) + 1 AS INTEGER) AS part_id
  FROM run, tot
  UNION ALL
  SELECT prop_country_id, n_rows, n_rows, 0 FROM cc WHERE prop_country_id IN (SELECT * FROM iso))"""


def _map(spark, sf):
    return partition.assign(fixture.search_log(spark, sf), "prop_country_id", 12, "largest")


@register("country_partitions", with_log(MAP_CTES + "\nSELECT * FROM pmap"))
def q_partitions(spark, sf):
    return _map(spark, sf)


@register("partition_sizes", with_log(MAP_CTES + """
, s AS (SELECT part_id, count(*) AS n_keys, CAST(sum(n_rows) AS BIGINT) AS n_rows FROM pmap GROUP BY 1)
SELECT *, CAST(row_number() OVER (ORDER BY part_id) - 1 AS INTEGER) AS part_idx FROM s"""))
def q_partition_sizes(spark, sf):
    s = partition.sizes(_map(spark, sf))
    return s.withColumn("part_idx", F.col("part_idx").cast("int"))


@register("partition_rows_by_split", with_log(MAP_CTES + """
SELECT part_id, CASE WHEN srch_id % 10 = 1 THEN 'valid' ELSE 'train' END AS split, count(*) AS n_rows
FROM log JOIN pmap USING (prop_country_id) GROUP BY 1, 2"""))
def q_partition_rows(spark, sf):
    log = fixture.search_log(spark, sf)
    rows = partition.attach(log, _map(spark, sf))
    split = F.when(F.col("srch_id") % 10 == 1, "valid").otherwise("train")
    return rows.groupBy("part_id", split.alias("split")).agg(F.count(F.lit(1)).alias("n_rows"))


@register("ndcg5_partition_weighted", with_log(MAP_CTES + f"""
, g AS (SELECT l.srch_id, l.prop_id, l.position, l.price_usd, {GRADE_SQL} AS grade, m.part_id
        FROM log l JOIN pmap m ON l.prop_country_id = m.prop_country_id WHERE l.srch_id % 10 = 1)
, r AS (SELECT *, row_number() OVER (PARTITION BY part_id, srch_id
                                     ORDER BY price_usd DESC NULLS LAST, prop_id, position) AS pos,
                  row_number() OVER (PARTITION BY part_id, srch_id ORDER BY grade DESC) AS ipos FROM g)
, s AS (SELECT part_id, srch_id,
          sum(CASE WHEN pos <= 5 THEN grade * CASE WHEN pos = 1 THEN 1.0 ELSE 1.0 / log2(pos) END
              ELSE 0 END) AS dcg,
          sum(CASE WHEN ipos <= 5 THEN grade * CASE WHEN ipos = 1 THEN 1.0 ELSE 1.0 / log2(ipos) END
              ELSE 0 END) AS idcg FROM r GROUP BY 1, 2)
, pm AS (SELECT part_id, avg(CASE WHEN idcg = 0 THEN 0 ELSE dcg / idcg END) AS mean_ndcg FROM s GROUP BY 1)
, pr AS (SELECT part_id, count(*) AS n FROM g GROUP BY 1)
SELECT round(sum(mean_ndcg * n) / sum(n), 6) AS weighted_mean FROM pm JOIN pr USING (part_id)"""))
def q_partition_weighted(spark, sf):
    log = labels.relevance_grade(fixture.search_log(spark, sf))
    valid = partition.attach(log.where(F.col("srch_id") % 10 == 1), _map(spark, sf))
    per = metrics.mean_ndcg(valid, score="price_usd", group=["part_id"])
    rows = valid.groupBy("part_id").agg(F.count(F.lit(1)).alias("n"))
    return rounded(metrics.weighted_mean(per.join(rows, "part_id"), "mean_ndcg", "n"))


# --- ordered outputs ----------------------------------------------------------------

@register("submission_by_price", with_test("""
SELECT srch_id, prop_id, row_number() OVER (PARTITION BY srch_id
         ORDER BY price_usd DESC NULLS LAST, prop_id, supp_id) AS rank FROM test"""))
def q_submission(spark, sf):
    test = fixture.test_log(spark, sf)
    return submit.ranked(test, score="price_usd", tiebreak=("prop_id", "supp_id"))


@register("submission_baseline_price_per_person", with_test(
    feature_ctes("test") + """
SELECT srch_id, prop_id, row_number() OVER (PARTITION BY srch_id
         ORDER BY price_per_person DESC NULLS LAST, prop_id, supp_id) AS rank FROM p"""))
def q_baseline(spark, sf):
    eng = FE.build(fixture.test_log(spark, sf))
    return submit.baseline(eng, score="price_per_person", tiebreak=("prop_id", "supp_id"))


@register("ideal_order", with_log("""
SELECT srch_id, prop_id, row_number() OVER (PARTITION BY srch_id
         ORDER BY booking_bool DESC, click_bool DESC, prop_id, position) AS rank FROM log"""))
def q_ideal(spark, sf):
    return submit.ideal_order(fixture.search_log(spark, sf))


@register("ideal_order_ndcg", with_log(f"""
, g AS (SELECT srch_id, {GRADE_SQL} AS grade FROM log)
, s AS (SELECT srch_id, max(grade) AS top FROM g GROUP BY 1)
SELECT count(*) AS n_searches, count_if(top > 0) AS n_with_clicks,
       round(avg(CASE WHEN top > 0 THEN 1.0 ELSE 0.0 END), 6) AS mean_ndcg FROM s"""))
def q_ideal_ndcg(spark, sf):
    """Property: the (booked, clicked) order scores NDCG 1 on every search with a click."""
    log = labels.relevance_grade(fixture.search_log(spark, sf))
    scored = log.withColumn("_s", F.col("booking_bool") * 10 + F.col("click_bool"))
    per = metrics.ndcg(scored, score="_s", tiebreak=("prop_id", "position"))
    return rounded(per.agg(F.count(F.lit(1)).alias("n_searches"),
                           F.count_if(F.col("idcg") > 0).alias("n_with_clicks"),
                           F.avg("ndcg").alias("mean_ndcg")))


@register("submission_check", with_test("""
, r AS (SELECT srch_id, prop_id, row_number() OVER (PARTITION BY srch_id
          ORDER BY price_usd DESC NULLS LAST, prop_id, supp_id) AS rank FROM test)
, o AS (SELECT 'whole' AS ordering, * FROM r
        UNION ALL SELECT 'broken', srch_id, prop_id, rank FROM r WHERE NOT (srch_id % 20 = 1 AND rank = 1)
        UNION ALL SELECT 'broken', srch_id, -1, rank FROM r WHERE srch_id % 20 = 11 AND rank = 1)
, a AS (SELECT x.ordering, srch_id, prop_id, count(*) AS n FROM test, (SELECT DISTINCT ordering FROM o) x GROUP BY ALL)
, b AS (SELECT ordering, srch_id, prop_id, count(*) AS n FROM o GROUP BY ALL)
, c AS (SELECT coalesce(a.ordering, b.ordering) AS ordering, coalesce(a.n, 0) AS na, coalesce(b.n, 0) AS nb
        FROM a FULL JOIN b USING (ordering, srch_id, prop_id))
, d AS (SELECT ordering, srch_id, count(*) AS n, min(rank) AS lo, max(rank) AS hi, count(DISTINCT rank) AS k
        FROM o GROUP BY ALL)
, e AS (SELECT ordering, count_if(lo <> 1 OR hi <> n OR k <> n) AS bad FROM d GROUP BY 1)
SELECT ordering, CAST(sum(na) AS BIGINT) AS rows_in, CAST(sum(nb) AS BIGINT) AS rows_out,
       CAST(sum(greatest(na - nb, 0)) AS BIGINT) AS missing_pairs,
       CAST(sum(greatest(nb - na, 0)) AS BIGINT) AS extra_pairs, any_value(bad) AS bad_rank_searches
FROM c JOIN e USING (ordering) GROUP BY ordering"""))
def q_check(spark, sf):
    """A sound ordering, and one with rows lost and rows that do not belong (which must be flagged)."""
    test = fixture.test_log(spark, sf)
    sub = submit.ranked(test, score="price_usd", tiebreak=("prop_id", "supp_id"))
    lost = sub.where(~((F.col("srch_id") % 20 == 1) & (F.col("rank") == 1)))
    alien = sub.where((F.col("srch_id") % 20 == 11) & (F.col("rank") == 1)).withColumn("prop_id", F.lit(-1).cast("long"))
    whole = submit.check(test, sub).withColumn("ordering", F.lit("whole"))
    return whole.unionByName(submit.check(test, lost.unionByName(alien)).withColumn("ordering", F.lit("broken")))


@register("global_sort_position", with_log("""
SELECT srch_id, position, row_number() OVER (ORDER BY srch_id, booking_bool DESC, click_bool DESC,
                                                   position) AS global_pos FROM log"""))
def q_global_sort(spark, sf):
    log = fixture.search_log(spark, sf).select("srch_id", "position", "booking_bool", "click_bool")
    order = [F.col("srch_id").asc(), F.col("booking_bool").desc(), F.col("click_bool").desc(),
             F.col("position").asc()]
    return running_within(log, [], order, out="global_pos").select("srch_id", "position", "global_pos")


@register("top5_per_search_by_price", with_log("""
SELECT srch_id, position, rank FROM (
  SELECT srch_id, position, row_number() OVER (PARTITION BY srch_id
           ORDER BY price_usd DESC NULLS LAST, prop_id, position) AS rank FROM log) WHERE rank <= 5"""))
def q_top5(spark, sf):
    log = fixture.search_log(spark, sf)
    order = [F.col("price_usd").desc_nulls_last(), F.col("prop_id"), F.col("position")]
    return top_k_within(log, "srch_id", order, 5).select("srch_id", "position", "rank")


@register("membership_filter_partition", with_log(MAP_CTES + """
SELECT count(*) AS n_rows FROM log
WHERE prop_country_id IN (SELECT prop_country_id FROM pmap WHERE part_id BETWEEN 1 AND 3)"""))
def q_membership(spark, sf):
    log = fixture.search_log(spark, sf)
    ids = _map(spark, sf).where(F.col("part_id").between(1, 3)).select("prop_country_id")
    return log.join(ids, "prop_country_id", "left_semi").agg(F.count(F.lit(1)).alias("n_rows"))
