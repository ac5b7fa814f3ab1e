"""Registered queries: rankers, importance, clustering, tuning, pair tables
(M1-M8, J6, R11, S6, F17).

Scores of fitted models have no SQL form; where a property of the result
can be stated (rows kept, saved equals loaded, settings in range, nearest
centre), the oracle holds that.  Every fit uses the defaults of the library
functions or larger settings.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from searchrank.functions import labels
from searchrank.operators import features as FE
from searchrank.operators import metrics, pairs, partition, split, submit
from searchrank.plans import cluster, partitioned, tune
from searchrank.plans import model as M
from searchrank.plans.catalog import register, rounded
from searchrank.plans.q_features import ENGINEERED_DROP, FEATURE_CTES
from searchrank.plans.q_ranking import GRADE_SQL
from searchrank.session import scratch_path, shared_table
from searchrank.sources import fixture
from searchrank.sources.fixture_sql import with_log, with_test
from searchrank.sources.io import materialize


def _engineered(spark, sf):
    # models read their input many times (null counts, imputer, boosting
    # iterations, scoring), and every model query needs the same table: it is
    # staged once for all of them
    inputs = [f"{sf}/{t}.parquet" for t in ("lineitem", "orders", "customer", "part", "supplier")]
    return shared_table(spark, "engineered", inputs, "relevance_grade(build(search_log)), version 3",
                        lambda: labels.relevance_grade(FE.build(fixture.search_log(spark, sf))))


def _result(df, name):
    return rounded(df.select(F.lit(name).alias("model"), "mean_ndcg", "n_searches"))


@register("ranker_gbt_holdout")
def q_gbt(spark, sf):
    """M1 + M2 + M5: early-stopped pointwise GBT, NDCG@5 on the holdout."""
    train, valid = split.mod_split(_engineered(spark, sf))
    r = M.fit_ranker(train, valid=valid)
    n_trees = M.gbt_stage(r).getNumTrees
    res = metrics.mean_ndcg(r.score(valid), score="pred")
    return _result(res, "gbt_pointwise").withColumn("n_trees", F.lit(n_trees))


@register("ranker_pairwise_holdout")
def q_pairwise(spark, sf):
    """M3: all-pairs least-squares ranker, NDCG@5 on the holdout."""
    train, valid = split.mod_split(_engineered(spark, sf))
    r = M.fit_pairwise(train)
    return _result(metrics.mean_ndcg(r.score(valid), score="pred"), "pairwise_ls")


@register("ranker_partitions_holdout")
def q_partitions(spark, sf):
    """M4 + A20: one GBT per country slice; NDCG@5 per slice, row-weighted."""
    eng = _engineered(spark, sf)
    mapping = partition.assign(eng, "prop_country_id", 12, "largest")
    train, valid = split.mod_split(eng)
    models = partitioned.fit_all(train, mapping)
    scored = partitioned.score_all(models, valid, mapping)
    per = metrics.mean_ndcg(scored.where(F.col("pred").isNotNull()), score="pred",
                            group=["part_id"])
    rows = scored.groupBy("part_id").agg(F.count(F.lit(1)).alias("n"))
    w = metrics.weighted_mean(per.join(rows, "part_id"), "mean_ndcg", "n", out="mean_ndcg")
    return rounded(w.select(F.lit("partitions").alias("model"), "mean_ndcg",
                            F.lit(len(models)).alias("n_models")))


@register("model_comparison")
def q_compare(spark, sf):
    """Mean NDCG@5 on the holdout per model, plus the price baseline."""
    eng = _engineered(spark, sf)
    train, valid = split.mod_split(eng)
    gbt = M.fit_ranker(train)
    pw = M.fit_pairwise(train)
    frames = [
        metrics.mean_ndcg(gbt.score(valid), score="pred").withColumn("model", F.lit("gbt_pointwise")),
        metrics.mean_ndcg(pw.score(valid), score="pred").withColumn("model", F.lit("pairwise_ls")),
        metrics.mean_ndcg(valid, score="price_per_person").withColumn("model",
                                                                      F.lit("price_per_person")),
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return rounded(out.select("model", "mean_ndcg", "n_searches"))


@register("feature_importance")
def q_importance(spark, sf):
    """M6: mean split gain and split count per feature, top 15."""
    train, _ = split.mod_split(_engineered(spark, sf))
    r = M.fit_ranker(train)
    return rounded(M.importance(r, top=15))


def _numeric_log(spark, sf):
    """The log's feature columns, written once: the imputer, the scaler, k-means and the assignment each read them."""
    log = fixture.search_log(spark, sf)
    return materialize(log.select(*M.feature_columns(log)), "numeric-log")


@register("kmeans_clusters", with_log(
    "SELECT count(*) AS n_rows, 10 AS k, count(*) AS n_nearest, true AS all_in_range FROM log"))
def q_kmeans(spark, sf):
    """M7 / F17 as properties: k-means (k=10, seed 0), every row at its nearest centre."""
    log = _numeric_log(spark, sf)
    m = cluster.fit(log, k=10, seed=0)
    centres = [c.tolist() for c in m.stages[-1].clusterCenters()]   # k short vectors
    got = cluster.nearest(cluster.assign_with_features(m, log), centres)
    return got.select("n_rows", F.lit(len(centres)).alias("k"), "n_nearest",
                      ((F.col("lo") >= 0) & (F.col("hi") < len(centres))).alias("all_in_range"))


@register("kmeans_cluster_sizes")
def q_kmeans_sizes(spark, sf):
    """M7: rows per cluster (k=10, seed 0)."""
    log = _numeric_log(spark, sf)
    rows = cluster.assign_with_features(cluster.fit(log, k=10, seed=0), log)
    return rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_rows"))


#: Trials of the registered tuning query, as many as the study took.
TRIALS = 50


@register("tuning_trials")
def q_tuning(spark, sf):
    """The table of 50 trials; poor ones are stopped at a rung, which the table records."""
    train, valid = split.mod_split(_engineered(spark, sf))
    ready = M.prepare(train, valid)

    def objective(p, rounds):
        return ready.ndcg(ready.fit(rounds, max_depth=p["max_depth"], step_size=p["eta"], subsample=p["subsample"],
                                    colsample=p["colsample"]))

    return rounded(tune.halving_search(spark, objective, n_trials=TRIALS, seed=42))


@register("ranker_reference_settings")
def q_reference(spark, sf):
    """M1 + M2 at the study's tuned settings: 130 rounds of depth 9, stopped after ten rounds without a better NDCG@5."""
    train, valid = split.mod_split(_engineered(spark, sf))
    ready = M.prepare(train, valid)
    p = M.reference_settings()
    r = ready.fit(p.pop("max_iter"), **p)
    at = M.best_rounds(r, valid)
    return rounded(M.ndcg_by_rounds(r, valid).select(
        "trees", "mean_ndcg", "n_searches", (F.col("trees") == at).alias("is_chosen")))


@register("ranker_weight_label")
def q_weight_label(spark, sf):
    """R2 as training label: a ranker fitted on 5 * booking + click, judged by NDCG@5 of the grades."""
    train, valid = split.mod_split(labels.relevance_weight(_engineered(spark, sf)))
    r = M.fit_ranker(train, label="weight")
    return _result(metrics.mean_ndcg(r.score(valid), score="pred"), "gbt_weight_label")


@register("ranker_cluster_feature")
def q_cluster_feature(spark, sf):
    """F17 in a model: the k-means cluster id (k=10) as a feature of the ranker."""
    log = materialize(fixture.search_log(spark, sf), "log")   # read by each step of the clustering and the features
    eng = labels.relevance_grade(FE.build(cluster.assign(cluster.fit(log, k=10, seed=0), log)))
    train, valid = split.mod_split(materialize(eng, "engineered-clusters"))
    r = M.fit_ranker(train)
    return _result(metrics.mean_ndcg(r.score(valid), score="pred"), "gbt_with_cluster").withColumn(
        "cluster_used", F.lit("cluster" in r.usable))


def _equal(before, after, df):
    """Rows scored, and rows that both models score alike (one model after the other, no join)."""
    both = after.score(before.score(df, "a"), "b")
    return both.agg(F.count(F.lit(1)).alias("n_rows"),
                    F.count_if(F.abs(F.col("a") - F.col("b")) < 1e-9).alias("n_equal"))


@register("model_save_load", with_log("""
SELECT count(*) AS n_rows, count(*) AS n_equal FROM log WHERE srch_id % 10 = 1"""))
def q_save_load(spark, sf):
    """A saved model reloads from its folder alone and scores identically."""
    train, valid = split.mod_split(_engineered(spark, sf))
    r = M.fit_ranker(train)
    path = scratch_path(spark, f"model-{uuid.uuid4().hex}")
    r.save(path)
    return _equal(r, M.Ranker.load(path), valid)


@register("slice_models_save_load", with_log("""
SELECT count(*) AS n_rows, count(*) AS n_equal FROM log WHERE srch_id % 10 = 1"""))
def q_slices_save_load(spark, sf):
    """M4 + S6: models of all slices, refitted on all rows, saved and loaded, score identically."""
    eng = _engineered(spark, sf)
    mapping = materialize(partition.assign(eng, "prop_country_id", 12, "largest"), "slice-map")
    train, valid = split.mod_split(eng)
    models = partitioned.refit_all(partitioned.fit_all(train, mapping), eng, mapping)
    path = scratch_path(spark, f"slices-{uuid.uuid4().hex}")
    partitioned.save_all(models, path)
    one = partitioned.score_all(models, valid, mapping, out="a").drop("part_id")
    two = partitioned.score_all(partitioned.load_all(spark, path), one, mapping, out="b")
    return two.agg(F.count(F.lit(1)).alias("n_rows"),
                   F.count_if(F.abs(F.col("a") - F.col("b")) < 1e-9).alias("n_equal"))


@register("submission_from_model", with_test("""
SELECT count(*) AS rows_in, count(*) AS rows_out, CAST(0 AS BIGINT) AS missing_pairs,
       CAST(0 AS BIGINT) AS extra_pairs, CAST(0 AS BIGINT) AS bad_rank_searches FROM test"""))
def q_submission_from_model(spark, sf):
    """The whole flow: fit feature statistics and a ranker on the labelled log, apply both to
    the unlabelled set, rank it, write it, read it back and check it."""
    log, test = fixture.search_log(spark, sf), fixture.test_log(spark, sf)
    fitted = FE.fit_stats(log)
    eng = materialize(labels.relevance_grade(FE.build(log, fitted)), "engineered")
    train, valid = split.mod_split(eng)
    ranker = M.fit_best(train, valid)
    scored = ranker.score(FE.build(test, fitted))
    path = scratch_path(spark, f"submission-{uuid.uuid4().hex}")
    submit.write_submission(submit.ranked(scored, "pred", tiebreak=("prop_id", "supp_id")), path)
    back = spark.read.option("header", True).schema("srch_id bigint, prop_id bigint, rank bigint").csv(path)
    return submit.check(test, back)


@register("pair_counts", with_log(f"""
, g AS (SELECT srch_id, position, {GRADE_SQL} AS grade FROM log)
, n AS (SELECT srch_id, count(*) AS n_rows FROM g GROUP BY 1)
, p AS (SELECT a.srch_id, count(*) AS n_pairs FROM g a JOIN g b
        ON a.srch_id = b.srch_id AND a.grade > b.grade GROUP BY 1)
SELECT n.srch_id, n.n_rows, coalesce(p.n_pairs, 0) AS n_pairs FROM n LEFT JOIN p USING (srch_id)"""))
def q_pair_counts(spark, sf):
    log = labels.relevance_grade(fixture.search_log(spark, sf))
    return pairs.pair_counts(log).select("srch_id", "n_rows", F.col("n_pairs").cast("long"))


@register("topk_pair_counts", with_log(f"""
, g AS (SELECT srch_id, prop_id, position, price_usd, {GRADE_SQL} AS grade FROM log)
, t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY srch_id
          ORDER BY price_usd DESC NULLS LAST, prop_id, position) AS pos FROM g) WHERE pos <= 6)
SELECT t.srch_id, count(*) AS n_topk_pairs FROM t JOIN g b
  ON t.srch_id = b.srch_id AND t.grade <> b.grade GROUP BY 1"""))
def q_topk_pairs(spark, sf):
    log = labels.relevance_grade(fixture.search_log(spark, sf))
    out = pairs.topk_pair_counts(log, score="price_usd", k=6)
    return out.where(F.col("n_topk_pairs") > 0).select("srch_id",
                                                       F.col("n_topk_pairs").cast("long"))


_PAIR_ORDER = "price_usd DESC NULLS LAST, prop_id, position, supp_id"
_PAIR_TABLE = f"""
, g AS (SELECT srch_id, prop_id, position, supp_id, price_usd, prop_starrating, promotion_flag, {GRADE_SQL} AS grade,
          row_number() OVER (PARTITION BY srch_id ORDER BY {_PAIR_ORDER}) AS p,
          row_number() OVER (PARTITION BY srch_id ORDER BY {GRADE_SQL} DESC) AS pi FROM log)
, i AS (SELECT srch_id, sum(CASE WHEN pi <= 6 THEN grade / log2(pi + 1) ELSE 0 END) AS idcg FROM g GROUP BY 1)
, j AS (SELECT b.srch_id, a.p AS pos, b.prop_id, b.position, b.supp_id,
          CAST(a.grade > b.grade AS INTEGER) AS label,
          abs(a.grade - b.grade) * (1 / log2(a.p + 1) - CASE WHEN b.p <= 6 THEN 1 / log2(b.p + 1) ELSE 0 END)
            / i.idcg AS weight,
          a.price_usd - b.price_usd AS d_price_usd, a.prop_starrating - b.prop_starrating AS d_prop_starrating,
          CAST(a.promotion_flag - b.promotion_flag AS DOUBLE) AS d_promotion_flag
        FROM g a JOIN g b ON a.srch_id = b.srch_id AND a.p <= 6 AND a.p < b.p AND a.grade <> b.grade
        JOIN i ON i.srch_id = a.srch_id)"""


@register("make_pairs", with_log(_PAIR_TABLE + """
SELECT srch_id, pos, prop_id, position, supp_id, label, round(weight, 6) AS weight,
       round(d_price_usd, 6) AS d_price_usd, round(d_prop_starrating, 6) AS d_prop_starrating,
       round(d_promotion_flag, 6) AS d_promotion_flag FROM j"""))
def q_make_pairs(spark, sf):
    """The weighted pair table of the top 6 rows of each search."""
    log = labels.relevance_grade(fixture.search_log(spark, sf))
    return rounded(pairs.make_pairs(log, ["price_usd", "prop_starrating", "promotion_flag"], score="price_usd",
                                    tiebreak=("prop_id", "position", "supp_id")))


@register("ranker_pairs_holdout")
def q_pairs_ranker(spark, sf):
    """M3: logistic ranker on the top-6 pair table, NDCG@5 on the holdout."""
    train, valid = split.mod_split(_engineered(spark, sf))
    r = M.fit_pairs(train)
    return _result(metrics.mean_ndcg(r.score(valid), score="pred"), "pairwise_logistic")


@register("ndcg_compare_orderings", with_log(f"""
, g AS (SELECT srch_id, prop_id, position, price_usd, prop_starrating, {GRADE_SQL} AS grade
        FROM log WHERE srch_id % 10 = 1)
, r AS (SELECT *, row_number() OVER (PARTITION BY srch_id ORDER BY price_usd DESC NULLS LAST,
                                     prop_id, position) AS p1,
                  row_number() OVER (PARTITION BY srch_id ORDER BY price_usd ASC NULLS LAST,
                                     prop_id, position) AS p2,
                  row_number() OVER (PARTITION BY srch_id ORDER BY prop_starrating DESC NULLS LAST,
                                     prop_id, position) AS p3,
                  row_number() OVER (PARTITION BY srch_id ORDER BY grade DESC) AS pi FROM g)
, s AS (SELECT srch_id,
          sum(CASE WHEN p1 <= 5 THEN grade * CASE WHEN p1 = 1 THEN 1.0 ELSE 1.0 / log2(p1) END ELSE 0 END) AS d1,
          sum(CASE WHEN p2 <= 5 THEN grade * CASE WHEN p2 = 1 THEN 1.0 ELSE 1.0 / log2(p2) END ELSE 0 END) AS d2,
          sum(CASE WHEN p3 <= 5 THEN grade * CASE WHEN p3 = 1 THEN 1.0 ELSE 1.0 / log2(p3) END ELSE 0 END) AS d3,
          sum(CASE WHEN pi <= 5 THEN grade * CASE WHEN pi = 1 THEN 1.0 ELSE 1.0 / log2(pi) END ELSE 0 END) AS di
        FROM r GROUP BY 1)
SELECT 'price_desc' AS model, round(avg(CASE WHEN di = 0 THEN 0 ELSE d1 / di END), 6) AS mean_ndcg,
       count(*) AS n_searches FROM s
UNION ALL SELECT 'price_asc', round(avg(CASE WHEN di = 0 THEN 0 ELSE d2 / di END), 6), count(*) FROM s
UNION ALL SELECT 'stars_desc', round(avg(CASE WHEN di = 0 THEN 0 ELSE d3 / di END), 6), count(*) FROM s"""))
def q_compare_orderings(spark, sf):
    """R11 over orderings that need no model: one row per ordering."""
    _, valid = split.mod_split(labels.relevance_grade(fixture.search_log(spark, sf)))
    a = metrics.mean_ndcg(valid, score="price_usd").withColumn("model", F.lit("price_desc"))
    b = metrics.mean_ndcg(valid.withColumn("neg_price", -F.col("price_usd")), score="neg_price") \
        .withColumn("model", F.lit("price_asc"))
    c = metrics.mean_ndcg(valid, score="prop_starrating").withColumn("model", F.lit("stars_desc"))
    return rounded(a.unionByName(b).unionByName(c).select("model", "mean_ndcg", "n_searches"))


_FEATURE_NON = ", ".join(f"'{c}'" for c in M.NON_FEATURES)


@register("feature_list", with_log(FEATURE_CTES + f"""
, e AS (SELECT * EXCLUDE ({ENGINEERED_DROP}) FROM p)
, c AS (SELECT count(COLUMNS(lambda x: x NOT IN ({_FEATURE_NON}))) AS '\\0' FROM e)
UNPIVOT c ON COLUMNS(*) INTO NAME feature VALUE n_values"""))
def q_feature_list(spark, sf):
    """P5: the columns a ranker may use, with the number of rows that have them."""
    eng = _engineered(spark, sf)
    names = M.feature_columns(eng)
    one = eng.agg(*[F.count(c).alias(c) for c in names])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("n_values"))
                                          for c in names])).alias("f")).select("f.feature", "f.n_values")


@register("log_preview", with_log("""
, n AS (SELECT count(*) AS n_rows FROM log)
SELECT srch_id, prop_id, position, supp_id, round(price_usd, 6) AS price_usd, n_rows
FROM log, n ORDER BY srch_id, prop_id, position, supp_id LIMIT 5"""))
def q_preview(spark, sf):
    """The first five rows and the row count."""
    log = fixture.search_log(spark, sf).select("srch_id", "prop_id", "position", "supp_id", "price_usd")
    n = log.agg(F.count(F.lit(1)).alias("n_rows")).scalar()
    return rounded(log.orderBy("srch_id", "prop_id", "position", "supp_id").limit(5).withColumn("n_rows", n))


@register("feature_importance_checks", """
SELECT 15 AS n_features, true AS gain_falls, true AS splits_counted, true AS shares_fit""")
def q_importance_checks(spark, sf):
    """O4, M6 as properties: 15 features by falling gain; split counts are those of the trees; shares within 1."""
    train, _ = split.mod_split(_engineered(spark, sf))
    r = M.fit_ranker(train)
    top = M.importance(r, top=15)
    # a tree of n nodes has (n - 1) / 2 splits
    splits = sum((t.numNodes - 1) // 2 for t in M.gbt_stage(r).trees)
    whole = M.importance(r, top=len(r.feature_names)).agg(F.sum("weight").alias("w")).select("w").scalar()
    place = Window.orderBy(F.col("gain").desc(), "feature")   # 15 rows
    return top.withColumn("before", F.lag("gain").over(place)).agg(
        F.count(F.lit(1)).cast("int").alias("n_features"),
        F.bool_and(F.coalesce(F.col("before") >= F.col("gain"), F.lit(True))).alias("gain_falls"),
        (whole == splits).alias("splits_counted"),
        ((F.sum("importance") <= 1 + 1e-9) & (F.min("importance") >= 0)).alias("shares_fit"))
