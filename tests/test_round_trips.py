"""Staging folder, quantiles without value lists, integrity check, splits and model round trips."""

import os

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from searchrank import session
from searchrank.functions import labels
from searchrank.operators import features as FE
from searchrank.operators import metrics, profile, split, stats, submit
from searchrank.plans import model as M
from searchrank.plans import tune
from searchrank.sources import fixture, io

SF = "/root/testdata/sf0.001"


class _Context:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None

    def getConf(self):
        return {}


class _Spark:
    def __init__(self, master):
        self.sparkContext = _Context(master)


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "k8s://h", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Spark(master))


def test_staged_tables_go_with_their_block(spark):
    with session.staging(spark) as paths:
        assert io.materialize(spark.range(5), "x").count() == 5
        FE.build(fixture.search_log(spark, SF)).write.format("noop").mode("overwrite").save()
        there = [p.removeprefix("file:") for p in paths]
        assert len(there) >= 4 and all(os.path.exists(p) for p in there)
    assert not any(os.path.exists(p) for p in there)


def test_null_group_keeps_its_quantile(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0), (None, 5.0), (None, 7.0), (None, 9.0)], "g long, v double")
    got = {r["g"]: r["v_q"] for r in stats.group_quantile(df, "g", ["v"], 0.5).collect()}
    assert got == {1: 3.0, None: 7.0}


@pytest.mark.parametrize("n", [1, 2, 3, 7, 60_001])
def test_quantiles_by_bracket(spark, n):
    r = np.random.default_rng(n)
    a, b = r.normal(size=n), r.integers(0, 4, n).astype(float)
    df = spark.createDataFrame(list(zip(a.tolist(), b.tolist())), "a double, b double")
    for method, name in (("linear", "linear"), ("lower", "lower"), ("higher", "higher"), ("disc", "inverted_cdf")):
        _, got = stats.quantiles_wide(df, ["a", "b"], [0.25, 0.5, 0.9], method)
        for c, x in (("a", a), ("b", b)):
            for q in (0.25, 0.5, 0.9):
                assert got[c, q] == pytest.approx(np.quantile(x, q, method=name), abs=1e-12), (method, c, q)


def test_positions_by_digits(spark):
    r = np.random.default_rng(9)
    cols = {"tiny": r.choice([5e-324, -5e-324, 0.0, -0.0, 1e-310], 4000), "wide": r.normal(size=4000) * 10.0 ** r.integers(-300, 300, 4000),
            "ends": r.choice([np.inf, -np.inf, 1.0, np.nextafter(1, 2), np.nan], 4000), "one": np.full(4000, -7.25),
            "near": 1e15 + r.integers(0, 9000, 4000) / 8}
    df = spark.createDataFrame([tuple(float(v[i]) for v in cols.values()) + (None,) for i in range(4000)],
                               ", ".join(f"{c} double" for c in cols) + ", none double").repartition(5)
    qs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got, out = stats.quantiles_wide(df, [*cols, "none"], qs, "lower")
    for c, v in cols.items():
        x = np.sort(v[~np.isnan(v)])
        assert got[c]["count"] == len(x)
        for q in qs:
            assert out[c, q] == x[int(np.floor(q * (len(x) - 1)))], (c, q)
    assert all(out["none", q] is None for q in qs) and got["none"]["count"] == 0
    assert stats.quantiles_wide(df.limit(0), ["one"], [0.5])[1] == {("one", 0.5): None}


def test_describe_plans_neither_explode_nor_sort_rows(spark, monkeypatch):
    """The plans of every job behind describe: no Generate, no exchange of rows, only of histograms."""
    df = spark.range(1000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("x"), F.cos("id").alias("y"))
    plans = []
    real = stats._histogram

    def seen(*args):
        h = real(*args)
        plans.append(h._jdf.queryExecution().executedPlan().toString())
        return h

    monkeypatch.setattr(stats, "_histogram", seen)
    r = {x["column"]: x for x in profile.describe(df, ["x", "y"]).collect()}
    assert (r["x"]["count"], r["x"]["null_count"], r["x"]["min"], r["x"]["max"]) == (666, 334, 1.0, 998.0)
    assert 1 <= len(plans) <= 4
    for p in plans:
        assert "Generate" not in p and "rangepartitioning" not in p
        below = p[p.index("hashpartitioning"):]   # towards the scan: histograms are summed before they are dealt
        assert below.index("HashAggregate") < below.index("MapInArrow") and below.count("Exchange") == 0


def test_integrity_check_flags_faults(spark):
    src = spark.createDataFrame([(1, 10), (1, 11), (1, 11), (None, 5)], "srch_id long, prop_id long")

    def row(out):
        return tuple(submit.check(src, spark.createDataFrame(out, "srch_id long, prop_id long, rank long")).first())

    assert row([(1, 11, 1), (1, 10, 2), (1, 11, 3), (None, 5, 1)]) == (4, 4, 0, 0, 0)
    assert row([(1, 11, 1), (1, 10, 1), (1, 11, 3), (None, 5, 1)]) == (4, 4, 0, 0, 1)
    assert row([(1, 11, 1), (1, 10, 2), (None, 5, None)]) == (4, 3, 1, 0, 1)
    assert row([(1, 11, 1), (1, 10, 2), (1, 11, 3), (None, 5, 1), (9, 9, 2)]) == (4, 5, 0, 1, 1)


def test_small_fractions_are_not_empty(spark):
    df = spark.range(400_000).withColumnRenamed("id", "srch_id")
    n = split.sample(df, 0.00005, seed=3, key="srch_id").count()
    assert 2 <= n <= 60
    train, test = split.hash_split(df, test_fraction=1.0)
    assert train.count() == 0 and test.count() == 400_000


def test_features_leave_out_ids_and_labels(spark):
    cols = M.feature_columns(labels.relevance_grade(FE.build(fixture.search_log(spark, SF))))
    assert "price_per_person" in cols and not set(cols) & set(M.NON_FEATURES)


def test_settings_stay_in_the_space():
    for p in tune.sample_params(200):
        assert all(lo <= p[k] <= hi for k, (lo, hi) in tune.SPACE.items())
    assert {p["max_depth"] for p in tune.sample_params(200)} == set(range(3, 11))
    assert M.reference_settings()["max_iter"] == M.REFERENCE_PARAMS["rounds"]


def test_fitted_statistics_carry_over(spark):
    log = fixture.search_log(spark, SF)
    train, test = log.where("srch_id % 10 <> 1"), log.where("srch_id % 10 = 1")
    fitted = FE.fit_stats(train)
    a, b = FE.build(train, fitted), FE.build(test, fitted)
    assert a.columns == b.columns
    lo, hi = a.agg(F.min("normalized_hotel_quality"), F.max("normalized_hotel_quality")).first()
    assert (lo, hi) == pytest.approx((0.0, 1.0), abs=1e-12) and fitted.bounds is not None
    one = b.where("hotel_quality is not null").first()
    assert one["normalized_hotel_quality"] == pytest.approx(
        (one["hotel_quality"] - fitted.bounds[0]) / (fitted.bounds[1] - fitted.bounds[0]))


def test_pairwise_is_the_regression_on_pairs(spark):
    r = np.random.default_rng(4)
    rows = [(s, float(r.normal()), float(r.normal()), 0.0) for s in range(30) for _ in range(int(r.integers(2, 7)))]
    rows = [(s, x, z, 2 * x - z + 0.1 * float(r.normal())) for s, x, z, _ in rows]
    df = spark.createDataFrame(rows, "srch_id long, x double, z double, relevance_grade double")
    got = M.fit_pairwise(df, ["x", "z"], reg=0.0).model.stages[-1].coefficients.toArray()
    diff, y = [], []
    for i, a in enumerate(rows):
        for b in rows[:i]:
            if a[0] == b[0]:
                diff.append((a[1] - b[1], a[2] - b[2]))
                y.append(a[3] - b[3])
    want = np.linalg.lstsq(np.array(diff), np.array(y), rcond=None)[0]
    assert got == pytest.approx(want, rel=1e-6)


def test_boosting_prefixes_and_round_trip(spark, tmp_path):
    df = spark.range(600).select(
        (F.col("id") % 60).alias("srch_id"), F.col("id").alias("prop_id"), F.col("id").alias("position"),
        F.sin("id").alias("x"), F.when(F.col("id") % 5 > 0, F.cos("id")).alias("z"),
        F.when(F.sin("id") > 0.7, 5).when(F.sin("id") > 0.3, 1).otherwise(0).cast("double").alias("relevance_grade"))
    train, valid = split.mod_split(df)
    r = M.fit_ranker(train, ["x", "z"], max_iter=6, max_depth=3)
    whole = r.score(valid, "a")
    assert M.prefix_scores(r, whole).where("size(preds) <> 6 or abs(a - preds[5]) > 1e-9").count() == 0
    # every prefix: the sum of MLlib's own trees, scored and ranked one after the other
    gbt, ready = M.gbt_stage(r), M.prefix_scores(r, valid)
    x = PipelineModel(stages=r.model.stages[:-1]).transform(M._with_flags(valid, r.usable, r.flagged)).select("prop_id", "features")
    vectors = {v["prop_id"]: v["features"] for v in x.collect()}
    for row in ready.collect():
        sums = np.cumsum([w * t.predict(vectors[row["prop_id"]]) for w, t in zip(gbt.treeWeights, gbt.trees)])
        assert row["preds"] == pytest.approx(sums, abs=1e-9)
    table = {t["trees"]: t["mean_ndcg"] for t in M.ndcg_by_rounds(r, valid).collect()}
    assert sorted(table) == [1, 2, 3, 4, 5, 6]
    for n in (1, 4, 6):
        one = metrics.mean_ndcg(ready.withColumn("pred", F.col("preds")[n - 1]), score="pred").first()["mean_ndcg"]
        assert table[n] == pytest.approx(one, abs=1e-12)
    for step, patience in ((1, 10), (2, 2)):
        n = M.best_rounds(r, valid, step=step, patience=patience)
        assert 1 <= n <= 6 and (patience < 10 or table[n] == max(table.values()))
    r.save(str(tmp_path / "m"))
    assert M.Ranker.load(str(tmp_path / "m")).score(whole, "b").where("abs(a - b) > 1e-12").count() == 0
    assert M.importance(r).first()["feature"] == "x"


def test_pairwise_centres_hot_and_other_searches(spark):
    """Centring by windows and the hot search's broadcast means solve the all-pairs least squares."""
    r = np.random.default_rng(3)
    rows = [(1 if i % 3 == 0 else i // 8, float(r.normal()), None if i % 7 == 0 else float(r.normal()), float(r.integers(0, 6)))
            for i in range(1200)] + [(None, 5.0, 5.0, 1.0)]
    df = spark.createDataFrame(rows, "srch_id long, x double, z double, relevance_grade double")
    with session.staging(spark) as paths:
        fit = M.fit_pairwise(df, ["x", "z"], reg=0.0)
        centred = spark.read.parquet(next(p for p in paths if "pairwise-centred" in p))
        assert centred.count() == 1200 and any("search-sizes" in p for p in paths)
    filled = fit.model.stages[0].surrogateDF.first()["_f_z"]
    x = np.array([[a[1], filled if a[2] is None else a[2], a[2] is None] for a in rows[:-1]], float)
    s, y = np.array([a[0] for a in rows[:-1]]), np.array([a[3] for a in rows[:-1]])
    w = np.zeros(len(y))
    for k in set(s.tolist()):
        m = s == k
        x[m], y[m], w[m] = x[m] - x[m].mean(axis=0), y[m] - y[m].mean(), m.sum()
    want = np.linalg.solve(x.T @ (w[:, None] * x), x.T @ (w * y))
    assert np.allclose(fit.model.stages[-1].coefficients.toArray(), want, atol=1e-6)


def test_few_rounds_write_no_checkpoints(spark):
    """A checkpoint writes every row's prediction and error; twenty rounds do without."""
    df = spark.createDataFrame([(i, float(i % 7), float(i % 3)) for i in range(200)], "srch_id long, x double, relevance_grade double")
    base = session.ensure_checkpoint_dir(spark).removeprefix("file:")
    stamp = {d: os.stat(f"{base}/{d}").st_mtime_ns for d in os.listdir(base) if d != "tables"}
    r = M.fit_ranker(df, ["x"], max_iter=20, max_depth=2)
    assert M.gbt_stage(r).getCheckpointInterval() == -1 and M.gbt_stage(r).getNumTrees == 20
    assert stamp == {d: os.stat(f"{base}/{d}").st_mtime_ns for d in os.listdir(base) if d != "tables"}
    assert M._checkpoints(130) == 10
