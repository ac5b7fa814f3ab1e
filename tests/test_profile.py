"""Profiles against numpy / pandas definitions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from searchrank.operators import profile


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    n = 400
    pdf = pd.DataFrame({
        "a": rng.normal(size=n), "b": rng.normal(size=n) * 3 + 1,
        "c": np.ones(n), "d": rng.integers(0, 5, n).astype(float)})
    pdf.loc[rng.random(n) < 0.2, "a"] = np.nan
    pdf.loc[rng.random(n) < 0.3, "b"] = np.nan
    pdf.loc[rng.random(n) < 0.1, "d"] = np.nan
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None),
                                 "a double, b double, c double, d double"), pdf


def test_histogram_matches_numpy(data):
    df, pdf = data
    got = profile.histogram(df, "b", 20).orderBy("bin").toPandas()
    exp, edges = np.histogram(pdf["b"].dropna(), bins=20)
    assert got["count"].tolist() == exp.tolist()
    assert np.allclose(got["bin_lo"], edges[:-1])
    got = profile.histogram(df, "b", 10, (0.0, 2.0)).orderBy("bin").toPandas()
    exp, _ = np.histogram(pdf["b"].dropna(), bins=10, range=(0.0, 2.0))
    assert got["count"].tolist() == exp.tolist()


def test_box_stats(data):
    df, pdf = data
    x = pdf["b"].dropna().to_numpy()
    q1, med, q3 = np.percentile(x, [25, 50, 75])
    iqr = q3 - q1
    lo = x[x >= q1 - 1.5 * iqr].min()
    hi = x[x <= q3 + 1.5 * iqr].max()
    r = profile.box_stats(df, "b").collect()[0]
    assert r["q1"] == pytest.approx(q1) and r["median"] == pytest.approx(med)
    assert r["whislo"] == pytest.approx(lo) and r["whishi"] == pytest.approx(hi)
    assert r["n_fliers_low"] + r["n_fliers_high"] == int(((x < lo) | (x > hi)).sum())


def test_correlation_pairwise_and_constant(data):
    df, pdf = data
    got = profile.correlation(df, ["a", "b", "c", "d"]).toPandas()
    exp = pdf.corr()
    for _, r in got.iterrows():
        e = exp.loc[r.col_a, r.col_b]
        if "c" in (r.col_a, r.col_b):
            assert r["corr"] is None or np.isnan(r["corr"])
        else:
            assert r["corr"] == pytest.approx(e, abs=1e-9)


def test_null_correlation(data):
    df, pdf = data
    got = profile.null_correlation(df).toPandas()
    ind = pdf[["a", "b", "d"]].isnull().astype(float)
    exp = ind.corr()
    assert set(zip(got.col_a, got.col_b)) == {("a", "b"), ("a", "d"), ("b", "d")}
    for _, r in got.iterrows():
        assert r["corr"] == pytest.approx(exp.loc[r.col_a, r.col_b], abs=1e-9)


def test_null_counts_and_describe(data):
    df, pdf = data
    nc = dict(profile.null_counts(df).collect())
    assert nc == {c: int(pdf[c].isna().sum()) for c in "abd"}
    d = profile.describe(df, ["a", "d"]).toPandas().set_index("column")
    assert d.loc["a", "count"] == pdf["a"].count()
    assert d.loc["a", "mean"] == pytest.approx(pdf["a"].mean())
    assert d.loc["d", "q50"] == pytest.approx(np.quantile(pdf["d"].dropna(), 0.5, method="nearest"))


def test_key_overlap(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k long")
    b = spark.createDataFrame([(2,), (3,), (4,), (4,), (4,)], "k long")
    r = profile.key_overlap(a, b, "k").collect()[0]
    assert (r.n_a, r.n_b, r.n_both, r.n_union, r.n_a_only, r.n_b_only) == (3, 3, 2, 4, 1, 1)
    assert (r.rows_a_only, r.rows_b_only) == (1, 3)


def test_all_null_column_edges(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, None)], "id long, x double")
    assert profile.histogram(df, "x", 5).count() == 0            # no values: no bins
    d = profile.describe(df, ["id", "x"]).toPandas().set_index("column")
    assert d.loc["x", "count"] == 0 and d.loc["x", "null_count"] == 3
    assert d.loc["id", "q50"] == 2.0
    assert profile.box_stats(df, "x").count() == 0
    flat = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    h = profile.histogram(flat, "x", 4).orderBy("bin").collect()
    assert [r["count"] for r in h] == [0, 0, 2, 0] and h[0]["bin_lo"] == 1.5   # numpy widens by 0.5


def test_gram_of_many_parts(spark):
    """Shifted values, nulls and NaN over many partitions, against pandas; both tables from one call."""
    import pandas as pd
    r = np.random.default_rng(11)
    n = 5000
    x = r.normal(size=n)
    pdf = pd.DataFrame({"a": x, "b": 1e9 + 0.5 * x + r.normal(size=n), "c": -x * 1e-6, "d": np.full(n, 3.0),
                        "e": r.integers(0, 2, n).astype(float)})
    for c, share in (("a", 0.2), ("b", 0.5), ("e", 0.9)):
        pdf.loc[r.random(n) < share, c] = np.nan
    pdf.loc[:999, "c"] = np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in t) for t in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(7)
    corr, nulls = profile.correlations(df, list(pdf), list(pdf))
    want = pdf.corr()
    for t in corr.collect():
        w = want.loc[t["col_a"], t["col_b"]]
        assert t["corr"] is None if np.isnan(w) or "d" in (t["col_a"], t["col_b"]) else t["corr"] == pytest.approx(w, abs=1e-7)
    want = pdf.isna().astype(float).drop(columns="d").corr()
    got = {(t["col_a"], t["col_b"]): t["corr"] for t in nulls.collect()}
    assert len(got) == 6 and all(v == pytest.approx(want.loc[k], abs=1e-12) for k, v in got.items())
    empty = profile.correlations(df.limit(0), ["a", "b"], ["a"])
    assert empty[0].where("corr is not null").count() == 0 and empty[1].count() == 0


def test_overlap_sketch_error(spark):
    a = spark.range(0, 60_000).select((F.col("id") * 7).alias("k"))
    b = spark.range(30_000, 100_000).select((F.col("id") * 7).alias("k"))
    want = {"n_a": 60_000, "n_b": 70_000, "n_both": 30_000, "n_union": 100_000, "n_a_only": 30_000, "n_b_only": 40_000}
    for lg in (10, 14):
        got = profile.key_overlap_approx(a, b, "k", lg).first()
        assert 0 < got["error"] <= 4 * 101_000 / 2 ** (lg / 2) * 1.1
        assert all(abs(got[k] - v) <= got["error"] for k, v in want.items())
    small = profile.key_overlap_approx(a.limit(50), b.limit(0), "k").first()
    assert (small["n_a"], small["n_both"], small["n_union"], small["n_a_only"], small["error"]) == (50, 0, 50, 50, 0.0)
