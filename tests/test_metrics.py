"""DCG / NDCG against a plain-Python definition, plus edge cases."""

import math

import numpy as np
import pandas as pd
import pytest

from searchrank.operators import metrics


def dcg_ref(r, k, first_two=True):
    r = list(r)[:k]
    if not r:
        return 0.0
    if first_two:
        return r[0] + sum(x / math.log2(i) for i, x in enumerate(r[1:], start=2))
    return sum(x / math.log2(i + 2) for i, x in enumerate(r))


def ndcg_ref(r, k, first_two=True):
    best = dcg_ref(sorted(r, reverse=True), k, first_two)
    return 0.0 if not best else dcg_ref(r, k, first_two) / best


def _rows():
    rng = np.random.default_rng(0)
    rows = []
    for s in range(60):
        n = 1 if s % 7 == 0 else int(rng.integers(2, 15))
        for p in range(n):
            g = int(rng.choice([0, 0, 0, 1, 5]))
            rows.append((s, p, p, float(rng.normal()), g))
    rows.append((999, 0, 0, 1.0, 0))  # a search without any click
    rows.append((999, 1, 1, 0.5, 0))
    return pd.DataFrame(rows, columns=["srch_id", "prop_id", "position", "pred", "relevance_grade"])


@pytest.mark.parametrize("k,first_two", [(5, True), (3, False), (20, True)])
def test_ndcg_matches_reference(spark, k, first_two):
    pdf = _rows()
    df = spark.createDataFrame(pdf)
    got = metrics.ndcg(df, k=k, first_two_undiscounted=first_two).toPandas().set_index("srch_id")
    for s, g in pdf.groupby("srch_id"):
        order = g.sort_values(["pred", "prop_id"], ascending=[False, True])["relevance_grade"]
        assert got.loc[s, "ndcg"] == pytest.approx(ndcg_ref(order.tolist(), k, first_two), abs=1e-12)
    assert got.loc[999, "ndcg"] == 0.0
    assert ((got["ndcg"] >= 0) & (got["ndcg"] <= 1 + 1e-12)).all()


def test_mean_ndcg_and_ideal_is_one(spark):
    pdf = _rows()
    pdf["ideal"] = pdf["relevance_grade"] * 100 - pdf["position"]
    df = spark.createDataFrame(pdf)
    per = metrics.ndcg(df, score="ideal").toPandas()
    with_click = per["idcg"] > 0
    assert (per.loc[with_click, "ndcg"] - 1).abs().max() < 1e-12
    mean = metrics.mean_ndcg(df).collect()[0]
    assert mean["n_searches"] == pdf["srch_id"].nunique()


def test_weighted_mean(spark):
    df = spark.createDataFrame([(0.5, 10), (1.0, 30)], "m double, n long")
    assert metrics.weighted_mean(df, "m", "n").collect()[0][0] == pytest.approx(0.875)
