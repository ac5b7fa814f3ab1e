"""Pair table and statistics joins: brute force, ties, nulls, and a search holding a third of all rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from searchrank.operators import features as FE
from searchrank.operators import metrics, pairs, skew
from searchrank.plans import model as M


def _log(n=6000, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        s = r.choice([7, r.randrange(400), None]) if i % 3 else 7
        rows.append((s, i, r.choice([None, float(r.randrange(9))]), r.choice([0, 0, 1, 5]), float(r.randrange(5)), r.randrange(2)))
    return rows, "srch_id long, prop_id long, price double, relevance_grade int, stars double, flag int"


def _slow_pairs(rows, k):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    out = {}
    for s, rs in by.items():
        rs.sort(key=lambda r: (r[2] is None, -(r[2] or 0), r[1]))
        ideal = sum(g / math.log2(p + 2) for p, g in enumerate(sorted((r[3] for r in rs), reverse=True)[:k]))
        for i, a in enumerate(rs[:k]):
            for j in range(i + 1, len(rs)):
                b = rs[j]
                if a[3] != b[3]:
                    d = 1 / math.log2(i + 2) - (1 / math.log2(j + 2) if j < k else 0)
                    out[s, i + 1, b[1]] = (int(a[3] > b[3]), round(abs(a[3] - b[3]) * d / ideal, 9), a[4] - b[4])
    return out


@pytest.mark.parametrize("k", [1, 6])
def test_pairs_equal_brute_force(spark, k):
    rows, schema = _log(900)
    df = spark.createDataFrame(rows, schema)
    got = pairs.make_pairs(df, ["stars"], score="price", k=k, tiebreak=("prop_id",)).collect()
    have = {(r["srch_id"], r["pos"], r["prop_id"]): (r["label"], round(r["weight"], 9), r["d_stars"]) for r in got}
    assert len(have) == len(got) and have == _slow_pairs(rows, k)
    flat = pairs.make_pairs(df, ["stars"], score="price", k=k, tiebreak=("prop_id",), weight="uniform")
    assert flat.agg(F.count("*"), F.sum("weight")).first() == (len(got), float(len(got)))
    assert pairs.make_pairs(df.limit(0), ["stars"], score="price", tiebreak=("prop_id",)).count() == 0
    with pytest.raises(ValueError):
        pairs.make_pairs(df, ["stars"], weight="other")


def _largest(df):
    """Largest and median rows of the partitions of a result."""
    n = sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
    return n[-1], n[len(n) // 2]


@pytest.fixture
def sixteen(spark):
    """16 shuffle partitions; nothing merges, splits or broadcasts a data side behind the operators' back."""
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_a_hot_search_does_not_fill_a_task(spark, sixteen):
    rows, schema = _log(24_000, seed=2)
    df = spark.createDataFrame(rows, schema)
    st = df.groupBy("srch_id").agg(F.count("*").alias("_rows"), F.avg("stars").alias("mean"))
    assert {r["srch_id"] for r in skew.hot_keys(st, "srch_id").collect()} == {7, None}
    plain = df.join(st, "srch_id")
    assert _largest(plain)[0] > 24_000 / 3  # what the split avoids
    got = skew.join_statistics(df, st, "srch_id")
    top, mid = _largest(got)
    assert top < 4 * mid
    want = {}
    for r in rows:
        want.setdefault(r[0], []).append(r[4])
    assert got.count() == len(rows)
    for r in got.select("srch_id", "mean").distinct().collect():
        assert r["mean"] == pytest.approx(np.mean(want[r["srch_id"]]))
    flag = df.withColumn("promotion_flag", F.col("flag"))
    top, mid = _largest(FE.promotion_features(flag))
    assert top < 4 * mid
    top, mid = _largest(FE.search_statistics(flag, zcols=["stars"]))
    assert top < 4 * mid
    top, mid = _largest(pairs.make_pairs(df, ["stars"], score="price", tiebreak=("prop_id",)))
    assert top < 6 * mid


def test_statistics_of_rows_without_a_search(spark):
    rows, schema = _log(300, seed=3)
    df = spark.createDataFrame(rows, schema).withColumn("promotion_flag", F.col("flag"))
    got = FE.search_statistics(df, zcols=["stars"])
    mine = [r for r in rows if r[0] is None]
    one = got.where("srch_id is null").agg(F.count("*"), F.max("promotion_count"), F.sum("normalized_stars")).first()
    assert one[0] == len(mine) and one[1] == sum(r[5] for r in mine) and one[2] == pytest.approx(0, abs=1e-9)
    nd = metrics.ndcg(df, score="price", tiebreak=("prop_id",)).where("srch_id is null").first()
    assert nd["dcg"] > 0 and 0 < nd["ndcg"] <= 1


def test_logistic_pairs_find_the_direction(spark, tmp_path):
    r = np.random.default_rng(5)
    rows = []
    for s in range(120):
        for p in range(9):
            x, z = float(r.normal()), float(r.normal())
            rows.append((s, p, x, z if p % 4 else None, float(np.clip(round(2 + 2 * x + 0.3 * r.normal()), 0, 5)), x))
    df = spark.createDataFrame(rows, "srch_id long, prop_id long, x double, z double, relevance_grade double, base double")
    for score in (None, "base"):
        m = M.fit_pairs(df, ["x", "z"], score=score)
        assert metrics.mean_ndcg(m.score(df), score="pred", tiebreak=("prop_id",)).first()["mean_ndcg"] > 0.9
    m.save(str(tmp_path / "m"))
    both = M.Ranker.load(str(tmp_path / "m")).score(m.score(df, "a"), "b")
    assert both.where("abs(a - b) > 1e-12").count() == 0
