"""Cleaning, labels, splits, partitions, submissions, pairs, entry smoke."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from searchrank.functions import clean, labels
from searchrank.operators import pairs, partition, split, submit

SF = "/root/testdata/sf0.001"


def test_parse_tokens_junk_nan(spark):
    df = spark.createDataFrame([("1.5",), ("NULL",), ("NA",), ("",), ("junk",), ("NaN",), ("N/A",)],
                               "x string")
    got = [r[0] for r in clean.to_double(df, ["x"]).collect()]
    assert got == [1.5, None, None, None, None, None, None]
    got = [r[0] for r in clean.replace_then_cast(df, ["x"]).collect()]
    assert got == [1.5, None, None, None, None, None, None]


def test_drop_sparse_strict_threshold(spark):
    rows = [(i, None if i < 9 else 1.0, None) for i in range(10)]
    df = spark.createDataFrame(rows, "id int, nine double, keepme double")
    out, dropped = clean.drop_sparse(df, 0.9, keep=("keepme",))
    assert dropped == [] and out.columns == df.columns        # 9 nulls is not > 9.0
    out, dropped = clean.drop_sparse(df, 0.85, keep=("keepme",))
    assert dropped == ["nine"]


def test_grade_and_weight(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (0, 0)], "booking_bool int, click_bool int")
    g = labels.relevance_weight(labels.relevance_grade(df)).collect()
    assert [(r.relevance_grade, r.weight) for r in g] == [(5, 6), (1, 1), (0, 0)]


def test_splits_are_by_search(spark):
    df = spark.range(1000).withColumnRenamed("id", "srch_id")
    tr, va = split.mod_split(df)
    assert va.where(F.col("srch_id") % 10 != 1).count() == 0 and tr.count() + va.count() == 1000
    tr, te = split.hash_split(df, test_fraction=0.2)
    assert tr.join(te, "srch_id").count() == 0 and 150 < te.count() < 250


def test_partition_boundary_tie_takes_upper(spark):
    # counts after isolating the largest (100): 40, 30, 20, 10 -> total 100, n=4 -> size 25
    rows = [(c,) for c, n in [(9, 100), (1, 40), (2, 30), (3, 20), (4, 10)] for _ in range(n)]
    df = spark.createDataFrame(rows, "prop_country_id int")
    m = {r.prop_country_id: r.part_id for r in partition.assign(df, n=4).collect()}
    # cum: 40 -> 1, 70 -> 2, 90 -> 3, 100 -> min(4, 3) = 3 ; slices numbered from 1
    assert m == {9: 0, 1: 2, 2: 3, 3: 4, 4: 4}
    rows = [(c,) for c, n in [(9, 100), (1, 25), (2, 25), (3, 50)] for _ in range(n)]
    m = {r.prop_country_id: r.part_id for r in
         partition.assign(spark.createDataFrame(rows, "prop_country_id int"), n=4).collect()}
    # size 25: (3) cum 50 -> 2 -> slice 3 ; (1) cum 75 -> 3 -> slice 4 ; (2) cum 100 -> 4 -> 3 -> 4
    assert m == {9: 0, 3: 3, 1: 4, 2: 4}


def test_pair_counts_brute_force(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"srch_id": rng.integers(0, 20, 300), "relevance_grade": rng.choice([0, 1, 5], 300)})
    got = {r.srch_id: r.n_pairs for r in pairs.pair_counts(spark.createDataFrame(pdf)).collect()}
    for s, g in pdf.groupby("srch_id"):
        v = g["relevance_grade"].to_numpy()
        assert got[s] == int((v[:, None] > v[None, :]).sum())


def test_all_pairs_identity():
    rng = np.random.default_rng(0)
    z = rng.normal(size=9)
    pairs_sum = sum((z[a] - z[b]) ** 2 for a in range(9) for b in range(a + 1, 9))
    assert np.isclose(pairs_sum, 9 * ((z - z.mean()) ** 2).sum())


def test_submission_check_and_ideal(spark):
    from searchrank.sources import fixture
    test = fixture.test_log(spark, SF)
    sub = submit.ranked(test, score="price_usd", tiebreak=("prop_id", "supp_id"))
    r = submit.check(test, sub).collect()[0]
    assert r.rows_in == r.rows_out and r.missing_pairs == 0 and r.extra_pairs == 0
    assert r.bad_rank_searches == 0


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "mean_ndcg" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())


def test_halving_stops_poor_trials(spark):
    from searchrank.plans import tune
    calls = []

    def objective(p, rounds):
        calls.append((p["trial"], rounds))
        return -abs(p["eta"] - 0.05) + rounds / 1000

    t = {r["trial"]: r for r in tune.halving_search(spark, objective, n_trials=50, rungs=((3, 0.25), (8, 0.25), (20, 0.0))).collect()}
    assert len(t) == 50 and [sum(1 for c in calls if c[1] == n) for n in (3, 8, 20)] == [50, 13, 4]
    near = sorted(t, key=lambda k: abs(t[k]["eta"] - 0.05))
    assert {k for k in t if not t[k]["stopped"]} == set(near[:4]) and {k for k in t if t[k]["rung"] >= 2} == set(near[:13])
    assert [k for k in t if t[k]["is_best"]] == near[:1] and all(t[k]["rounds"] == (3, 8, 20)[t[k]["rung"] - 1] for k in t)
    for name, (lo, hi) in tune.SPACE.items():
        assert all(lo <= r[name] <= hi for r in t.values())
    assert tune.halving_search(spark, objective, n_trials=0).count() == 0
    one = tune.halving_search(spark, lambda p, n: 1.0, n_trials=1).first()
    assert one["is_best"] and not one["stopped"]


def test_text_to_double_casts_only_what_can_be_a_number(spark):
    text = ["1", " -2.5 ", "1e3", ".5", "0x1p3", "NaN", "nan", "+NaN", "inf", "-Infinity", "+INF", "Infinity", "", " ",
            "NA", "NULL", "N/A", "junk", "i", "1x", "-", "NULL1", "\t7\t", "\u0663", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(text)], "i int, t string")
    plain = F.trim("t").try_cast("double")
    want = F.when(~F.isnan(plain), plain)
    got = df.select("i", want.alias("want"), clean.text_to_double(F.trim("t")).alias("got")).collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]
    both = clean.replace_then_cast(df.withColumn("u", F.col("t")), ["t"])
    assert {r["i"]: r["t"] for r in both.collect()} == {r["i"]: r["want"] for r in got}
    # text that cannot be a number never reaches the cast, which would throw inside
    plan = both._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001
    assert "RLIKE" in plan and plan.count("replace(") == 2
