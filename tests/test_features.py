"""Feature operators on hand-made frames: the edge cases of SURVEY §5."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from searchrank.operators import features as FE
from searchrank.operators import stats

SCHEMA = ("srch_id long, prop_id long, position int, prop_country_id int, "
          "prop_location_score1 double, prop_location_score2 double, prop_starrating double, "
          "prop_review_score double, price_usd double, srch_room_count int, "
          "srch_adults_count int, srch_children_count int, srch_length_of_stay int, "
          "prop_log_historical_price double, visitor_hist_adr_usd double, "
          "visitor_hist_starrating double, promotion_flag int")


def _log(spark):
    rows = [
        # single-row search 1
        (1, 10, 1, 100, 1.0, 0.10, 3.0, 4.0, 120.0, 1, 2, 0, 2, 5.0, None, None, 1),
        # search 2: null price inside, zero guests on one row
        (2, 11, 1, 100, 2.0, None, 4.0, None, 90.0, 2, 0, 0, 1, 4.5, 80.0, 3.0, 0),
        (2, 12, 2, 100, None, 0.30, 2.0, 3.5, None, 1, 1, 1, 3, 4.0, 80.0, 3.0, 0),
        (2, 13, 3, 200, None, None, 5.0, 2.0, 90.0, 1, 2, 1, 2, 4.2, 80.0, 3.0, 1),
        # country 300 has no location scores at all
        (3, 14, 1, 300, None, None, 1.0, 1.0, 50.0, 1, 1, 0, 1, 3.9, None, None, 0),
        (3, 15, 2, 300, None, None, 1.0, 1.0, 60.0, 1, 1, 0, 1, 4.1, None, None, 0),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_impute_keeps_nulls_for_empty_country(spark):
    out = FE.impute_group_quantile(_log(spark)).orderBy("srch_id", "position").toPandas()
    c300 = out[out.prop_country_id == 300]
    assert c300.prop_location_score1.isna().all() and c300.prop_location_score2.isna().all()
    # country 100: score1 values [1.0, 2.0] -> nearest 0.25 quantile = x[floor(0.25+0.5)] = 1.0
    assert out.loc[(out.srch_id == 2) & (out.position == 2), "prop_location_score1"].item() == 1.0


def test_zscores_single_row_search_is_null(spark):
    d = FE.zero_fill(FE.location_ratio(FE.impute_group_quantile(_log(spark))))
    z = FE.zscore_within(d).where("srch_id = 1").collect()[0]
    assert z["normalized_prop_starrating"] is None
    q = FE.weighted_sum(FE.zscore_within(d)).where("srch_id = 1").collect()[0]
    assert q["hotel_quality"] is None


def test_price_features_zero_guests_and_null_rank(spark):
    d = FE.price_features(_log(spark))
    r = d.where("srch_id = 2 AND position = 1").collect()[0]
    assert r["price_per_person"] is None          # zero guests -> null, not an error
    assert r["total_price"] == 180.0
    ranks = FE.rank_features(_log(spark)).where("srch_id = 2").orderBy("position").collect()
    assert [x["price_rank"] for x in ranks] == [1, None, 1]   # null price -> null rank, ties dense
    assert [x["star_rank"] for x in ranks] == [2, 3, 1]


def test_promotion_features(spark):
    p = FE.promotion_features(_log(spark)).select("srch_id", "promotion_count", "promotion_any") \
        .distinct().orderBy("srch_id").collect()
    assert [(x[1], x[2]) for x in p] == [(1, 1), (1, 1), (0, 0)]


def test_minmax_constant_is_null(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "hotel_quality double")
    assert FE.minmax(df).collect()[0]["normalized_hotel_quality"] is None


@pytest.mark.parametrize("method,np_method", [("linear", "linear"), ("lower", "lower"),
                                              ("higher", "higher"), ("disc", "inverted_cdf"),
                                              ("midpoint", "midpoint")])
def test_quantile_methods_match_numpy(spark, method, np_method):
    rng = np.random.default_rng(5)
    g = rng.integers(0, 4, 500)
    x = np.round(rng.normal(size=500), 2)
    pdf = pd.DataFrame({"g": g, "x": x})
    got = stats.group_quantile(spark.createDataFrame(pdf), "g", ["x"], 0.3, method).toPandas()
    for _, row in got.iterrows():
        vals = pdf.loc[pdf.g == row.g, "x"].to_numpy()
        assert row.x_q == pytest.approx(float(np.quantile(vals, 0.3, method=np_method)), abs=1e-12)


def test_nearest_rounds_half_up(spark):
    df = spark.createDataFrame([(0, float(v)) for v in (10, 20, 30)], "g int, x double")
    # h = 0.25 * 2 = 0.5 -> rounds up to index 1
    assert stats.group_quantile(df, "g", ["x"], 0.25).collect()[0]["x_q"] == 20.0


def test_build_on_fixture_has_expected_columns(spark):
    from searchrank.sources import fixture
    eng = FE.build(fixture.search_log(spark, "/root/testdata/sf0.001"))
    cols = set(eng.columns)
    assert {"price_rank", "star_rank", "normalized_hotel_quality", "promotion_any"} <= cols
    assert not any(c.startswith("comp") for c in cols)
    assert "price_usd" not in cols and "prop_starrating" not in cols
    assert eng.count() == 6000
    v = eng.agg(F.min("normalized_hotel_quality"), F.max("normalized_hotel_quality")).collect()[0]
    assert math.isclose(v[0], 0.0) and math.isclose(v[1], 1.0)


def test_build_shuffles_wide_rows_once(spark):
    import io
    import re
    from contextlib import redirect_stdout

    from searchrank.operators import features
    from searchrank.sources import fixture
    key, old = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    try:
        log = fixture.search_log(spark, "/root/testdata/sf0.001")
        got = features.build(log)
        with io.StringIO() as text, redirect_stdout(text):
            got.explain("formatted")
            plan = text.getvalue()
        dealt = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", plan)
        # a column that only whole rows have
        assert sum("total_price" in x for x in dealt) == 1, dealt
        assert got.count() == log.count()
    finally:
        spark.conf.set(key, old)


def _hot_log(spark, counted=None):
    """The fixture's log with one search of a third of all rows, and rows without a search."""
    from searchrank.sources import fixture
    log = fixture.search_log(spark, "/root/testdata/sf0.001")
    own = F.when(F.col("prop_id") % 3 == 0, F.lit(1)).when(F.col("prop_id") % 50 != 1, F.col("srch_id"))
    log = log.withColumn("srch_id", own.cast("long"))
    if counted is None:
        return log

    def run(batches):
        for b in batches:
            counted.add(b.num_rows)
            yield b

    return log.mapInArrow(run, log.schema)


def test_build_derives_the_log_once(spark):
    """Quartiles, sparse columns, statistics and ranks all come from the rows written first."""
    seen = spark.sparkContext.accumulator(0)
    log = _hot_log(spark, seen)
    eng = FE.build(log)
    assert eng.count() == 6000 and seen.value == 6000
    FE.fit_stats(log)
    assert seen.value == 12000


def test_build_ranks_hot_and_other_searches_alike(spark):
    """Searches ranked by windows and the hot one agree with ranks and statistics of the whole log."""
    from pyspark.sql import Window
    log = _hot_log(spark)
    eng = FE.build(log)
    star, price = F.coalesce("prop_starrating", F.lit(0.0)), F.col("price_usd")
    search = Window.partitionBy("srch_id")
    want = log.select(
        "srch_id", "prop_id", "position", "supp_id",
        F.when(price.isNotNull(), F.dense_rank().over(search.orderBy(price.asc_nulls_last()))).alias("price_rank"),
        F.dense_rank().over(search.orderBy(star.desc())).alias("star_rank"),
        F.sum("promotion_flag").over(search).alias("promotion_count"), (price * F.col("srch_room_count")).alias("total_price"),
        ((star - F.avg(star).over(search)) / (F.stddev_samp(star).over(search) + FE.ZSCORE_EPS)).alias("z"))
    got = eng.select("srch_id", "prop_id", "position", "supp_id", "price_rank", "star_rank", "promotion_count", "total_price",
                     F.col("normalized_prop_starrating").alias("z"))

    def rows(df):
        return sorted(([-1 if v is None else round(v, 6) for v in r] for r in df.collect()))

    assert rows(got) == rows(want)
    assert dict(eng.dtypes)["price_rank"] == "bigint"


def test_build_shuffles_rows_and_not_their_statistics(spark):
    """Statistics are taken where the rows of a search meet (F11): nothing but the counts is staged per search."""
    from searchrank import session
    log = _hot_log(spark).where("srch_id <> 1")   # no search is hot
    with session.staging(spark) as paths:
        eng = FE.build(log)
        staged = {p.rsplit("/", 1)[-1].rsplit("-", 1)[0] for p in paths}
        assert not any("statistics" in p or p == "features-searches" for p in staged), staged
        assert "search-sizes" in staged
        assert eng.count() == log.count()
        got = FE.build(log, FE.fit_stats(log)).select("srch_id", "prop_id", "position", "supp_id", "normalized_hotel_quality")
        want = eng.select(got.columns)
        diff = got.alias("a").join(want.alias("b"), ["srch_id", "prop_id", "position", "supp_id"]).where(
            F.abs(F.col("a.normalized_hotel_quality") - F.col("b.normalized_hotel_quality")) > 1e-9)
        assert diff.count() == 0


def test_staged_wide_rows_are_compact(spark):
    from searchrank import session
    from searchrank.sources import fixture
    from searchrank.sources.io import materialize
    with session.staging(spark) as paths:
        FE.build(fixture.search_log(spark, "/root/testdata/sf0.001"))
        files = spark.read.parquet(next(p for p in paths if "features-rows" in p)).inputFiles()
    assert files and all(".zstd." in f for f in files)
    # others keep the session's codec: their sizes decide how files are dealt to tasks
    assert not any(".zstd." in f for f in materialize(spark.range(10), "small").inputFiles())
