"""The search log rebuilt from the driver's TPC-H-style tables.

One output row per ``lineitem`` row: a search (``srch_id`` = order) shows a
hotel (``prop_id`` = part) at a position (line number).  Every column is a
plain expression of the joined row, so the log grows with the tables.

Join order is chosen for scale: lineitem is first joined to its two
dimension tables keyed by part and supplier, and the *last* join is the
one on the order key.  The result therefore leaves the join already
hash-partitioned by ``srch_id`` (an alias of ``l_orderkey``), the key of
nearly all later per-search work.  No side gets a broadcast hint: every
dimension grows with the scale factor, so the choice is left to AQE's
measured-size check (broadcast below ``autoBroadcastJoinThreshold``,
sort-merge join above it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("lineitem", "orders", "customer", "part", "supplier")

# The label columns the test set lacks, and the tokens the
# polluted text variant spells nulls with.
LABEL_COLUMNS = ("position", "click_bool", "booking_bool", "gross_bookings_usd")
NULL_TOKENS = ("NULL", "NA", "")
N_COMPETITORS = 8


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _when(cond: Column, value: Column) -> Column:
    return F.when(cond, value)


def search_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training log: all columns of FIXTURES.md §3."""
    li = read_table(spark, sf_dir, "lineitem")
    od = read_table(spark, sf_dir, "orders")
    cu = read_table(spark, sf_dir, "customer")
    pa = read_table(spark, sf_dir, "part")
    su = read_table(spark, sf_dir, "supplier")

    item = (li.join(pa, li.l_partkey == pa.p_partkey)
              .join(su, li.l_suppkey == su.s_suppkey))
    search = od.join(cu, od.o_custkey == cu.c_custkey)
    j = item.join(search, item.l_orderkey == search.o_orderkey)

    pk, sk, ok = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey")
    ln, ck = F.col("l_linenumber"), F.col("c_custkey")
    h = (pk * 31 + F.when(pk % 2 == 0, ln * 7).otherwise(0)) % 100
    hist = ck % 4 == 0

    cols = [
        ok.alias("srch_id"),
        pk.alias("prop_id"),
        ln.alias("position"),
        sk.alias("supp_id"),
        F.col("o_orderdate").alias("date_time"),
        (ck % 34).cast("int").alias("site_id"),
        F.col("c_nationkey").alias("visitor_location_country_id"),
        F.col("s_nationkey").alias("prop_country_id"),
        (ok % 97).cast("int").alias("srch_destination_id"),
        F.when(ok % 10 < 3, 1).otherwise(0).alias("random_bool"),
        _when(hist, (1 + ck % 5).cast("double")).alias("visitor_hist_starrating"),
        _when(hist, F.abs("c_acctbal")).alias("visitor_hist_adr_usd"),
        (F.col("p_size") % 6).cast("double").alias("prop_starrating"),
        _when((pk + sk) % 7 != 0, (pk % 11).cast("double") / 2.0).alias("prop_review_score"),
        _when(sk % 9 != 0, F.col("l_tax") * 100.0).alias("prop_location_score1"),
        _when((sk + ln) % 5 != 0, F.col("l_discount")).alias("prop_location_score2"),
        F.ln("p_retailprice").alias("prop_log_historical_price"),
        _when((pk + ln) % 13 != 0, F.col("l_extendedprice")).alias("price_usd"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("promotion_flag"),
        (1 + sk % 7).cast("int").alias("srch_length_of_stay"),
        (ok % 60).cast("int").alias("srch_booking_window"),
        (ok % 3).cast("int").alias("srch_adults_count"),
        (ok % 2).cast("int").alias("srch_children_count"),
        (1 + ok % 2).cast("int").alias("srch_room_count"),
        _when(pk % 16 == 0, -1.0 * F.col("l_quantity")).alias("srch_query_affinity_score"),
        _when(ok % 3 != 0, F.col("o_totalprice") / 100.0).alias("orig_destination_distance"),
    ]
    for k in range(1, N_COMPETITORS + 1):
        cols += [
            _when(h < 5 * k, (pk % 3 - 1).cast("int")).alias(f"comp{k}_rate"),
            _when(h < 5 * k, (sk % 2).cast("int")).alias(f"comp{k}_inv"),
            _when(h < 4 * k, F.col("l_quantity")).alias(f"comp{k}_rate_percent_diff"),
        ]
    cols += [
        F.when((F.col("l_linestatus") == "F") | (pk % 10 == 3), 1).otherwise(0).alias("click_bool"),
        F.when(pk % 10 == 3, 1).otherwise(0).alias("booking_bool"),
        _when(pk % 10 == 3, F.col("l_extendedprice")).alias("gross_bookings_usd"),
    ]
    return j.select(*cols)


def test_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unlabeled "test" set: holdout searches without label columns."""
    log = search_log(spark, sf_dir)
    return log.where(F.col("srch_id") % 10 == 1).drop(*LABEL_COLUMNS)


def nullable_numeric_columns(df: DataFrame) -> list[str]:
    """Columns of the log that carry nulls by construction."""
    fixed = {"visitor_hist_starrating", "visitor_hist_adr_usd", "prop_review_score",
             "prop_location_score1", "prop_location_score2", "price_usd",
             "srch_query_affinity_score", "orig_destination_distance", "gross_bookings_usd"}
    comp = {c for c in df.columns if c.startswith("comp")}
    return [c for c in df.columns if c in fixed or c in comp]


def polluted_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text variant for the cleaning operators.

    Nullable numeric columns become strings; a null is spelled ``NULL``,
    ``NA`` or the empty string, chosen by ``(srch_id + position) % 3``.
    """
    log = search_log(spark, sf_dir)
    tok = (F.col("srch_id") + F.col("position")) % 3
    token = (F.when(tok == 0, F.lit(NULL_TOKENS[0]))
               .when(tok == 1, F.lit(NULL_TOKENS[1]))
               .otherwise(F.lit(NULL_TOKENS[2])))
    nullable = set(nullable_numeric_columns(log))
    out = [F.coalesce(F.col(c).cast("string"), token).alias(c) if c in nullable else F.col(c)
           for c in log.columns]
    return log.select(*out)
