"""Readers and writers for search logs and engineered tables.

Raw logs arrive as CSV with several spellings of null.  Spark's CSV reader
knows one ``nullValue``, so a file is read with every column as text, the
tokens are turned into null, and the known columns are parsed with
``try_cast`` (junk becomes null instead of failing the job).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchrank.functions.clean import DEFAULT_NULL_TOKENS
from searchrank.session import COMPACT, scratch_path

# The types of the raw search-log columns.
_INT = ("site_id", "visitor_location_country_id", "prop_country_id", "srch_destination_id",
        "random_bool", "promotion_flag", "srch_length_of_stay", "srch_booking_window",
        "srch_adults_count", "srch_children_count", "srch_room_count", "position",
        "click_bool", "booking_bool")
_LONG = ("srch_id", "prop_id")
_DOUBLE = ("visitor_hist_starrating", "visitor_hist_adr_usd", "prop_starrating",
           "prop_review_score", "prop_location_score1", "prop_location_score2",
           "prop_log_historical_price", "price_usd", "srch_query_affinity_score",
           "orig_destination_distance", "gross_bookings_usd")


def log_type(name: str) -> T.DataType | None:
    """Spark type of a known raw column (competitor columns included)."""
    if name in _LONG:
        return T.LongType()
    if name in _INT:
        return T.IntegerType()
    if name in _DOUBLE:
        return T.DoubleType()
    if name == "date_time":
        return T.TimestampType()
    if name.startswith("comp"):
        return T.DoubleType() if name.endswith("percent_diff") else T.IntegerType()
    return None


def read_log(spark: SparkSession, path: str, fmt: str = "csv",
             null_tokens: Iterable[str] = DEFAULT_NULL_TOKENS,
             schema: T.StructType | None = None) -> DataFrame:
    """Read a raw search log; known columns typed, unknown ones kept as read.

    CSV: header row, all text, ``null_tokens`` -> null, then ``try_cast``.
    Parquet/ORC: typed already; string columns still get the token rule.
    """
    if fmt == "csv":
        raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    else:
        raw = spark.read.format(fmt).load(path)
    tokens = list(null_tokens)
    wanted = {f.name: f.dataType for f in schema.fields} if schema is not None else {}
    cols = []
    for f in raw.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.when(F.trim(c).isin(tokens), F.lit(None).cast("string")).otherwise(c)
        target = wanted.get(f.name) or log_type(f.name)
        if target is not None and isinstance(f.dataType, T.StringType):
            if isinstance(target, T.TimestampType):
                c = F.try_to_timestamp(c)
            else:
                c = F.trim(c).try_cast(target)
        elif target is not None and f.dataType != target:
            c = c.cast(target)
        cols.append(c.alias(f.name))
    return raw.select(*cols)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = (), bucket_key: str | None = None,
                num_files: int | None = None) -> None:
    """Write an engineered table.

    Parquet by default; ``bucket_key`` clusters rows of a key into the same
    files (hash-repartition before the write) so later per-key jobs read
    co-located data; CSV gets a header row.
    """
    out = df
    if bucket_key:
        out = out.repartition(num_files, bucket_key) if num_files else out.repartition(bucket_key)
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def materialize(df: DataFrame, name: str = "stage", compact: bool = False) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Cuts the lineage of long plans (planning cost, recomputation after an
    executor loss) at the price of one write; the folder comes from
    ``spark.checkpoint.dir`` so it is shared storage on a cluster.  ``compact`` is for
    wide rows: they are written with ``session.COMPACT``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    (df.write.option("compression", COMPACT) if compact else df.write).mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def union_sets(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union by column name; columns missing on one side are null."""
    return a.unionByName(b, allowMissingColumns=True)
