"""Bringing per-key statistics back to rows when one key holds a large share of them.

An equi-join sends all rows of a key to one task.  The statistics side has one
row per key and carries its row count, so the keys that hold more than one
partition's share of all rows are known exactly; there are fewer of them
than partitions, whatever the data.  This short list is broadcast: rows of a
listed key are dealt over as many salts as shares the key holds, by a hash
of their content, and the key's one statistics row is copied to each salt.
All other rows join as usual, in the same shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchrank.operators.sequence import _null_safe

_SALT, _COPIES = "_sr_salt", "_sr_copies"


def hot_keys(stats: DataFrame, by: str, rows: str = "_rows", parts: int | None = None) -> DataFrame:
    """(by, copies): keys with more than 1 / ``parts`` of all rows, and how many shares they hold.

    At most ``parts`` - 1 rows, since the counts sum to the whole.
    """
    parts = parts or int(stats.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = stats.agg(F.sum(rows)).first()[0] or 0
    share = max(-(-total // parts), 1)
    return stats.where(F.col(rows) > share).select(by, F.ceil(F.col(rows) / F.lit(share)).cast("int").alias(_COPIES))


def join_statistics(df: DataFrame, stats: DataFrame, by: str, rows: str = "_rows",
                    parts: int | None = None) -> DataFrame:
    """Every row of ``df`` with the columns of its key's row in ``stats`` (without ``rows``).

    ``stats`` has one row per key of ``df`` (null is a key like any other) and the
    key's row count in ``rows``; stage it, as it is read three times.  Rows of ``df``
    equal in every column share a salt.  A key without a row in ``stats`` is
    left out.
    """
    hot = hot_keys(stats, by, rows, parts)
    if hot.isEmpty():
        return _null_safe(df, stats.drop(rows), [by], "inner")
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.col(_COPIES)).cast("int")
    left = _null_safe(df, F.broadcast(hot), [by], "left").withColumn(_SALT, F.coalesce(salt, F.lit(0))).drop(_COPIES)
    right = _null_safe(stats.drop(rows), F.broadcast(hot), [by], "left")
    right = right.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_COPIES), F.lit(1)) - 1))).drop(_COPIES)
    return _null_safe(left, right, [by, _SALT], "inner").drop(_SALT)


def hot_searches(rows: DataFrame, by: str) -> DataFrame:
    """(by): keys that hold more than a partition's share of ``rows``, fewer than partitions.  The counts are staged."""
    from searchrank.sources.io import materialize
    return hot_keys(materialize(rows.groupBy(by).agg(F.count(F.lit(1)).alias("_rows")), "search-sizes"), by).select(by)


def cut(rows: DataFrame, hot: DataFrame, by: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary keys, and those of the ``hot`` ones if there are any."""
    if hot.isEmpty():
        return rows, None
    return (_null_safe(rows, F.broadcast(hot), [by], "left_anti"), _null_safe(rows, F.broadcast(hot), [by], "left_semi"))
