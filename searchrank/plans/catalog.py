"""Registry of named queries (Spark) and their oracle SQL (DuckDB).

Each query takes ``(spark, sf_dir)``, reads the driver's tables under
``sf_dir`` and returns a DataFrame.  Derived doubles are rounded to six
digits on both sides so that summation order cannot change the result.
A query frees the tables it staged, but for those its lazy result reads.
Queries run on wide rows, so the session gets ``session.METHOD_LIMIT`` and ``session.TASK_SIZE`` first.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchrank.session import limit_methods, limit_tasks, tidy

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        @wraps(fn)
        def run(spark: SparkSession, *args, **kw) -> DataFrame:
            limit_methods(spark)   # both stay set: the lazy result runs after the query returned
            limit_tasks(spark)
            return fn(spark, *args, **kw)

        QUERIES[name] = tidy(run)
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double/float column."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
