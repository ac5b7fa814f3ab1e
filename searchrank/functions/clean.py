"""Cleaning: null tokens, lenient numeric parsing, column pruning rules.

Everything here is a column expression (``try_cast``, ``when``,
``regexp_replace``): no Python runs per row.  Rule for missing values:
null only -- a NaN produced by parsing is turned into null at once,
because Spark's min/max/avg/percentile treat NaN as a value.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default null spellings in raw files, and the pattern of
# competitor columns removed from the engineered set.
DEFAULT_NULL_TOKENS = ("NULL", "NA", "")
COMPETITOR_PREFIX = "comp"
COMPETITOR_PARTS = ("rate", "inv", "percent_diff")


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of numeric columns (P6), booleans excluded."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def null_tokens(df: DataFrame, tokens: Iterable[str] = ("NULL",),
                cols: Sequence[str] | None = None) -> DataFrame:
    """Replace sentinel strings by null in string columns (S3)."""
    tokens = list(tokens)
    cols = set(cols) if cols is not None else set(string_columns(df))
    out = [F.when(F.col(c).isin(tokens), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
           if c in cols else F.col(c) for c in df.columns]
    return df.select(*out)


def text_to_double(s: Column) -> Column:
    """String -> double; junk and NaN become null.

    A number has a digit and an infinity an ``i``; only such text is cast, since
    a cast that fails throws and catches an exception inside Spark, which costs
    far more than the cast of a number.
    """
    return F.when(s.rlike("[0-9iI]"), s.try_cast("double"))


def parse_double(c: Column, tokens: Iterable[str] = DEFAULT_NULL_TOKENS) -> Column:
    """Lenient string -> double: tokens and junk become null, NaN too."""
    tokens = list(tokens)
    s = F.trim(c.cast("string"))
    return F.when(s.isin(tokens), F.lit(None).cast("double")).otherwise(text_to_double(s))


def to_double(df: DataFrame, cols: Sequence[str],
              tokens: Iterable[str] = DEFAULT_NULL_TOKENS) -> DataFrame:
    """Parse the listed columns to double."""
    cols = set(cols)
    return df.select(*[parse_double(F.col(c), tokens).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def coerce_numeric(df: DataFrame, exclude: Sequence[str] = ("date_time",),
                   tokens: Iterable[str] = DEFAULT_NULL_TOKENS) -> DataFrame:
    """Every string column (but ``exclude``) to double; unparsable -> null."""
    targets = [c for c in string_columns(df) if c not in set(exclude)]
    return to_double(df, targets, tokens)


def replace_then_cast(df: DataFrame, cols: Sequence[str] | None = None,
                      replacements: Sequence[tuple[str, str]] = (("NULL", "NaN"), ("N/A", "NaN"))
                      ) -> DataFrame:
    """String replace (literal) then cast to double; NaN -> null."""
    cols = set(cols) if cols is not None else set(string_columns(df))
    out = []
    for c in df.columns:
        if c in cols:
            e = F.col(c)
            for a, b in replacements:
                e = F.replace(e, F.lit(a), F.lit(b))
            out.append(F.trim(e).alias(c))
        else:
            out.append(F.col(c))
    # two steps: the text is made once and then read by the test and by the cast
    return df.select(*out).select(*[text_to_double(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def fill_null(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """coalesce(col, value) for each listed column."""
    return df.select(*[F.coalesce(F.col(c), F.lit(values[c])).alias(c) if c in values
                       else F.col(c) for c in df.columns])


def fill_nan(df: DataFrame, cols: Sequence[str], value: float = 0.0) -> DataFrame:
    """NaN -> value, nulls untouched."""
    cols = set(cols)
    return df.select(*[F.nanvl(F.col(c), F.lit(value)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def competitor_columns(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c.startswith(COMPETITOR_PREFIX)
            and any(p in c for p in COMPETITOR_PARTS)]


def drop_matching(df: DataFrame) -> DataFrame:
    """Drop competitor columns by name pattern."""
    return df.drop(*competitor_columns(df.columns))


def null_count_exprs(cols: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(c) for c in cols]


def sparse_report(df: DataFrame, threshold: float = 0.9,
                  keep: Sequence[str] = ()) -> DataFrame:
    """(column, null_count, rows, dropped): one aggregate over all columns.

    A column is dropped when its null count is strictly above
    ``threshold * rows`` and it is not in ``keep`` (P4).
    """
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_rows"), *null_count_exprs(cols))
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("null_count"))
                             for c in cols]))
    long = agg.select(F.col("_rows").alias("rows"), kv.alias("_kv")) \
              .select("_kv.column", "_kv.null_count", "rows")
    dropped = (F.col("null_count") > F.lit(threshold) * F.col("rows")) & \
        ~F.col("column").isin(list(keep))
    return long.withColumn("dropped", dropped)


def drop_sparse(df: DataFrame, threshold: float = 0.9, keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Drop columns above the null threshold; returns (frame, dropped names).

    Runs one aggregate (a single row of per-column null counts reaches the
    driver; its size is the number of columns, not rows).
    """
    rep = sparse_report(df, threshold, keep).where("dropped").select("column").collect()
    names = [r["column"] for r in rep]
    return df.drop(*names), names


def cap_filter(df: DataFrame, col: str = "price_usd", upper: float = 2000.0) -> DataFrame:
    """Keep rows with ``col < upper`` (optional outlier rule, P14); a
    pushed-down predicate when ``df`` is a scan."""
    return df.where(F.col(col) < upper)
