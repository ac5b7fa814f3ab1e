"""Grouped statistics: quantiles, value counts, group sizes, distinct keys.

Exact quantiles never gather a group's values in one place.  Values are
first counted per ``(group, value)`` (a partial aggregation, so repeated
values collapse before the shuffle), the counts get a running total in
value order (``sequence.running_within``, which splits a hot group across
partitions), and each group then reads off the value whose position range
holds the target index.  ``method="approx"`` uses ``percentile_approx``
instead: a fixed-size sketch per group, for columns with very many
distinct values.  Quantiles of whole columns (``quantiles_wide``) are found digit
by digit from histograms of fixed size.

Quantile methods follow the usual definitions on the sorted non-null
values x[0..n-1] with h = q * (n - 1):
    lower   x[floor(h)]             higher  x[ceil(h)]
    nearest x[floor(h + 0.5)]       (half rounds up; the default, as the
                                     original feature step relied on it)
    linear  x[floor(h)] + (h - floor(h)) * (x[ceil(h)] - x[floor(h)])
    midpoint (x[floor(h)] + x[ceil(h)]) / 2
    disc    x[max(ceil(q * n) - 1, 0)]  (SQL percentile_disc: the smallest
                                     value whose cumulative share >= q)
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from searchrank.operators.sequence import _null_safe, running_within

METHODS = ("nearest", "lower", "higher", "linear", "midpoint", "disc", "approx")


def _long(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """(by..., _name, _value) for every non-null value of ``cols``."""
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("_name"),
                                      F.col(c).cast("double").alias("_value")) for c in cols]))
    return (df.select(*by, kv.alias("_kv"))
              .select(*by, "_kv._name", "_kv._value")
              .where(F.col("_value").isNotNull() & ~F.isnan("_value")))


def quantiles_long(df: DataFrame, by: Sequence[str], cols: Sequence[str],
                   qs: Sequence[float], method: str = "nearest",
                   accuracy: int = 100_000) -> DataFrame:
    """(by..., column, q, value): quantile ``q`` of every column per group."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    by = list(by)
    long = _long(df, by, cols)
    if method == "approx":
        agg = long.groupBy(*by, "_name").agg(
            F.percentile_approx("_value", list(qs), accuracy).alias("_v"))
        return agg.select(*by, F.col("_name").alias("column"),
                          F.explode(F.arrays_zip(F.array(*[F.lit(float(q)) for q in qs]).alias("q"),
                                                 F.col("_v").alias("value"))).alias("_z")) \
                  .select(*by, "column", "_z.q", "_z.value")

    keys = by + ["_name"]
    counts = value_counts_long(df, by, cols)
    return quantiles_from_counts(counts, by, qs, method)


def value_counts_long(df: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """(by..., _name, _value, _n): rows per distinct non-null value of every
    column, written once to the checkpoint folder.  A partial aggregation:
    repeated values collapse inside each map task before the shuffle."""
    from searchrank.sources.io import materialize
    by = list(by)
    counts = _long(df, by, cols).groupBy(*by, "_name", "_value").agg(
        F.count(F.lit(1)).alias("_n"))
    # feeds the range sampling, the numbering pass and the totals
    return materialize(counts, "value-counts")


def quantiles_from_counts(counts: DataFrame, by: Sequence[str], qs: Sequence[float],
                          method: str = "nearest") -> DataFrame:
    """Exact quantiles from a ``value_counts_long`` table."""
    by = list(by)
    keys = by + ["_name"]
    run = running_within(counts, keys, [F.col("_value").asc()], out="_cum", weight="_n")
    totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    qdf = F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q")
    targets = totals.select(*keys, "_total", qdf)
    if method == "disc":
        h = F.greatest(F.ceil(F.col("q") * F.col("_total")) - 1, F.lit(0)).cast("double")
    else:
        h = F.col("q") * (F.col("_total") - 1)
    targets = targets.select(*keys, "q", h.alias("_h"),
                             F.floor(h).cast("long").alias("_lo"),
                             F.ceil(h).cast("long").alias("_hi"))
    # value at 0-based index i: the row with cum - n <= i < cum
    j = _null_safe(run, targets, keys, "inner")
    start = F.col("_cum") - F.col("_n")
    has_lo = (start <= F.col("_lo")) & (F.col("_lo") < F.col("_cum"))
    has_hi = (start <= F.col("_hi")) & (F.col("_hi") < F.col("_cum"))
    picked = (j.where(has_lo | has_hi)
               .groupBy(*keys, "q", "_h", "_lo")
               .agg(F.max(F.when(has_lo, F.col("_value"))).alias("_vlo"),
                    F.max(F.when(has_hi, F.col("_value"))).alias("_vhi")))
    frac = F.col("_h") - F.col("_lo")
    lo, hi = F.col("_vlo"), F.col("_vhi")
    value = {
        "lower": lo,
        "higher": hi,
        "nearest": F.when(frac >= 0.5, hi).otherwise(lo),
        "linear": lo + frac * (hi - lo),
        "midpoint": (lo + hi) / 2.0,
        "disc": lo,
    }[method]
    return picked.select(*by, F.col("_name").alias("column"), "q", value.alias("value"))


#: Bits of a key read by one pass; columns whose moments are taken in one aggregate; rows sorted at once.
DIGIT_BITS, MOMENT_COLUMNS, CHUNK = 16, 16, 65_536
#: Accuracy of the sketches of ``method="approx"``.
SKETCH = 10_000


def _positions(q: float, n: int, method: str) -> tuple[float, int, int]:
    """(h, lower index, upper index) of a quantile among n sorted values."""
    h = float(max(math.ceil(q * n) - 1, 0)) if method == "disc" else q * (n - 1)
    return h, math.floor(h), math.ceil(h)


def _between(h: float, lo: float, hi: float, method: str) -> float:
    frac = h - math.floor(h)
    return {"lower": lo, "disc": lo, "higher": hi, "nearest": hi if frac >= 0.5 else lo,
            "linear": lo + frac * (hi - lo), "midpoint": (lo + hi) / 2.0}[method]


def narrow(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``cols`` as doubles x0, x1, ... (NaN is null, -0.0 is 0.0), written once for the passes that follow."""
    from searchrank.sources.io import materialize
    v = [F.col(c).cast("double") for c in cols]
    return materialize(df.select(*[F.when(~F.isnan(x), x + F.lit(0.0)).alias(f"x{i}") for i, x in enumerate(v)]),
                       "numeric-columns")


def moments(rows: DataFrame, n_cols: int) -> tuple[int, list[dict]]:
    """(rows, per column of ``narrow``: count, mean, std, min, max), a few columns to an aggregate.

    Wider aggregates would leave generated code; each one reads only its columns.
    """
    fns = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    total, out = 0, []
    for at in range(0, max(n_cols, 1), MOMENT_COLUMNS):
        some = range(at, min(at + MOMENT_COLUMNS, n_cols))
        one = rows.agg(F.count(F.lit(1)).alias("rows"),
                       *[fn(f"x{i}").alias(f"{name}{i}") for i in some for name, fn in fns.items()]).first()
        total = one["rows"]
        out += [{name: one[f"{name}{i}"] for name in fns} for i in some]
    return total, out


def _ordered_keys(x: np.ndarray) -> np.ndarray:
    """Doubles -> unsigned integers in the same order."""
    bits = x.view(np.uint64)
    top = np.uint64(1) << np.uint64(63)
    return np.where(bits & top, ~bits, bits | top)


def _double_of(key: int) -> float:
    bits = key ^ (1 << 63) if key >> 63 else ~key & (1 << 64) - 1
    return float(np.array([bits], dtype=np.uint64).view(np.float64)[0])


def _histogram(rows: DataFrame, groups: list[tuple[int, int]], shift: int) -> DataFrame:
    """(g, digit, n, lo, hi): of the keys of group g = (column, leading bits), counts and extremes per next digit.

    A table of fixed size: 2 ** ``DIGIT_BITS`` rows a group at most, summed in
    the tasks first.  Extremes are signed, in the order of the keys.
    """
    cols = sorted({c for c, _ in groups})
    mask, top = np.uint64((1 << DIGIT_BITS) - 1), np.uint64(1) << np.uint64(63)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            out = []
            t = pa.Table.from_batches(held)
            keys = {c: _ordered_keys(t.column(f"x{c}").drop_null().to_numpy().astype(np.float64)) for c in cols}
            for g, (c, lead) in enumerate(groups):
                k = keys[c]
                if shift + DIGIT_BITS < 64:
                    k = k[k >> np.uint64(shift + DIGIT_BITS) == np.uint64(lead)]
                k = np.sort(k)
                digit = ((k >> np.uint64(shift)) & mask).astype(np.int32)
                at = np.flatnonzero(np.diff(digit, prepend=-1))
                ends = np.append(at[1:], len(k)).astype(np.int64)
                out.append((np.full(len(at), g, np.int32), digit[at], ends - at, (k[at] ^ top).view(np.int64),
                            (k[ends - 1] ^ top).view(np.int64)) if len(at) else None)
            got = [x for x in out if x is not None]
            parts = [np.concatenate(x) for x in zip(*got)] if got else [np.zeros(0, d) for d in "iilll"]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in parts], names=["g", "digit", "n", "lo", "hi"])

        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= CHUNK:
                yield table(held)
                held = []
        if held:
            yield table(held)

    parts = rows.select(*[f"x{c}" for c in cols]).mapInArrow(run, "g int, digit int, n bigint, lo bigint, hi bigint")
    return parts.groupBy("g", "digit").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def select_positions(rows: DataFrame, wanted: Sequence[tuple[int, int]]) -> dict[tuple[int, int], float]:
    """{(column, position): value}: the values at 0-based positions of the sorted columns of ``narrow``.

    Doubles are read as order-preserving 64-bit keys, ``DIGIT_BITS`` from the
    top at a time: a pass counts the keys under each prefix still in question by their
    next digit, for all columns and positions at once, and the cumulated
    counts tell the digit that holds each position.  After four passes at most
    (one, where a bucket holds a single value) every key is known.  Nothing is
    sorted across tasks, listed or exploded; a pass returns one row per
    position.
    """
    spark = rows.sparkSession
    at = {s: (0, s[1]) for s in wanted}          # leading bits, position among the keys that have them
    out: dict[tuple[int, int], float] = {}
    for shift in range(64 - DIGIT_BITS, -1, -DIGIT_BITS):
        todo = [s for s in at if s not in out]
        if not todo:
            break
        groups = sorted({(s[0], at[s][0]) for s in todo})
        index = {g: i for i, g in enumerate(groups)}
        targets = spark.createDataFrame([(k, index[s[0], at[s][0]], at[s][1]) for k, s in enumerate(todo)],
                                        "s int, g int, pos long")
        # a window holds the 2 ** DIGIT_BITS digits of a group at most
        upto = F.sum("n").over(Window.partitionBy("g").orderBy("digit"))
        buckets = _histogram(rows, groups, shift).withColumn("upto", upto)
        hit = buckets.join(F.broadcast(targets), "g").where(
            (F.col("upto") - F.col("n") <= F.col("pos")) & (F.col("pos") < F.col("upto")))
        for r in hit.select("s", "digit", (F.col("upto") - F.col("n")).alias("before"), "lo", "hi").collect():
            s = todo[r["s"]]
            lead, pos = at[s]
            if r["lo"] == r["hi"]:
                out[s] = _double_of(r["lo"] + (1 << 63))
            at[s] = (lead << DIGIT_BITS) | r["digit"], pos - r["before"]
    return out


def quantiles_wide(df: DataFrame, cols: Sequence[str], qs: Sequence[float], method: str = "nearest",
                   rows: DataFrame | None = None) -> tuple[dict, dict]:
    """Exact quantiles of whole columns, without sorting or listing their values.

    Returns ({column: {count, mean, std, min, max}} with the number of rows under "",
    {(column, q): value or None}); both are sized by columns times quantiles.
    ``rows`` is ``narrow(df, cols)`` if the caller has it.
    """
    cols, qs = list(cols), [float(q) for q in qs]
    rows = narrow(df, cols) if rows is None else rows
    total, each = moments(rows, len(cols))
    got = {"": total, **dict(zip(cols, each))}
    if method == "approx":
        out = {}
        for i, c in enumerate(cols):
            v = rows.agg(F.percentile_approx(f"x{i}", qs, SKETCH)).first()[0] or [None] * len(qs)
            out |= {(c, q): x for q, x in zip(qs, v)}
        return got, out
    want = {(c, q): _positions(q, got[c]["count"], method) for c in cols if got[c]["count"] for q in qs}
    place = {c: i for i, c in enumerate(cols)}
    value = select_positions(rows, sorted({(place[c], p) for (c, _), (_, *two) in want.items() for p in two}))
    out = dict.fromkeys(((c, q) for c in cols for q in qs))
    for (c, q), (h, lo, hi) in want.items():
        out[c, q] = _between(h, value[place[c], lo], value[place[c], hi], method)
    return got, out


def group_quantile(df: DataFrame, by: str | Sequence[str], cols: Sequence[str], q: float = 0.25,
                   method: str = "nearest", suffix: str = "_q") -> DataFrame:
    """One row per group: ``<col><suffix>`` = quantile ``q`` of each column."""
    by = [by] if isinstance(by, str) else list(by)
    long = quantiles_long(df, by, cols, [q], method)
    names = [f"{c}{suffix}" for c in cols]
    wide = long.groupBy(*by).pivot("column", list(cols)).agg(F.first("value"))
    return wide.select(*by, *[F.col(c).alias(n) for c, n in zip(cols, names)])


def value_counts(df: DataFrame, col: str, out: str = "count") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out))


def group_sizes(df: DataFrame, key: str = "srch_id", out: str = "size") -> DataFrame:
    """Rows per key (the query-group sizes a ranker is fed)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def distinct_count(df: DataFrame, col: str, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    if approx:
        return df.agg(F.approx_count_distinct(col, rsd).alias(f"n_distinct_{col}"))
    return df.agg(F.countDistinct(col).alias(f"n_distinct_{col}"))


def global_min_max(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias(f"min_{col}"), F.max(col).alias(f"max_{col}"))
