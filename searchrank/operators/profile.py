"""Data profiling: missingness, describe, histograms, box statistics,
correlations and key overlap between two sets.

Each profile is one (or a few) aggregate passes whose output is sized by
the number of columns, bins or pairs -- never by rows.  Column lists that
decide the shape of an output (which columns have nulls) come from a
one-row aggregate; everything else stays lazy.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations, combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchrank.functions.clean import numeric_columns

# Box whiskers reach 1.5 IQR; default histogram bin count.
WHISKER = 1.5
DEFAULT_BINS = 50


def _stack(pairs: Sequence[tuple[str, Column]], name: str = "column", value: str = "value",
           src: DataFrame | None = None) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(n).alias(name), c.alias(value)) for n, c in pairs]))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None, only_missing: bool = True
                ) -> DataFrame:
    """(column, null_count), columns with nulls only by default."""
    cols = list(cols or df.columns)
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = agg.select(_stack([(c, F.col(c)) for c in cols], value="null_count").alias("_kv")) \
              .select("_kv.column", "_kv.null_count")
    return long.where(F.col("null_count") > 0) if only_missing else long


def completeness(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, non_null, rows, share) -- the completeness bar."""
    cols = list(cols or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(c) for c in cols])
    long = agg.select("_rows", _stack([(c, F.col(c)) for c in cols], value="non_null").alias("_kv")) \
              .select("_kv.column", "_kv.non_null", F.col("_rows").alias("rows"))
    return long.withColumn("share", F.col("non_null") / F.col("rows"))


def row_completeness(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(non_null_columns, rows): distribution of filled columns per row."""
    cols = list(cols or df.columns)
    filled = sum((F.col(c).isNotNull().cast("int") for c in cols), F.lit(0))
    return df.select(filled.alias("non_null_columns")).groupBy("non_null_columns") \
             .agg(F.count(F.lit(1)).alias("rows"))


def describe(df: DataFrame, cols: Sequence[str] | None = None, method: str = "nearest"
             ) -> DataFrame:
    """Per column: count, null_count, mean, std, min, q25, q50, q75, max.

    The numeric columns are written once.  A few aggregates give counts and
    moments, and the quartiles of all columns come from digit histograms
    (``stats.quantiles_wide``): no value list, sort or explode of rows.
    """
    from searchrank.operators.stats import quantiles_wide
    cols = list(cols or numeric_columns(df))
    qs = [0.25, 0.5, 0.75]
    got, quart = quantiles_wide(df, cols, qs, method)
    rows = [(c, got[c]["count"], got[""] - got[c]["count"], got[c]["mean"], got[c]["std"], got[c]["min"],
             *(quart[c, q] for q in qs), got[c]["max"]) for c in cols]
    # one row per column of the schema
    return df.sparkSession.createDataFrame(
        rows, "column string, count long, null_count long, mean double, std double, min double, q25 double, "
              "q50 double, q75 double, max double")


def histogram(df: DataFrame, col: str, bins: int = DEFAULT_BINS,
              range_: tuple[float, float] | None = None) -> DataFrame:
    """Equal-width histogram with every bin present: (bin, bin_lo, bin_hi, count) (A10).

    Nulls are dropped; with ``range_`` values outside it are dropped, else
    the range is the data's min/max (widened by 0.5 each way when flat).
    Bin i holds edge[i] <= x < edge[i+1], the last bin also x == hi, with
    edge[i] = lo + i * ((hi - lo) / bins).
    """
    x = F.col(col).cast("double")
    vals = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    if range_ is not None:
        lo_v, hi_v = float(range_[0]), float(range_[1])
        vals = vals.where((F.col("x") >= lo_v) & (F.col("x") <= hi_v))
        bounds = vals.sparkSession.range(1).select(F.lit(lo_v).alias("lo"), F.lit(hi_v).alias("hi"))
    else:
        mm = vals.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).where(F.col("lo").isNotNull())
        bounds = mm.select(F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5)
                            .otherwise(F.col("lo")).alias("lo"),
                           F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5)
                            .otherwise(F.col("hi")).alias("hi"))

    def edge(i, lo, hi):
        return i.cast("double") * ((hi - lo) / bins) + lo

    # the bounds enter the row pass as scalar subqueries (one row)
    lo_s, hi_s = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    i0 = F.least(F.floor((F.col("x") - lo_s) * (F.lit(float(bins)) / (hi_s - lo_s))).cast("int"),
                 F.lit(bins - 1))
    j = vals.withColumn("_i", i0)
    j = j.withColumn("_i", F.when(F.col("x") < edge(F.col("_i"), lo_s, hi_s), F.col("_i") - 1)
                            .when((F.col("x") >= edge(F.col("_i") + 1, lo_s, hi_s)) &
                                  (F.col("_i") != bins - 1), F.col("_i") + 1)
                            .otherwise(F.col("_i")))
    counts = j.groupBy("_i").agg(F.count(F.lit(1)).alias("count"))
    allb = bounds.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = allb.join(counts, allb["bin"] == counts["_i"], "left")
    lo, hi = F.col("lo"), F.col("hi")
    hi_edge = F.when(F.col("bin") == bins - 1, hi).otherwise(edge(F.col("bin") + 1, lo, hi))
    return out.select(F.col("bin"), edge(F.col("bin"), lo, hi).alias("bin_lo"),
                      hi_edge.alias("bin_hi"), F.coalesce(F.col("count"), F.lit(0)).alias("count"))


def box_stats(df: DataFrame, col: str, whisker: float = WHISKER) -> DataFrame:
    """One row: n, mean, q1, median, q3, iqr, whislo, whishi, fliers.

    Quartiles are linearly interpolated; whiskers reach the last value
    inside q1 - w*IQR / q3 + w*IQR; values beyond the whiskers are fliers.
    Quartiles come from digit histograms of the column, written once; a
    last pass reads the whiskers and counts the fliers.
    """
    from searchrank.operators.stats import narrow, quantiles_wide
    vals = narrow(df, [col])
    got, quart = quantiles_wide(df, [col], [0.25, 0.5, 0.75], "linear", vals)
    q1v, medv, q3v = (quart[col, q] for q in (0.25, 0.5, 0.75))
    if q1v is None:
        return df.sparkSession.createDataFrame(
            [], "n long, mean double, q1 double, median double, q3 double, iqr double, "
                "whislo double, whishi double, n_fliers_low long, n_fliers_high long")
    iqrv = q3v - q1v
    v = F.col("x0")
    lo_fence, hi_fence = q1v - whisker * iqrv, q3v + whisker * iqrv
    # whiskers are the last values inside the fences, so what lies beyond a fence lies beyond its whisker
    lit = F.lit
    return vals.agg(
        lit(got[col]["count"]).cast("long").alias("n"), lit(got[col]["mean"]).alias("mean"),
        lit(q1v).alias("q1"), lit(medv).alias("median"), lit(q3v).alias("q3"), lit(iqrv).alias("iqr"),
        F.coalesce(F.min(F.when(v >= lo_fence, v)), lit(q1v)).alias("whislo"),
        F.coalesce(F.max(F.when(v <= hi_fence, v)), lit(q3v)).alias("whishi"),
        F.count_if(v < lo_fence).alias("n_fliers_low"), F.count_if(v > hi_fence).alias("n_fliers_high"))


#: Rows multiplied at once.
GRAM_ROWS = 16_384


class _Gram:
    """Joint counts, means, products and squares of all column pairs over their common rows, and of null flags.

    A fixed-size sum: four matrices over the numeric columns and one over the
    flags, whatever the number of rows.  Parts are merged by their
    means, so that large values with a small spread keep their digits.
    """

    def __init__(self, n_cols: int, n_flags: int):
        z = [np.zeros((n_cols, n_cols)) for _ in range(5)]
        self.n, self.mean, self.prod, self.sq = z[0], z[1], z[2], z[3]   # mean[a, b]: of a where b is known
        self.flags, self.rows = np.zeros((n_flags, n_flags)), 0

    def add(self, x: np.ndarray, flags: np.ndarray) -> None:
        known = ~np.isnan(x)
        m = known.astype(np.float64)
        some = np.maximum(m.sum(axis=0), 1)
        centre = np.where(known, x, 0.0).sum(axis=0) / some
        d = np.where(known, x - centre, 0.0)
        n, first = m.T @ m, d.T @ m
        with np.errstate(invalid="ignore", divide="ignore"):
            off = np.where(n > 0, first / n, 0.0)
        self._merge(n, centre[:, None] * (n > 0) + off, d.T @ d - n * off * off.T, (d * d).T @ m - n * off * off)
        f = flags.astype(np.float64)
        self.flags += f.T @ f
        self.rows += len(x)

    def _merge(self, n, mean, prod, sq) -> None:
        total = self.n + n
        step = mean - self.mean
        with np.errstate(invalid="ignore", divide="ignore"):
            share = np.where(total > 0, n / total, 0.0)
        both = self.n * share
        self.prod += prod + step * step.T * both
        self.sq += sq + step * step * both
        self.mean += step * share
        self.n = total


def gram(df: DataFrame, cols: Sequence[str] = (), flags: Sequence[str] = ()) -> DataFrame:
    """(kind, i, j, n, mean, prod, sq) from one scan, for all pairs of ``cols`` and of null flags of ``flags``.

    kind "pair": n common rows of columns i and j, the mean of i and its squared
    deviations ``sq`` over them, and the products of deviations ``prod``.  kind
    "null": n rows where flags i and j are both null.  kind "rows": the row
    count.  Every task sends one row per pair; merging them is a grouping.
    """
    from searchrank.sources.io import materialize
    cols, flags = list(cols), list(flags)
    words = [flags[i:i + 32] for i in range(0, len(flags), 32)]
    masks = [sum((F.when(F.col(c).isNull(), F.lit(1 << k)).otherwise(F.lit(0)).cast("long")
                  for k, c in enumerate(w)), F.lit(0).cast("long")).alias(f"w{i}") for i, w in enumerate(words)]
    p, q = len(cols), len(flags)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = _Gram(p, q)
        for b in batches:
            for at in range(0, b.num_rows, GRAM_ROWS):
                some = b.slice(at, GRAM_ROWS)
                x = np.stack([some.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(p)],
                             axis=1) if p else np.zeros((some.num_rows, 0))
                bits = [(some.column(p + 1 + k // 32).to_numpy() >> (k % 32)) & 1 for k in range(q)]
                g.add(x, np.stack(bits, axis=1) if q else np.zeros((some.num_rows, 0)))
        i, j = (v.ravel() for v in np.indices((p, p)))
        k, m = (v.ravel() for v in np.indices((q, q)))
        # an empty part has no means to offer
        have, both = g.n.ravel() > 0, g.flags.ravel() > 0
        zero = np.zeros(int(both.sum()) + 1)
        yield pa.RecordBatch.from_pydict({
            "kind": pa.array(["pair"] * int(have.sum()) + ["null"] * int(both.sum()) + ["rows"], pa.string()),
            "i": pa.array(np.concatenate((i[have], k[both], [0])).astype(np.int32)),
            "j": pa.array(np.concatenate((j[have], m[both], [0])).astype(np.int32)),
            "n": pa.array(np.concatenate((g.n.ravel()[have], g.flags.ravel()[both], [g.rows])).astype(np.int64)),
            **{name: pa.array(np.concatenate((v.ravel()[have], zero)))
               for name, v in (("mean", g.mean), ("prod", g.prod), ("sq", g.sq))},
            "mean_j": pa.array(np.concatenate((g.mean.T.ravel()[have], zero)))})

    narrow = df.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"x{k}")
                         for k, c in enumerate(cols)], F.lit(0).cast("byte").alias("_one"), *masks)
    parts = materialize(narrow.mapInArrow(
        run, "kind string, i int, j int, n bigint, mean double, prod double, sq double, mean_j double"), "gram")
    n = F.col("n")
    whole = parts.groupBy("kind", "i", "j").agg(
        F.sum(n).alias("_n"), (F.sum(n * F.col("mean")) / F.sum(n)).alias("_mi"),
        (F.sum(n * F.col("mean_j")) / F.sum(n)).alias("_mj"))
    di, dj = F.col("mean") - F.col("_mi"), F.col("mean_j") - F.col("_mj")
    return parts.join(whole, ["kind", "i", "j"]).groupBy("kind", "i", "j").agg(
        F.sum(n).alias("n"), F.first("_mi").alias("mean"), F.sum(F.col("prod") + n * di * dj).alias("prod"),
        F.sum(F.col("sq") + n * di * di).alias("sq"))


def _corr_rows(g: dict, cols: Sequence[str]) -> list[tuple]:
    out = []
    for (i, a), (j, b) in combinations_with_replacement(list(enumerate(cols)), 2):
        ab, ba = g.get(("pair", i, j)), g.get(("pair", j, i))
        corr = None
        if ab is not None and ab["n"] > 1:
            # no spread beyond the rounding of the values: no correlation
            if all(v["sq"] > v["n"] * (1e-13 * v["mean"]) ** 2 for v in (ab, ba)):
                corr = ab["prod"] / (ab["sq"] ** 0.5 * ba["sq"] ** 0.5)
        out.append((a, b, corr))
    return out


def _null_rows(g: dict, cols: Sequence[str]) -> list[tuple]:
    rows = g["rows", 0, 0]["n"] if ("rows", 0, 0) in g else 0
    alone = {i: g["null", i, i]["n"] for i in range(len(cols)) if ("null", i, i) in g}
    some = [i for i in sorted(alone) if 0 < alone[i] < rows]
    out = []
    for i, j in combinations(some, 2):
        both = g["null", i, j]["n"] if ("null", i, j) in g else 0
        na, nb = alone[i], alone[j]
        out.append((cols[i], cols[j], (rows * both - na * nb) / ((na * (rows - na)) ** 0.5 * (nb * (rows - nb)) ** 0.5)))
    return out


def correlations(df: DataFrame, cols: Sequence[str] = (), flags: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(correlation of ``cols``, null correlation of ``flags``) from one scan of ``df``."""
    # sized by the pairs of columns
    g = {(r["kind"], r["i"], r["j"]): r for r in gram(df, cols, flags).collect()}
    kind = "col_a string, col_b string, corr double"
    return (df.sparkSession.createDataFrame(_corr_rows(g, list(cols)), kind),
            df.sparkSession.createDataFrame(_null_rows(g, list(flags)), kind))


def correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation, pairwise-complete, long form (col_a <= col_b).

    Each pair uses only the rows where both values are present.  A column
    without variance on those rows correlates as null (no division by 0).
    """
    return correlations(df, cols)[0]


def null_correlation(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Correlation of null indicators between columns that are partly null.

    The null flags of a row are packed into 32-bit words; joint counts are one
    matrix product per batch.  Columns never or always null have no variance
    and are left out.  Pairs col_a < col_b in input order.
    """
    return correlations(df, (), list(cols or df.columns))[1]


def all_null(df: DataFrame, cols: Sequence[str]) -> Column:
    """True where every listed column is null."""
    return F.coalesce(*[F.col(c) for c in cols]).isNull()


def competitor_coverage(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """One row (U5): hotels, hotels never shown without competitor data
    (no all-null row -- the set difference as computed originally), and
    hotels with competitor data on at least one row."""
    flag = df.select(key, all_null(df, cols).alias("_empty"))
    per = flag.groupBy(key).agg(F.max(F.col("_empty").cast("int")).alias("_any_empty"),
                                F.min(F.col("_empty").cast("int")).alias("_all_empty"))
    return per.agg(F.count(F.lit(1)).alias("n_hotels"),
                   F.count_if(F.col("_any_empty") == 0).alias("n_always_covered"),
                   F.count_if(F.col("_all_empty") == 0).alias("n_ever_covered"))


def key_overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row comparing the distinct keys of two sets.

    n_a, n_b, n_both (intersection), n_union, n_a_only, n_b_only, and the
    rows of each set whose key is absent from the other (count and share).
    """
    # one count table per side, one full join; rows are sums over its counts.
    # A null key is in neither intersection, as in a join on the key.
    ka = a.groupBy(key).agg(F.count(F.lit(1)).alias("_a"))
    kb = b.groupBy(key).agg(F.count(F.lit(1)).alias("_b"))
    keys = ka.join(kb, key, "full")
    na, nb = F.col("_a"), F.col("_b")
    zero = F.lit(0).cast("long")

    def rows(n, where=None):
        return F.coalesce(F.sum(n if where is None else F.when(where, n)), zero)

    out = keys.agg(
        F.count_if(na.isNotNull()).alias("n_a"), F.count_if(nb.isNotNull()).alias("n_b"),
        F.count_if(na.isNotNull() & nb.isNotNull()).alias("n_both"), F.count(F.lit(1)).alias("n_union"),
        F.count_if(nb.isNull()).alias("n_a_only"), F.count_if(na.isNull()).alias("n_b_only"),
        rows(na).alias("rows_a"), rows(na, nb.isNull()).alias("rows_a_only"),
        rows(nb).alias("rows_b"), rows(nb, na.isNull()).alias("rows_b_only"))
    return out.withColumn("share_a_only", F.col("rows_a_only") / F.col("rows_a")) \
              .withColumn("share_b_only", F.col("rows_b_only") / F.col("rows_b"))


#: log2 of the keys a sketch keeps; its relative error is about 1 / 2 ** (LG_KEYS / 2).
LG_KEYS = 14


def key_overlap_approx(a: DataFrame, b: DataFrame, key: str, lg: int = LG_KEYS) -> DataFrame:
    """``key_overlap``'s key counts from theta sketches, with the largest error to expect.

    One row: n_a, n_b, n_both, n_union, n_a_only, n_b_only and ``error``, four
    standard errors as a number of keys (0 while a sketch holds every key of the union).
    A sketch keeps 2 ** ``lg`` hashed keys at most and merges, so any number of rows
    and days costs one partial aggregate each; sketches saved per day can be joined
    later without reading the rows again.  Null keys count on no side.
    """
    sa = a.agg(F.theta_sketch_agg(F.col(key), F.lit(lg)).alias("a"))
    sb = b.agg(F.theta_sketch_agg(F.col(key), F.lit(lg)).alias("b"))
    two = sa.select("a", sb.select("b").scalar().alias("b"))
    n = F.theta_sketch_estimate
    union = n(F.theta_union("a", "b"))
    got = two.select(
        n("a").alias("n_a"), n("b").alias("n_b"), n(F.theta_intersection("a", "b")).alias("n_both"),
        union.alias("n_union"), n(F.theta_difference("a", "b")).alias("n_a_only"),
        n(F.theta_difference("b", "a")).alias("n_b_only"))
    # of every count: its error is one of the union's sample
    room = F.lit(float(2 ** lg))
    return got.withColumn("error", F.when(F.col("n_union") < room / 2, 0.0).otherwise(4.0 * F.col("n_union") / F.sqrt(room)))
