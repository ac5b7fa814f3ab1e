"""Ordered positions inside a group that stay correct and balanced when one
group holds a large share of all rows.

A window ``row_number() over (partition by key order by ...)`` sends every
row of a key to one task.  Here the rows are instead range-partitioned and
sorted globally on ``(key, order...)``: Spark samples the sort keys, so a
hot key is cut into several partitions by its order columns.  Each
partition then numbers its rows locally (one Arrow pass over the few
columns involved), and keys that continue across a partition boundary are
shifted by the row counts of the earlier partitions.  That correction table
has at most one row per partition, which bounds the broadcast.

The locally numbered pass is written once to the shared checkpoint folder,
so the boundary table and the final join read the same partitions.

Top-k per group (``row_number() <= k``) does not need this: rows of a group
are first limited within salted parts, so a hot group shrinks to k rows per
part before it meets in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PID = "_sr_pid"
_LOCAL = "_sr_local"
_EDGE = "_sr_edge"
_FIRST, _LAST = 1, 2


def _as_cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _differs(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Element-wise null-safe inequality (null equals null, NaN equals NaN)."""
    na, nb = (pc.is_null(x, nan_is_null=False).to_numpy(zero_copy_only=False) for x in (a, b))
    ne = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
    if pa.types.is_floating(a.type):
        ne = ne & ~(pc.fill_null(pc.is_nan(a), False).to_numpy(zero_copy_only=False)
                    & pc.fill_null(pc.is_nan(b), False).to_numpy(zero_copy_only=False))
    return (na != nb) | (~na & ~nb & ne)


def _local_running(keys: list[str], weight: str | None):
    """mapInArrow body: running count (or running sum of ``weight``) inside
    each key, in arrival order, carried over the batches of a partition.

    Columns stay Arrow columns: nothing passes through pandas, so 64-bit ids
    beside nulls keep their exact values."""

    def run(batches):
        last_key: list[pa.Array] | None = None
        last_total = 0
        for b in batches:
            n = b.num_rows
            cols = [b.column(b.schema.get_field_index(k)) for k in keys]
            new = np.zeros(n, dtype=bool)
            for c in cols:
                new[1:] |= _differs(c.slice(1), c.slice(0, max(n - 1, 0)))
            carry = 0
            if n:
                new[0] = last_key is None or any(_differs(c.slice(0, 1), k)[0] for c, k in zip(cols, last_key))
                carry = 0 if new[0] else last_total
            w = (np.ones(n, dtype=np.int64) if weight is None else
                 pc.fill_null(b.column(b.schema.get_field_index(weight)).cast(pa.int64()), 0).to_numpy())
            csum = np.cumsum(w)
            starts = np.maximum.accumulate(np.where(new, np.arange(n), 0)) if n else np.zeros(0, dtype=np.int64)
            local = csum - (csum[starts] - w[starts])
            if n:
                if carry:
                    # rows of the key carried over: before the first new key of this batch
                    local[:int(new.argmax()) if new.any() else n] += carry
                last_key, last_total = [c.slice(n - 1, 1) for c in cols], int(local[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(local, pa.int64())],
                                             names=[*b.schema.names, _LOCAL])

    return run


def _local_fill(keys: list[str], cols: list[str]):
    """mapInArrow body: per column of ``cols``, the last non-null value of the
    key so far, in arrival order, carried over the batches of a partition; the
    first and last row of the partition are marked."""

    def run(batches):
        last_key: list[pa.Array] | None = None
        last: list[pa.Array] = []
        held = None   # a batch back, so that the last row is known as such
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            by = [b.column(b.schema.get_field_index(k)) for k in keys]
            new = np.zeros(n, dtype=bool)
            for c in by:
                new[1:] |= _differs(c.slice(1), c.slice(0, n - 1))
            new[0] = last_key is None or any(_differs(c.slice(0, 1), k)[0] for c, k in zip(by, last_key))
            at = np.arange(n)
            # a key carried over starts before this batch: its rows may take the carried value
            starts = np.maximum.accumulate(np.where(new, at, -1))
            filled = []
            for i, name in enumerate(cols):
                v = b.column(b.schema.get_field_index(name))
                seen = np.maximum.accumulate(np.where(v.is_valid().to_numpy(zero_copy_only=False), at, -1))
                here = (seen >= starts) & (seen >= 0)
                take = np.where(here, seen, n)
                pool = pa.concat_arrays([v, last[i] if last else pa.nulls(1, v.type)])
                filled.append(pool.take(pa.array(take, mask=~here & (starts >= 0))))
            edge = np.zeros(n, dtype=np.int32)
            edge[0] = _FIRST if last_key is None else 0
            if held is not None:
                yield _marked(*held)
            held = b, cols, filled, edge
            last_key, last = [c.slice(n - 1, 1) for c in by], [f.slice(n - 1, 1) for f in filled]
        if held is not None:
            held[3][-1] |= _LAST
            yield _marked(*held)

    return run


def _marked(b: pa.RecordBatch, cols: list[str], filled: list[pa.Array], edge: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*b.columns, *filled, pa.array(edge)],
                                      names=[*b.schema.names, *[f"_sr_fill_{i}" for i in range(len(cols))], _EDGE])


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which null keys match null keys; the left columns stay, key copies of the right go."""
    names = {k: f"_sr_n_{i}" for i, k in enumerate(keys)}
    renamed = right.select(*[F.col(k).alias(n) for k, n in names.items()],
                           *[F.col(c) for c in right.columns if c not in names])
    cond = None
    for k, n in names.items():
        c = left[k].eqNullSafe(renamed[n])
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*names.values())


def running_within(df: DataFrame, keys: str | Sequence[str], order: Sequence,
                   out: str = "running", weight: str | None = None,
                   num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = running count (or running sum of integer ``weight``),
    inclusive, of each row inside its key under ``order``.

    With a total ``order`` and no weight this is ``row_number``.  ``keys``
    may be empty for a running total over the whole frame; null is a key
    value like any other.  Only the columns of ``df`` travel through the
    sort, so project first.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    drop_const = False
    if not keys:
        df = df.withColumn("_sr_all", F.lit(0))
        keys, drop_const = ["_sr_all"], True
    sort_cols = _as_cols(keys) + _as_cols(order)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols)
                .withColumn(_PID, F.spark_partition_id()))
    schema = T.StructType(ranged.schema.fields + [T.StructField(_LOCAL, T.LongType(), False)])
    local = ranged.mapInArrow(_local_running(keys, weight), schema)
    # The local pass is written once to the shared checkpoint folder.  The
    # partition id is then part of the data, so the boundary table and the
    # final join see exactly the same partitions (two separately planned
    # range exchanges could sample different bounds), the sort and the
    # Python pass run once, and a lost executor does not redo them.
    from searchrank.sources.io import materialize
    local = materialize(local, "running-local")

    # One row per partition: its first key, its last key and the running
    # total the last key reached in it.
    kstruct = F.struct(*[F.col(k) for k in keys])
    bounds = local.groupBy(_PID).agg(
        F.min(kstruct).alias("_first"),
        F.max(F.struct(kstruct.alias("k"), F.col(_LOCAL).alias("n"))).alias("_last"))
    bounds = bounds.select(_PID, "_first", F.col("_last.k").alias("_k"), F.col("_last.n").alias("_n"))
    # Keys are sorted, so the partitions that end with one key stand next to
    # each other: a running sum over them is what a following partition that
    # starts with this key adds.  These windows see one row per partition.
    upto = F.sum("_n").over(Window.partitionBy("_k").orderBy(_PID))
    before = Window.orderBy(_PID)
    offsets = (bounds.withColumn("_cum", upto)
               .select(_PID, "_first", F.lag("_k").over(before).alias("_pk"),
                       F.lag("_cum").over(before).alias("_off"))
               .where(F.col("_off").isNotNull() & F.col("_pk").eqNullSafe(F.col("_first")))
               .select(_PID, *[F.col(f"_first.{k}").alias(k) for k in keys], "_off"))
    # bounded by the number of partitions -> safe to broadcast
    joined = _null_safe(local, F.broadcast(offsets), [_PID, *keys], "left")
    res = (joined.withColumn(out, F.col(_LOCAL) + F.coalesce(F.col("_off"), F.lit(0)))
                 .drop(_PID, _LOCAL, "_off"))
    return res.drop("_sr_all") if drop_const else res


def row_number_within(df: DataFrame, keys: str | Sequence[str], order: Sequence,
                      out: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position of each row inside its key under ``order``.

    ``order`` is a list of column names or sort expressions (``F.desc(...)``)
    and should be a total order inside a key; rows tied on all of them get
    consecutive numbers in an unspecified order.
    """
    return running_within(df, keys, order, out=out, num_partitions=num_partitions)


def dense_rank_within(df: DataFrame, keys: str | Sequence[str], col: str,
                      descending: bool = False, out: str | None = None,
                      num_partitions: int | None = None) -> DataFrame:
    """Dense rank of ``col`` inside each key; a null value gets a null rank.

    Ranks are computed on the distinct ``(key, value)`` pairs (a partial
    aggregation collapses repeated values before the shuffle) and joined
    back on the pair.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    out = out or f"{col}_rank"
    pairs = df.select(*keys, col).where(F.col(col).isNotNull()).distinct()
    order = [F.col(col).desc()] if descending else [F.col(col).asc()]
    ranked = row_number_within(pairs, keys, order, out=out, num_partitions=num_partitions)
    return _null_safe(df, ranked, keys + [col], "left")


def top_k_within(df: DataFrame, keys: str | Sequence[str], order: Sequence, k: int,
                 out: str = "rank") -> DataFrame:
    """Rows with position <= k inside each key (plus their position).

    Two limits: within salted parts of a key, then over the k survivors of
    each part.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    # a hot key's rows are limited per salted part first: parts are dealt by
    # row, so the first window never sees more than a part of a key even
    # when the input already arrives partitioned by it
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(parts))
    cols = _as_cols(order)
    some = (df.withColumn("_sr_salt", salt)
            .withColumn(out, F.row_number().over(Window.partitionBy(*keys, "_sr_salt").orderBy(*cols)))
            .where(F.col(out) <= k).drop("_sr_salt", out))
    w = Window.partitionBy(*keys).orderBy(*cols)
    return some.withColumn(out, F.row_number().over(w)).where(F.col(out) <= k)



def fill_within(df: DataFrame, keys: str | Sequence[str], order: Sequence[str],
                cols: Sequence[str], direction: str = "forward", suffix: str = "") -> DataFrame:
    """Fill nulls of ``cols`` from the nearest earlier (``forward``) or later
    (``backward``) non-null value of the same key, rows ordered by the
    columns ``order`` ascending (W7).

    One global range sort on ``(key, order...)`` serves all ``cols``: each
    partition fills its rows in one Arrow pass, and keys that continue across
    a partition boundary take the last value of the earlier partitions from a
    table of at most one row per partition.  A hot key is cut by its order
    columns, so it is never one task.  All columns of ``df`` travel through
    the sort, so project first; rows tied on ``order`` stand in an unspecified
    order.
    """
    from searchrank.sources.io import materialize
    keys = [keys] if isinstance(keys, str) else list(keys)
    if direction not in ("forward", "backward"):
        raise ValueError("direction must be 'forward' or 'backward'")
    sort_cols = _as_cols(keys) + [F.col(c).asc() if direction == "forward" else F.col(c).desc() for c in order]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols)
                .withColumn(_PID, F.spark_partition_id()))
    fills = {c: f"_sr_fill_{i}" for i, c in enumerate(cols)}
    schema = T.StructType(ranged.schema.fields + [T.StructField(f, df.schema[c].dataType) for c, f in fills.items()]
                          + [T.StructField(_EDGE, T.IntegerType(), False)])
    # written once, as in ``running_within``
    local = materialize(ranged.mapInArrow(_local_fill(keys, list(fills)), schema), "fill-local")

    # the first and the last row of each partition
    edges = local.where(F.col(_EDGE) > 0).groupBy(_PID).agg(
        F.max(F.when(F.col(_EDGE).bitwiseAND(_FIRST) > 0, F.struct(*keys))).alias("_first"),
        F.max(F.when(F.col(_EDGE).bitwiseAND(_LAST) > 0, F.struct(*keys))).alias("_k"),
        *[F.first(F.when(F.col(_EDGE).bitwiseAND(_LAST) > 0, F.col(f)), ignorenulls=True).alias(f)
          for f in fills.values()])
    # partitions that end with one key stand next to each other: its value so
    # far is the last one any of them ends with (one row per partition here)
    upto, before = Window.partitionBy("_k").orderBy(_PID), Window.orderBy(_PID)
    known = edges.select(_PID, "_first", "_k", *[F.last(f, ignorenulls=True).over(upto).alias(f)
                                                 for f in fills.values()])
    carried = (known.select(_PID, "_first", F.lag("_k").over(before).alias("_pk"),
                            *[F.lag(f).over(before).alias(f"{f}_c") for f in fills.values()])
               .where(F.col("_pk").isNotNull() & F.col("_pk").eqNullSafe(F.col("_first")))
               .select(_PID, *[F.col(f"_first.{k}").alias(k) for k in keys], *[f"{f}_c" for f in fills.values()]))
    # bounded by the number of partitions -> safe to broadcast
    out = _null_safe(local, F.broadcast(carried), [_PID, *keys], "left")
    for c, f in fills.items():
        out = out.withColumn(f"{c}{suffix}", F.coalesce(F.col(c), F.col(f), F.col(f"{f}_c")))
    return out.drop(_PID, _EDGE, *fills.values(), *[f"{f}_c" for f in fills.values()])
