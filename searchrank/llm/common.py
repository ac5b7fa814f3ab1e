"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchrank.sources.io import materialize

#: A side is broadcast only when its measured rows stay under this bound.
BROADCAST_ROWS = 1_000_000
#: ... and its measured text under this one.
BROADCAST_BYTES = 64_000_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def az_lower(c: Column) -> Column:
    """Lower-case A-Z only; ``lower`` is the quick equal for all-ASCII texts."""
    ascii_only = F.octet_length(c) == F.char_length(c)
    return F.when(ascii_only, F.lower(c)).otherwise(F.translate(c, _UPPER, _UPPER.lower()))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write under the shared checkpoint folder and read back (cuts lineage)."""
    return materialize(df, f"llm-{name}")


def broadcast_if_small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` when its measured ``rows`` are within ``limit``; else leave the join to AQE."""
    return F.broadcast(df) if rows <= limit else df


def text_chunks(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into small ones, so that a task holds few long texts at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
