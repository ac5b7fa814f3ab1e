"""Train/validation splits and samples keyed by search.

All splits are pure row filters on a deterministic function of the key,
so they need no shuffle, push down to the scan where possible, and give
the same rows again when a task is re-run after an executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mod_split(df: DataFrame, key: str = "srch_id", modulus: int = 10,
              holdout: int = 1) -> tuple[DataFrame, DataFrame]:
    """(train, valid): valid rows have ``key % modulus == holdout``."""
    m = F.col(key) % modulus
    return df.where(m != holdout), df.where(m == holdout)


def _below(key: str, seed: int, fraction: float):
    """True for keys whose hash lies in the lowest ``fraction`` of the 63-bit range."""
    h = F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(seed)), 1)
    return h < F.lit(min(int(fraction * 2 ** 63), 2 ** 63 - 1))


def hash_split(df: DataFrame, key: str = "srch_id", test_fraction: float = 0.2,
               seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a seeded hash of the key: a whole search lands on one side."""
    test = _below(key, seed, test_fraction)
    return df.where(~test), df.where(test)


def sample(df: DataFrame, fraction: float, seed: int = 0, key: str | None = None) -> DataFrame:
    """Random sample of rows, or of whole keys when ``key`` is given.

    The keyed form is reproducible across re-runs (hash of key and seed).
    """
    if key is None:
        return df.sample(fraction=fraction, seed=seed)
    return df.where(_below(key, seed, fraction))
