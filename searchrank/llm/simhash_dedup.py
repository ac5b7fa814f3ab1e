"""SimHash near-duplicate groups through a byte-position inverted index.

A 64-bit fingerprint is eight bytes.  Two fingerprints that differ in at
most ``max_bits`` bits differ in at most ``max_bits`` bytes, so they share
at least 8 - max_bits positional bytes (4 at the default).  Candidates are
pairs sharing enough positional bytes, counted; those reaching the
guaranteed minimum are verified by Hamming distance.

A postings list of one (position, byte) holds 1/256 of all fingerprints,
so tallying those lists directly would make pairs with the square of the
corpus.  The tally therefore starts from lists of three positions at
once: the 20 position triples of ``TRIPLES`` are a covering design -- any
four positions of the eight contain one of them -- so every pair with four
shared bytes meets in some list, and two unrelated fingerprints meet in
one list with probability 20 / 2^24.  In each list the shared bytes of a
pair are tallied over all eight positions, then filtered and verified.

Work per list stays bounded: distinct fingerprints only (copies never meet),
lists longer than ``BLOCK`` are dealt into block pairs over tasks, and a
task returns a spanning forest of its links, not all pairs, which keeps
every component.  Components come from ``components`` (star contractions
in the shared checkpoint folder).

Defined cases: null and empty text, and text of white space only, has
fingerprint zero and is linked like any other; fewer words than a shingle
are one shingle of all words; repeated rows and ties keep their rows;
component_id is the smallest doc_id reachable (nulls are never the
smallest unless all ids of the component are null); other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchrank.llm.common import stage, text_chunks
from searchrank.llm.components import components

SHINGLE, MAX_BITS, SEED = 4, 4, 42
#: Longest list (distinct fingerprints) one task compares at a time.
BLOCK = 2048


def _triples() -> list[tuple[int, int, int]]:
    """20 triples of 0..7 such that any four positions contain one of them.

    Eight positions fall into three classes (3, 3, 2).  A triple is taken if
    it lies in one class, or has two of one class and one of the next one;
    four positions always hold such a triple.
    """
    cls = [0, 0, 0, 1, 1, 1, 2, 2]
    out = []
    for t in combinations(range(8), 3):
        n = [sum(cls[i] == c for i in t) for c in range(3)]
        if 3 in n or any(n[c] == 2 and n[(c + 1) % 3] == 1 for c in range(3)):
            out.append(t)
    return out


TRIPLES = _triples()


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of lower-cased (A-Z) word shingles, repeats counted."""
    w = text.lower().split()  # bytes: ASCII case and ASCII white space only
    if not w:
        return 0
    joined = b" ".join(w)
    k = min(shingle, len(w))
    size = np.fromiter(map(len, w), dtype=np.int64, count=len(w))
    end = np.cumsum(size + 1) - 1
    start = end - size
    one = xxhash.xxh64_intdigest
    h = np.fromiter((one(joined[a:b], seed) for a, b in zip(start[:len(w) - k + 1].tolist(), end[k - 1:].tolist())),
                    dtype=np.uint64, count=len(w) - k + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 8192):
        part = h[at:at + 8192].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(h))
    return int(bits.view(">u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, text) -> (doc_id, fp): fp is the signed 64-bit fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_chunks(batches):
            fp = [fingerprint(t.encode(), shingle) if t else 0 for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array(fp, dtype=np.uint64).view(np.int64))], names=[key, "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).cast("string")).mapInArrow(run, f"`{key}` {kind}, fp bigint")


def _forest(x: np.ndarray, y: np.ndarray | None, max_bits: int) -> Iterator[tuple[int, int]]:
    """Links within ``x`` (``y`` None) or between ``x`` and ``y`` that join parts not yet joined."""
    nodes = x if y is None else np.concatenate((x, y))
    part = np.arange(len(nodes))
    need = 8 - max_bits
    for i in range(len(x)):
        to = np.arange(i + 1, len(x)) if y is None else np.arange(len(x), len(nodes))
        to = to[part[to] != part[i]]
        diff = nodes[to] ^ nodes[i]
        shared = (diff.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)  # tally of positional bytes
        to, diff = to[shared >= need], diff[shared >= need]
        for j in to[np.bitwise_count(diff.view(np.uint64)) <= max_bits].tolist():
            if part[i] != part[j]:
                part[part == part[j]] = part[i]
                yield int(nodes[i]), int(nodes[j])


def _links(rows: DataFrame, max_bits: int) -> DataFrame:
    """(k, i, j, side, fp) -> links (a, b); the rows of one (k, i, j) stand together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(run_rows: list[np.ndarray]) -> list[tuple[int, int]]:
            side, fp = (np.concatenate([r[c] for r in run_rows]) for c in (3, 4))
            a, b = np.unique(fp[side == 0]), np.unique(fp[side == 1])
            return list(_forest(a, b if len(b) else None, max_bits))

        held: list[np.ndarray] = []
        for batch in batches:
            cols = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in range(5)])
            if cols.shape[1] == 0:
                continue
            edge = np.flatnonzero((cols[:3, 1:] != cols[:3, :-1]).any(axis=0)) + 1
            parts = np.split(cols, edge, axis=1)
            links: list[tuple[int, int]] = []
            for p in parts:
                if held and (held[0][:3, 0] != p[:3, 0]).any():
                    links += out(held)
                    held = []
                held.append(p)
            yield _pairs(links)
        yield _pairs(out(held) if held else [])

    return rows.mapInArrow(run, "a bigint, b bigint")


def _pairs(links: list[tuple[int, int]]) -> pa.RecordBatch:
    two = np.array(links, dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(two[:, 0]), pa.array(two[:, 1])], names=["a", "b"])


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Distinct fingerprints ``fp`` -> links (a, b) that join every pair within ``max_bits`` bits.

    Links are a spanning set: two fingerprints within the distance are
    always in one component, though their own pair may be left out.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("the position triples guarantee distances of 4 bits or fewer")

    def byte(i: int):
        return F.shiftrightunsigned("fp", 56 - 8 * i).bitwiseAND(F.lit(255))

    keys = [F.lit(n).cast("long") * (1 << 24) + byte(a) * 65536 + byte(b) * 256 + byte(c)
            for n, (a, b, c) in enumerate(TRIPLES)]
    index = fps.select("fp", F.explode(F.array(*keys)).alias("k"))
    long = stage(index.groupBy("k").agg(F.count("*").alias("n")).where("n > 1"), "lists")
    lists = index.join(long, "k").withColumn("blocks", F.ceil(F.col("n") / block).cast("long"))
    lists = lists.withColumn("own", F.pmod(F.xxhash64("fp"), "blocks"))
    # block pairs (i <= j): a row meets every block; one block, the usual case, is one pair
    rows = lists.select("k", "fp", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("o"))
    rows = rows.select("k", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"),
                       (F.col("own") > F.col("o")).cast("long").alias("side"), "fp")
    return _links(rows.repartition("k", "i", "j").sortWithinPartitions("k", "i", "j"), max_bits)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text) -> (doc_id, fp, component_id), a row per document row."""
    own = stage(fingerprints(docs, shingle), "fingerprints")
    first = stage(own.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = components(near_links(first.select("fp"), max_bits))
    rooted = first.join(roots, first["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    low = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    groups = stage(rooted.join(low, "root").select("fp", "component_id"), "groups")
    return own.join(groups, "fp").select("doc_id", "fp", "component_id")
