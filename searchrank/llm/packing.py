"""Vector best-fit packing of token sequences.

A sequence (bin) has three capacities: tokens, documents, and attention cost
(a piece of n tokens costs n * n, as attention stays inside a piece).  Pieces
go in from the longest down; each goes to the open sequence that fits it best
under every constraint: the one with the smallest weighted dot product of the
piece with what is left (``dot``), or the smallest weighted norm of what is left
after it (``norm``).  Weights are the total demand of a resource over its
capacity, so the scarce one counts most.

* What a piece asks for depends on its length alone, so pieces of one length
  are interchangeable and so are sequences with the same rests.  The whole
  corpus therefore enters the plan as a histogram of at most ``tokens``
  lengths, and the plan fills thousands of equal sequences in one step.  The
  driver's part does not grow with the corpus; every piece takes part in the
  one packing, with no packing by partition.
* Each task numbers its pieces within a length as it writes them; offsets per
  (task, length) turn that into a rank without sorting or gathering a length.
  The plan's slots, which say where the pieces of each rank go, are a table
  bounded by the same histogram.
* Only documents longer than a sequence are cut: all pieces but the first are
  full, so a document adds one piece that has to find company.

Ids are those of the tokenizer's vocabulary file, whose merges are read as
ranks (``Ids``); the library's tests compare them with the tokenizer itself.

Defined cases: null and empty texts give the end token alone, one piece;
repeated rows and repeated doc_ids are documents of their own; a null doc_id is
kept; texts of any length are encoded whole; an empty table gives no rows; other
columns are ignored.  Capacities that not even one token fits raise ValueError.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from searchrank.llm.bpe import _token_bytes, vocabulary_path
from searchrank.llm.common import stage, text_chunks

TOKENS = 1024
END_ID = 2
RULES = ("dot", "norm")


@lru_cache(maxsize=2)
def _encoding(path: str):
    import json

    import public_tokenizers
    import tiktoken
    by_id = _token_bytes(path)[0]
    with open(path, encoding="utf-8") as f:
        added = {a["content"]: a["id"] for a in json.load(f).get("added_tokens", ())}
    ranks = {b: i for i, b in by_id.items() if i not in added.values()}
    return tiktoken.Encoding("corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)


class Ids:
    """The ids of whole texts, added tokens included."""

    def __init__(self, path: str):
        self.encoding = _encoding(path)

    def __call__(self, text: str | None) -> np.ndarray:
        return self.encoding.encode_to_numpy(text or "", allowed_special="all").astype("<u4")


def longest_piece(tokens: int, cost: int | None) -> int:
    """Tokens of the longest piece that an empty sequence takes."""
    return tokens if cost is None else min(tokens, math.isqrt(cost))


def pieces_of(docs: DataFrame, tokens: int = TOKENS, cost: int | None = None, end_id: int = END_ID,
              path: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, text) -> doc_id, piece, start, length, ids_crc32, [ids,] task, nth.

    ``nth`` numbers a task's pieces of one length; with ``task`` it names a piece.
    """
    path, most = path or vocabulary_path(), longest_piece(tokens, cost)
    if most < 1:
        raise ValueError("no piece fits these capacities")
    doc_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = Ids(path), TaskContext.get().partitionId()
        seen = np.zeros(most + 1, dtype=np.int64)
        for b in text_chunks(batches):
            row, piece, start, length, crc, nth, ids = [], [], [], [], [], [], []
            for r, text in enumerate(b.column(1).to_pylist()):
                got = np.append(encode(text), np.uint32(end_id)).astype("<u4")
                first = (len(got) - 1) % most + 1
                ends = range(first, len(got) + 1, most)
                for k, end in enumerate(ends):
                    at = 0 if k == 0 else end - most
                    row.append(r)
                    piece.append(k)
                    start.append(at)
                    length.append(end - at)
                    crc.append(zlib.crc32(got[at:end].tobytes()))
                    nth.append(int(seen[end - at]))
                    seen[end - at] += 1
                    if with_ids:
                        ids.append(got[at:end].astype(np.int32))
            out = {"doc_id": b.column(0).take(pa.array(row, pa.int32())), "piece": pa.array(piece, pa.int32()),
                   "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
                   "ids_crc32": pa.array(crc, pa.int64()),
                   "task": pa.array([task] * len(row), pa.int32()), "nth": pa.array(nth, pa.int64())}
            if with_ids:
                out["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(out)

    schema = f"doc_id {doc_type}, piece int, start bigint, length bigint, ids_crc32 bigint, task int, nth bigint"
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, schema + (", ids array<int>" if with_ids else ""))


class Plan:
    """Which sequence and place the pieces of each length and rank get."""

    def __init__(self, counts: dict[int, int], tokens: int = TOKENS, documents: int | None = None,
                 cost: int | None = None, rule: str = "dot"):
        room = np.array([tokens, documents or tokens, cost or tokens * tokens], dtype=np.float64)
        lengths = np.array(sorted(counts, reverse=True), dtype=np.int64)
        ask = np.stack([lengths, np.ones(len(lengths)), lengths * lengths], axis=1).astype(np.float64)
        many = np.array([counts[n] for n in lengths.tolist()], dtype=np.float64)
        demand = (ask * many[:, None]).sum(axis=0) / room if len(lengths) else np.ones(3)
        weight = demand / demand.max()
        # groups of equal sequences: what is left of each capacity, how many, and their pieces as (length, first rank)
        left, size = np.zeros((64, 3)), np.zeros(64, dtype=np.int64)
        held: list[list[tuple[int, int]]] = []

        def add(rest: np.ndarray, n: int, pieces: list[tuple[int, int]]) -> None:
            nonlocal left, size
            at = len(held)
            if at == len(size):
                left, size = np.concatenate((left, np.zeros_like(left))), np.concatenate((size, np.zeros_like(size)))
            left[at], size[at] = rest, n
            held.append(pieces)

        for length, a in zip(lengths.tolist(), ask):
            rank, todo = 0, counts[length]
            while todo:
                rest = left[:len(held)]
                fits = np.flatnonzero((size[:len(held)] > 0) & (rest >= a).all(axis=1))
                if len(fits):
                    if rule == "dot":
                        badness = ((rest[fits] / room) * (a / room) * weight).sum(axis=1)
                    else:
                        badness = ((((rest[fits] - a) / room) ** 2) * weight).sum(axis=1)
                    g = int(fits[np.argmin(badness)])
                    have, pieces, free = int(size[g]), held[g], left[g].copy()
                else:
                    g, have, pieces, free = -1, todo, [], room
                # a piece makes its sequence fit the next one of its length best, until that is full
                each = int((free // a).min())
                n = min(have, todo // each)
                if n == 0:
                    n, each = 1, todo
                if g >= 0:
                    if n < have:  # the others stay as they are
                        add(free, have - n, [(k, r + n) for k, r in pieces])
                    size[g] = 0
                add(free - each * a, n, pieces + [(length, rank + j * n) for j in range(each)])
                rank, todo = rank + n * each, todo - n * each
        self.sequences = int(size[:len(held)].sum())
        slots: dict[int, list[tuple[int, int, int]]] = {}
        base = 0
        for g, pieces in enumerate(held):
            if not size[g]:
                continue
            at = 0
            for length, rank in pieces:
                slots.setdefault(length, []).append((rank, base, at))
                at += length
            base += int(size[g])
        #: length -> (first ranks, first sequences, offsets), by rank
        self.slots = {n: tuple(np.array(sorted(s), dtype=np.int64).T) for n, s in slots.items()}

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence numbers and offsets of pieces."""
        seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for n in np.unique(length).tolist():
            here = np.flatnonzero(length == n)
            first, base, at = self.slots[n]
            k = np.searchsorted(first, rank[here], side="right") - 1
            seq[here], off[here] = base[k] + rank[here] - first[k], at[k]
        return seq, off


def best_plan(counts: dict[int, int], tokens: int = TOKENS, documents: int | None = None,
              cost: int | None = None) -> Plan:
    """The plan with the fewest sequences over ``RULES``."""
    return min((Plan(counts, tokens, documents, cost, rule) for rule in RULES), key=lambda p: p.sequences)


def pack(docs: DataFrame, tokens: int = TOKENS, documents: int | None = None, cost: int | None = None,
         end_id: int = END_ID, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, text) -> one row per piece: doc_id, piece, start, length, ids_crc32, [ids,] sequence_id, offset.

    Without ``documents`` or ``cost`` these stay at what a sequence of
    ``tokens`` can reach (one token a document; one piece over its whole
    length), so that they do not bind.  Sequence numbers run from 0 without gaps.
    """
    pieces = stage(pieces_of(docs, tokens, cost, end_id, path, with_ids), "packing-pieces")
    by_task = stage(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "packing-counts")
    # at most ``tokens`` rows
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = best_plan(counts, tokens, documents, cost)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    keep = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])
    ranked = pieces.join(offsets, ["task", "length"]).select(*keep, (F.col("before") + F.col("nth")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(b.schema.names.index(c)).to_numpy() for c in ("length", "rank"))
            seq, off = plan.place(length, rank)
            yield pa.RecordBatch.from_arrays(
                b.columns[:-1] + [pa.array(seq), pa.array(off)], names=[*keep, "sequence_id", "offset"])

    schema = ", ".join(f"{c} {ranked.schema[c].dataType.simpleString()}" for c in keep)
    return ranked.mapInArrow(run, schema + ", sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """``pack(..., with_ids=True)`` -> sequence_id, ids, starts (the offset of each piece), doc_ids."""
    got = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("p"))
    return got.select("sequence_id", F.flatten(F.col("p.ids")).alias("ids"), F.col("p.offset").alias("starts"),
                      F.col("p.doc_id").alias("doc_ids"))
