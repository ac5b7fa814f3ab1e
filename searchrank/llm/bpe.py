"""Byte-level BPE encoding and decoding with forced boundaries.

A merge can only join two bytes that stand side by side inside some token
of the vocabulary.  A byte pair found inside no token therefore marks a
certain cut: no token of any encoding crosses it.  Texts are cut at such
pairs, each distinct fragment is encoded once per task by the tokenizer,
and the ids are concatenated.

The tokenizer also splits text by a pattern before merging, so a cut has
to leave that split as it is.  A cut is used only where (a) the left byte
is no white space and no part of a multi-byte one (white-space runs look
ahead), (b) no apostrophe stands within three bytes (contractions are
matched from their apostrophe), and (c) the right byte starts a character.
Added tokens take part in the pair table, so their strings stay whole.

Fragment caches are per task and bounded (``CACHE`` entries).  The
vocabulary file is a parameter read where the task runs; it is never part
of the repository.

Defined cases: null text is empty (no ids, decodes to empty); null ids
decode to empty; repeated rows keep their rows; texts of any length are
encoded whole; other columns are kept by ``encode``/``decode`` as they are
(a clashing ``ids`` or ``decoded`` column is replaced); an empty table
gives no rows.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from searchrank.llm.common import text_chunks

#: Distinct fragments kept per task before the cache starts afresh.
CACHE = 400_000


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _token_bytes(path: str) -> tuple[dict[int, bytes], list[bytes]]:
    """Bytes per id, and every token's bytes (added tokens included)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    by_id = {i: bytes(byte_of[c] for c in t) for t, i in spec["model"]["vocab"].items()
             if all(c in byte_of for c in t)}
    by_id |= {a["id"]: a["content"].encode() for a in spec.get("added_tokens", ())}
    return by_id, list(by_id.values())


@lru_cache(maxsize=2)
def forced_cuts(path: str) -> np.ndarray:
    """256 x 256 booleans: no token holds byte ``a`` followed by byte ``b``."""
    never = np.ones((256, 256), dtype=bool)
    for t in _token_bytes(path)[1]:
        a = np.frombuffer(t, dtype=np.uint8)
        never[a[:-1], a[1:]] = False
    # a cut has to start a character, and leave white space and contractions alone
    never[:, 0x80:0xC0] = False
    spaces = [*range(0x09, 0x0E), 0x1C, 0x1D, 0x1E, 0x1F, 0x20]
    never[spaces, :] = False
    # last bytes of the white-space characters beyond ASCII (U+0085, U+00A0, U+1680, U+2000.., U+3000)
    never[[0x80 + i for i in range(11)] + [0x85, 0xA0, 0xA8, 0xA9, 0xAF, 0x9F], :] = False
    return never


def cut_points(data: np.ndarray, never: np.ndarray) -> np.ndarray:
    """Byte offsets of the cuts of a text (0 and the end included)."""
    if len(data) == 0:
        return np.zeros(1, dtype=np.int64)
    cut = never[data[:-1], data[1:]]
    for at in np.flatnonzero(data == 0x27):
        cut[max(0, at - 4):at + 4] = False
    return np.concatenate(([0], np.flatnonzero(cut) + 1, [len(data)]))


class Encoder:
    """Encodes texts fragment by fragment; one per task."""

    def __init__(self, path: str):
        # Spark's tasks are the parallelism; the library's own threads would only contend
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.never = forced_cuts(path)
        self.known: dict[bytes, bytes] = {}  # fragment -> its ids as 32-bit integers

    def arrays(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; fragments new to this task are encoded together."""
        cut = []
        for t in texts:
            data = (t or "").encode()
            at = cut_points(np.frombuffer(data, dtype=np.uint8), self.never).tolist()
            cut.append([data[i:j] for i, j in zip(at, at[1:])])
        known = self.known
        if len(known) > CACHE:
            known.clear()
        new = list(set().union(*cut).difference(known))
        for k in range(0, len(new), 4096):
            some = new[k:k + 4096]
            got = self.tokenizer.encode_batch_fast([p.decode() for p in some], add_special_tokens=False)
            known.update((p, np.array(g.ids, dtype=np.int32).tobytes()) for p, g in zip(some, got))
        return [np.frombuffer(b"".join(map(known.__getitem__, parts)), dtype=np.int32) for parts in cut]

    def __call__(self, text: str) -> list[int]:
        return self.arrays([text])[0].tolist()


def _with_schema(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != name] + [T.StructField(name, kind)])


def _with(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return _with_schema(df.schema, name, kind)


def _put(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    keep = [i for i, n in enumerate(batch.schema.names) if n != name]
    return pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [values],
                                      names=[batch.schema.names[i] for i in keep] + [name])


def _encoded(texts: list[str | None], enc: Encoder) -> pa.ListArray:
    got = enc.arrays(texts)
    off = np.cumsum([0, *map(len, got)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate([np.zeros(0, dtype=np.int32), *got])))


def _decoded(ids: pa.Array, piece: np.ndarray) -> pa.Array:
    out = []
    for v in ids:
        out.append(b"".join(piece[v.values.to_numpy()].tolist()).decode("utf-8", "replace") if v.is_valid else "")
    return pa.array(out, type=pa.string())


def _pieces(path: str) -> np.ndarray:
    by_id = _token_bytes(path)[0]
    return np.array([by_id.get(i, b"") for i in range(max(by_id) + 1)], dtype=object)


def encode(df: DataFrame, text: str = "text", path: str | None = None, ids: str = "ids") -> DataFrame:
    """Add ``ids`` (array<int>): the tokenizer's ids of the whole text."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(path)
        for b in text_chunks(batches):
            yield _put(b, ids, _encoded(b.column(text).to_pylist(), enc))

    return df.mapInArrow(run, _with(df, ids, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, ids: str = "ids", path: str | None = None, decoded: str = "decoded") -> DataFrame:
    """Add ``decoded``: the text of ``ids``, as the tokenizer decodes with special tokens kept."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = _pieces(path)
        for b in text_chunks(batches):
            yield _put(b, decoded, _decoded(b.column(ids), piece))

    return df.mapInArrow(run, _with(df, decoded, T.StringType()))


def round_trip(df: DataFrame, text: str = "text", path: str | None = None, ids: str = "ids",
               decoded: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass (one Python worker per task instead of two)."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, piece = Encoder(path), _pieces(path)
        for b in text_chunks(batches):
            got = _encoded(b.column(text).to_pylist(), enc)
            yield _put(_put(b, ids, got), decoded, _decoded(got, piece))

    return df.mapInArrow(run, _with_schema(_with(df, ids, T.ArrayType(T.IntegerType())), decoded, T.StringType()))
