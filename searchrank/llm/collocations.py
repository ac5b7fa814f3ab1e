"""Phrase collocation mining by top-order marginalisation.

Every word starts one window, padded where its piece of text ends.  Only these
longest windows are counted; ``ROLLUP`` over their columns then sums the counts
of all shorter prefixes, so a phrase of any order is counted from the same
rows and no order is exploded on its own.

* A window only has to be as long as its prefixes can still be frequent.  Two
  sketches tell that, counted in hashed buckets: of words and word pairs, then
  of longer phrases all of whose pairs the first one leaves open.  A bucket
  under ``min_count`` proves its phrases infrequent, and windows stop there;
  infrequent words only add to the total.  A full bucket proves nothing and
  keeps its rows, so the result is exact at any sketch size.  A sketch has a
  bucket for some eight words or more, and never more than 2^27, one bit each
  (16 MB) when it is shared: far beyond that corpus size it prunes less.
* Tasks sum equal windows in bounded buffers before the shuffle, and the
  rollup sums partially before it deals its groups, so a very common word or
  phrase arrives as one row per task.
* Phrases reach their parts by joins on the counted phrases; scores are
  computed in decimals, which are exact beyond 64 bits.
* The first phrases of a language are taken of salted parts first.

Defined cases: null and empty texts have no words; a null lang reads as
``und``; words of any length are kept whole; phrases of equal score and count
rank by their UTF-8 bytes; repeated documents count again; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchrank.llm.common import stage, text_chunks

MIN_COUNT = 30
LONGEST = 4
#: A longer phrase with this share (in hundredths) of a phrase's count covers it.
COVERED = 80
TOP, SALTS = 2000, 64
SCALE = 2_000_000
#: log2 of the sketch's buckets, at least and at most.
LEAST_BITS, MOST_BITS = 12, 27
#: Buckets sent together.
CHUNK = 1 << 16
#: Tokens a task holds before it sums and hands on; words it remembers ids of.
HELD, KNOWN = 300_000, 100_000
# Bytes of UTF-8: the marks at which a piece ends become full stops, the tabulator a space.
_TABLE = bytes.maketrans(b",;:!?\n\x0b\x0c\r\t", b"......... ")


class _Words(dict):
    """Numbers of the words met so far; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class _Reader:
    """Turns texts of one language into word numbers."""

    def __init__(self, lang: str):
        self.lang, self.seed = lang, xxhash.xxh64_intdigest(lang.encode())
        self.reset()

    def reset(self) -> None:
        self.known = _Words({b".": 0})
        self.held = array("i")

    def read(self, text: str) -> None:
        # bytes.lower() changes A-Z only; what is white space then is a space
        tokens = text.encode().lower().translate(_TABLE).replace(b".", b" . ").split()
        self.held.extend(map(self.known.__getitem__, tokens))
        self.held.append(0)

    def full(self) -> bool:
        return len(self.held) >= HELD or len(self.known) >= KNOWN

    def words(self) -> list[str]:
        return ["", *(w.decode() for w in list(self.known)[1:])]

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """The numbers held so far, and the hash of each word number."""
        ids = np.frombuffer(self.held, dtype=np.int32)
        self.held = array("i")
        digest, seed = xxhash.xxh64_intdigest, self.seed
        hashes = np.fromiter((digest(w, seed) for w in self.known), dtype=np.uint64, count=len(self.known))
        return ids, hashes


def _grams(ids: np.ndarray, hashes: np.ndarray, longest: int) -> Iterator[np.ndarray]:
    """Hashes of the phrases of 1, 2, ... words that start at each place (of anything beyond a piece's end)."""
    word = hashes[ids]
    mix, gram = np.uint64(0x9E3779B97F4A7C15), word
    for k in range(1, longest + 1):
        gram = (gram ^ (gram >> np.uint64(31))) * mix
        yield gram
        ahead = np.roll(word, -k)
        gram = gram ^ ((ahead >> np.uint64(29)) | (ahead << np.uint64(35)))


class _Sketches:
    """The bit arrays so far, by the longest phrase each was counted for."""

    def __init__(self, bits: int):
        self.bits = bits
        self.known: list[tuple[int, np.ndarray]] = []

    def bucket(self, gram: np.ndarray) -> np.ndarray:
        return (gram >> np.uint64(64 - self.bits)).astype(np.int64)

    def open(self, ids: np.ndarray, hashes: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For phrases of 1, 2, ... words: which places start one that may be frequent, and all buckets.

        Orders beyond the sketches are open where both their parts are.
        """
        last = None
        for k, gram in enumerate(_grams(ids, hashes, longest), 1):
            may = ids > 0 if last is None else last & np.append(last[1:], False)
            bucket = self.bucket(gram)
            full = next((f for most, f in self.known if k <= most), None)
            if full is not None:
                at = bucket[may]
                may[may] = (full[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            yield may, bucket
            last = may


def _readers(batches: Iterator[pa.RecordBatch]) -> Iterator[_Reader]:
    """Read (lang, text) batches; hand over a reader whenever it is full, and each at the end."""
    by: dict[str, _Reader] = {}
    for b in text_chunks(batches, 64):
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            r = by.get(lang)
            if r is None:
                r = by[lang] = _Reader(lang)
            if text:
                r.read(text)
                if r.full():
                    yield r
                    r.reset()
        if len(by) > 64:  # many languages: do not hold a buffer for each
            for r in by.values():
                if len(r.held):
                    yield r
            by.clear()
    for r in by.values():
        if len(r.held):
            yield r


def _sketch(texts: DataFrame, sketches: _Sketches, least: int, most: int, min_count: int) -> np.ndarray:
    """A bit per bucket (low bits first): phrases of ``least`` to ``most`` words in it may be frequent.

    A task counts in one array of a byte a bucket (255 stands for more) and sends
    it in compressed chunks; chunks of one place are added up as they stream by.
    """
    shared = texts.sparkSession.sparkContext.broadcast(sketches)
    size = 1 << sketches.bits
    chunk = min(CHUNK, size)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, dtype=np.uint8)
        for r in _readers(batches):
            orders = list(shared.value.open(*r.take(), most))[least - 1:]
            bucket, n = np.unique(np.concatenate([b[may] for may, b in orders]), return_counts=True)
            seen[bucket] = np.minimum(seen[bucket] + n, 255)
        for k in range(size // chunk):
            part = seen[k * chunk:(k + 1) * chunk]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)])],
                                                 names=["chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, np.zeros(chunk, dtype=np.int64)

        def full() -> pa.RecordBatch:
            bits = np.packbits(total >= min_count, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([bits])], names=["chunk", "bits"])

        for b in batches:
            for i in range(b.num_rows):
                k = b.column(0)[i].as_py()
                if at is not None and k != at:
                    yield full()
                    total[:] = 0
                at = k
                total += np.frombuffer(zlib.decompress(b.column(1)[i].as_py()), dtype=np.uint8)
        if at is not None:
            yield full()

    parts = texts.mapInArrow(count, "chunk int, counts binary")
    whole = parts.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(add, "chunk int, bits binary")
    may = np.zeros(size // 8, dtype=np.uint8)
    for r in whole.toLocalIterator():  # the bits, chunk by chunk
        may[r["chunk"] * chunk // 8:(r["chunk"] + 1) * chunk // 8] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    return may


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST,
                  bits: int | None = None) -> DataFrame:
    """(lang, text) -> (lang, phrase, k, f): all phrases of up to ``longest`` words with f >= min_count, and (lang, null, 0, total).

    ``bits`` fixes the sketch's size (log2); by default it follows the number of characters.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.col("text").cast("string").alias("text"))
    if bits is None:
        chars = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        bits = min(MOST_BITS, max(LEAST_BITS, int(chars // 48).bit_length()))
    sketches = _Sketches(bits)
    for least, most in ((1, min(2, longest)), (3, longest)):
        if least <= most:
            sketches.known.append((most, _sketch(texts, sketches, least, most, min_count)))
    shared = texts.sparkSession.sparkContext.broadcast(sketches)
    columns = [f"w{k + 1}" for k in range(longest)]

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _readers(batches):
            ids, hashes = r.take()
            word = ids > 0
            # a window's k-th word, as long as its first k words may be frequent; 0 pads
            cols = [np.where(may, np.roll(ids, -k), 0)[word]
                    for k, (may, _) in enumerate(shared.value.open(ids, hashes, longest))]
            counted = pa.table(dict(zip(columns, map(pa.array, cols)))).group_by(columns).aggregate([([], "count_all")])
            names = pa.array(r.words(), pa.string())
            parts = [names.take(counted.column(c).combine_chunks()) for c in columns]
            n = counted.column("count_all").combine_chunks()
            for at in range(0, len(n), 50_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r.lang] * len(n.slice(at, 50_000)), pa.string()),
                     *[p.slice(at, 50_000) for p in parts], n.slice(at, 50_000).cast(pa.int64())],
                    names=["lang", *columns, "n"])

    rows = texts.mapInArrow(windows, "lang string, " + ", ".join(f"{c} string" for c in columns) + ", n bigint")
    # equal windows first, so that the rollup multiplies distinct ones only
    rows = rows.groupBy("lang", *columns).agg(F.sum("n").alias("n"))
    # grouping_id: the columns a prefix leaves out
    sums = rows.rollup("lang", *columns).agg(F.sum("n").alias("f"), F.grouping_id().alias("g"))
    k = F.lit(longest) - F.bit_count("g")
    sums = sums.withColumn("k", k).where("k >= 0")  # without the total over all languages
    last = F.get(F.array(F.lit("-"), *columns), F.col("k").cast("int"))  # the prefix's last word: padding is empty
    kept = sums.where((F.col("k") == 0) | ((F.col("f") >= min_count) & (last != "")))
    # columns left out are null, which concat_ws passes over
    phrase = F.when(F.col("k") > 0, F.concat_ws(" ", *columns))
    return kept.select("lang", phrase.alias("phrase"), F.col("k").cast("int").alias("k"), F.col("f").cast("long").alias("f"))


def _parts(words: Column, at: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, at, size), " ")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, covered: int = COVERED,
                 top: int = TOP, bits: int | None = None) -> DataFrame:
    """(lang, text) -> lang, rank, phrase, a, l, r, n, score: the best phrases of each language.

    The score of a phrase of count ``a`` is the lowest of floor(2000000 a / (l + r))
    over its cuts into a first part of count l and a rest of count r (the
    earliest such cut).  Phrases that a longer one covers are left out.
    """
    counts = stage(phrase_counts(docs, min_count, longest, bits), "phrase-counts")
    phrases = counts.where("k >= 1").select("lang", "phrase", "f")
    cand = counts.where("k >= 2").select("lang", "phrase", "k", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = cand.select("lang", "phrase", "k", "a", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", _parts(F.col("w"), F.lit(1), F.col("cut")).alias("first"),
                       _parts(F.col("w"), F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    wide = "decimal(20,0)"
    score = F.expr(f"CAST({SCALE} AS decimal(7,0)) * CAST(a AS {wide}) div (CAST(l AS {wide}) + CAST(r AS {wide}))")
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("low")
    scored = cuts.groupBy("lang", "phrase", "a").agg(lowest)
    # every proper part of two words or more of each candidate
    sizes = F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size")
    inner = cand.where("k >= 3").select("lang", "k", "a", "w", sizes)
    inner = inner.select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("at"))
    inner = inner.groupBy("lang", _parts(F.col("w"), F.col("at"), F.col("size")).alias("phrase")).agg(
        F.max("a").alias("longer"))
    free = scored.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer").cast(wide) < F.lit(covered) * F.col("a").cast(wide)))
    order = [F.col("low.score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    first = free.withColumn("_n", F.row_number().over(salted)).where(F.col("_n") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(
        F.col("rank") <= top)
    totals = counts.where("k = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("low.l").alias("l"),
        F.col("low.r").alias("r"), "n", F.col("low.score").alias("score"))
