"""Benchmark decontamination by winnowing (DataFrame functions only).

Words are runs outside ASCII punctuation, A-Z lower-cased.  On both sides
every run of ``GRAM`` words is hashed, and each window of ``WINDOW``
consecutive hashes keeps its (leftmost) minimum.  A shared span of
``GRAM + WINDOW - 1`` = 10 words is exactly one such window, so document and
item keep the same fingerprint at the same place in it: joining the kept
fingerprints finds every shared span of 10 words.  A hit is then extended
word by word to both sides and counts if 10 or more words agree, so hash
collisions never pass.  Items of fewer words are one window of their own
length, looked up at every position of the documents (only for lengths
that occur).

The lookups of documents are narrow rows (ids, place, hash).  The
benchmark's fingerprints are broadcast to them when their measured rows are at
most ``BROADCAST_ROWS`` and their words at most ``BROADCAST_BYTES``; above that
the lookups are shuffled and AQE splits hot ones.  Only documents with a
matching lookup are cut into words a second time, for the extension.

Defined cases: null or empty text has no words (n_words 0, not
contaminated); an item without words has no window; repeated document rows
each get their row; rows are told apart by doc_id and text, null doc_id
included; an item with null id has windows that hit, but is not listed in
``items``; repeated item ids are listed once; an empty benchmark leaves
every document clean; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchrank.llm.common import BROADCAST_BYTES, BROADCAST_ROWS, az_lower, stage

GRAM, WINDOW = 5, 6
SPAN = GRAM + WINDOW - 1
# Fixed value: the word pattern of the contract.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(az_lower(text), F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _tokens(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``w`` (words) and ``h`` (a hash per word)."""
    return df.withColumn("w", words(F.col(text))).withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))


def _winnow(df: DataFrame) -> DataFrame:
    """Add ``g`` (hash of each gram) and ``m`` (minimum of each window of grams)."""
    gram = F.when(F.array_size("h") >= SPAN, F.transform(
        F.sequence(F.lit(0), F.array_size("h") - GRAM),
        lambda i: F.xxhash64(*[F.get(F.col("h"), i + j) for j in range(GRAM)])))
    df = df.withColumn("g", gram)
    return df.withColumn("m", F.transform(
        F.sequence(F.lit(0), F.array_size("g") - WINDOW),
        lambda i: F.least(*[F.get(F.col("g"), i + j) for j in range(WINDOW)])))


def _gram_at(i: Column, m: Column) -> Column:
    """Where in window ``i`` the (leftmost) minimum ``m`` stands."""
    at = F.coalesce(*[F.when(F.get(F.col("g"), i + j) == m, F.lit(j)) for j in range(WINDOW)])
    return i + at


def _around(w: str, at: Column) -> tuple[Column, Column]:
    """Up to WINDOW - 1 words on both sides of the gram, and where the gram starts in them."""
    left = F.least(at, F.lit(WINDOW - 1))
    return F.slice(F.col(w), at - left + 1, left + GRAM + WINDOW - 1), left


def _short_hashes(df: DataFrame, n: int) -> Column:
    """Hash of the ``n`` words at every position."""
    return F.when(F.array_size("h") >= n, F.transform(
        F.sequence(F.lit(0), F.array_size("h") - n),
        lambda i: F.xxhash64(*[F.get(F.col("h"), i + j) for j in range(n)])))


def benchmark_fingerprints(items: DataFrame) -> DataFrame:
    """(item_id, text) -> fp, item_id, len, ctx, at: one row per kept fingerprint.

    ``len`` is 0 for winnowed grams and the word count for short items;
    ``ctx`` holds the words around the gram, ``at`` the gram's place in it.
    """
    t = _tokens(items.select("item_id", "text"))
    long = _winnow(t.where(F.array_size("w") >= SPAN)).select("item_id", "w", "g", F.posexplode(F.coalesce("m", F.array().cast("array<bigint>"))).alias("i", "fp"))
    long = long.withColumn("p", _gram_at(F.col("i"), F.col("fp")))
    ctx, at = _around("w", F.col("p"))
    parts = long.select("fp", "item_id", F.lit(0).alias("len"), ctx.alias("ctx"), at.alias("at")).distinct()
    for n in range(1, SPAN):
        one = t.where(F.array_size("w") == n)
        parts = parts.union(one.select(F.get(_short_hashes(one, n), F.lit(0)).alias("fp"), "item_id",
                                       F.lit(n).alias("len"), F.col("w").alias("ctx"), F.lit(0).alias("at")))
    return parts


def _windows(docs: DataFrame, lens: list[int]) -> DataFrame:
    """Narrow rows (doc_id, tk, n_words, len, i, fp): all lookups of a document, and one bare row (len -1).

    ``len`` 0: window i's kept hash; n: the hash of the n words from i on.
    """
    none = F.array().cast("array<bigint>")
    t = _winnow(_tokens(docs))
    lists = [("m", 0, SPAN)] + [(f"s{n}", n, n) for n in lens]
    for name, n, _ in lists[1:]:
        t = t.withColumn(name, _short_hashes(t, n))
    # the word count is taken first, so that the word list is not copied to every row; the exploded
    # expression is no bare column, for which Spark would add a size filter that computes it twice
    t = t.withColumn("n_words", F.array_size("w").cast("long"))
    t = t.select("doc_id", "tk", "n_words", F.posexplode(F.concat(
        F.array(F.lit(0).cast("long")), *[F.coalesce(name, none) for name, *_ in lists])).alias("at", "fp"))
    which, i, start = F.lit(-1), F.lit(-1), F.lit(1).cast("long")
    for _, n, least in lists:  # the lists stand one after another; their sizes follow from n_words
        which = F.when(F.col("at") >= start, F.lit(n)).otherwise(which)
        i = F.when(F.col("at") >= start, F.col("at") - start).otherwise(i)
        start = start + F.greatest(F.col("n_words") - least + 1, F.lit(0))
    return t.select("doc_id", "tk", "n_words", which.alias("len"), i.cast("int").alias("i"), "fp")


def _agreement(h: Column) -> Column:
    """A lookup with its gram's place ``p`` and, word by word around it, whether both texts agree."""
    p = F.when(h["len"] == 0, _gram_at(h["i"], h["fp"])).otherwise(h["i"])
    return F.struct(p.alias("p"), h["len"].alias("len"), h["ctx"].alias("ctx"), h["at"].alias("at"),
                    h["item_id"].alias("item_id"))


def _equal_words(h: Column) -> Column:
    """Of a long lookup: from WINDOW - 1 words before the gram to as many after it; of a short one: its words."""
    first = F.when(h["len"] == 0, F.lit(1 - WINDOW)).otherwise(0)
    last = F.when(h["len"] == 0, F.lit(GRAM + WINDOW - 2)).otherwise(h["len"] - 1)
    eq = F.transform(F.sequence(first, last), lambda k: F.coalesce(
        (h["p"] + k >= 0) & (h["at"] + k >= 0)
        & (F.get(F.col("w"), F.greatest(h["p"] + k, F.lit(0))) == F.get(h["ctx"], F.greatest(h["at"] + k, F.lit(0)))),
        F.lit(False)))
    return F.struct(h["p"].alias("p"), h["len"].alias("len"), eq.alias("eq"), h["item_id"].alias("item_id"))


def _span(h: Column) -> Column:
    """The (s, e) word range a lookup hits after extension, null if too few words agree."""
    side = WINDOW - 1

    def run_of(eq: Column) -> Column:
        """Leading words that agree."""
        stop = F.array_position(eq, False)
        return F.when(stop == 0, F.array_size(eq)).otherwise(stop.cast("int") - 1)

    left = run_of(F.reverse(F.slice(h["eq"], 1, side)))
    right = run_of(F.slice(h["eq"], side + GRAM + 1, side))
    gram = ~F.array_contains(F.slice(h["eq"], side + 1, GRAM), False)
    long = F.when(gram & (left + right + GRAM >= SPAN),
                  F.struct((h["p"] - left).alias("s"), (h["p"] + GRAM + right).alias("e")))
    short = F.when(~F.array_contains(h["eq"], False),
                   F.struct(h["p"].alias("s"), (h["p"] + h["len"]).alias("e")))
    return F.struct(F.when(h["len"] == 0, long).otherwise(short).alias("span"), h["item_id"].alias("item_id"))


def _covered(spans: Column) -> Column:
    """Words under the union of sorted (s, e) spans."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(spans, zero, lambda a, x: F.struct(
        F.greatest(a["end"], x["e"]).alias("end"),
        (a["n"] + F.greatest(x["e"] - F.greatest(a["end"], x["s"]), F.lit(0))).alias("n")), lambda a: a["n"])


def find_contamination(docs: DataFrame, items: DataFrame, broadcast_rows: int = BROADCAST_ROWS,
                       broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, text) against (item_id, text) -> a row per document row.

    Columns: doc_id, n_words, spans (sorted (s, e) word ranges that hit),
    n_hit (words under them), items (ids with occurring windows, sorted as
    strings), contaminated, tk (a hash of the text: with doc_id it tells
    rows apart).
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("tk", F.xxhash64("text"))
    fps = stage(benchmark_fingerprints(items), "benchmark")
    # at most 10 rows; a word may be as long as a paragraph, so the words' bytes are measured too
    size = F.octet_length(F.array_join("ctx", " ")).cast("long")
    by_len = {r["len"]: (r["n"], r["bytes"] or 0) for r in fps.groupBy("len").agg(
        F.count("*").alias("n"), F.sum(size).alias("bytes")).collect()}
    rows = _windows(docs, sorted(n for n in by_len if n))
    if sum(n for n, _ in by_len.values()) <= broadcast_rows and sum(b for _, b in by_len.values()) <= broadcast_bytes:
        # one pass: bare rows and matches leave the same broadcast join
        met = rows.join(F.broadcast(fps), ["fp", "len"], "left").where("len = -1 or ctx is not null")
    else:
        met = rows.where("len >= 0").join(fps, ["fp", "len"]).unionByName(
            rows.where("len = -1"), allowMissingColumns=True)
    met = stage(met, "lookups")
    # only documents with a lookup are read and cut into words again
    asked = met.where("len >= 0").groupBy(F.col("doc_id").alias("_d"), F.col("tk").alias("_k")).agg(
        F.collect_set(F.struct("len", "i", "fp", "ctx", "at", "item_id")).alias("asked"))
    found = docs.join(asked, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tk") == F.col("_k")))
    found = _winnow(_tokens(found)).withColumn("asked", F.transform("asked", _agreement))
    found = found.withColumn("asked", F.transform("asked", _equal_words))
    found = found.select("doc_id", "tk", F.explode(F.filter(
        F.transform("asked", _span), lambda x: x["span"].isNotNull())).alias("x"))
    found = found.groupBy("doc_id", "tk").agg(
        F.sort_array(F.collect_set("x.span")).alias("spans"),
        F.sort_array(F.collect_set(F.col("x.item_id").cast("string"))).alias("items"))
    found = found.select(F.col("doc_id").alias("_d"), F.col("tk").alias("_k"), "spans", "items",
                         _covered(F.col("spans")).alias("hit"))
    all_rows = met.where("len = -1").select("doc_id", "tk", "n_words")
    got = all_rows.join(found, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tk") == F.col("_k")), "left")
    n_hit = F.coalesce("hit", F.lit(0).cast("long"))
    return got.select("doc_id", "n_words", F.coalesce("spans", F.array().cast(found.schema["spans"].dataType)).alias("spans"),
                      n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      (n_hit > 0).alias("contaminated"), "tk")
