"""Spelling variants: words one edit apart, found with a bit-sliced position index.

The index holds, for each (position, letter), a bitset over the words that
have that letter there.  A query word is read letter by letter while two sets
advance side by side, each step working on whole machine words of members:
``exact``, the members that agree so far, and ``once``, those one edit away.
Members as long as the query spend their edit on a replaced letter; members
one letter longer spend it on an inserted one, from when on they are read one
position further.

* A vocabulary-wide index would cost the square of the vocabulary.  One edit
  leaves one half of the shorter word untouched, so words first meet under
  (length, intact half) and the index of a group spans the other half only.
  A group over ``BLOCK`` members is cut again: the edit lies in one half of
  what is left, and the other half joins the key.  After the last cut one
  letter is open, so a group has no more members than the alphabet allows:
  no group is dealt whole to one task because it is hot, and none is capped.
* A pair belongs to the part where its first difference stands, so every pair
  is found in exactly one group and nothing needs a ``distinct``.
* Corpus words are counted per task in a bounded dictionary before the shuffle.

Defined cases: null and empty texts have no words; a null doc_id reads as
an empty one; words of any length and alphabet are compared whole; ties for
the form go to the smallest word in code-point order; repeated documents
count again; repeated rows of a word in ``spelling_variants`` add up; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchrank.llm.common import stage, text_chunks

MIN_CHARS, MIN_COUNT = 7, 2
#: How many times as frequent as a word its form has to be.
RATIO = 10
#: Members of a group before it is cut again.
BLOCK = 4096
#: Words a task counts before it hands its counts on.
HELD = 300_000
_LETTERS = "A-Za-zÀ-ÿ"


def corpus_words(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
                 misspell: int | None = None) -> DataFrame:
    """(doc_id, text) -> (word, n): maximal runs of letters, A-Z lower-cased, with their counts.

    ``misspell`` plants errors to be found: with h the CRC-32 of
    ``<doc_id>:<run>``, runs whose h it divides lose their code point h % length.
    """
    runs = re.compile(f"[{_LETTERS}]{{{min_chars},}}")  # shorter runs make no word

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                             names=["word", "n"])
            held.clear()
            return got

        for b in text_chunks(batches):
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not text:
                    continue
                seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                # bytes.lower() changes A-Z only
                for word, n in Counter(runs.findall(text.encode().lower().decode())).items():
                    if misspell:
                        h = zlib.crc32(word.encode(), seed)
                        if h % misspell == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < min_chars:
                                continue
                    held[word] += n
                if len(held) > HELD:
                    yield out()
        yield out()

    parts = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string")).mapInArrow(
        count, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _halves(rows: DataFrame) -> DataFrame:
    """Each row twice: the edit in the first or in the second half of ``seg``; the other half joins the key.

    ``longer`` (0 or 1) tells the members that may have the inserted letter.
    """
    open_len = F.char_length("seg") - F.col("longer")  # of the shorter word
    half = F.floor(open_len / 2).cast("int")
    kept = open_len - half

    def part(pre: Column, seg: Column, post: Column) -> Column:
        return F.struct(pre.alias("pre"), seg.alias("seg"), post.alias("post"))

    size = F.char_length("seg")
    second = part(F.concat("pre", F.substring("seg", F.lit(1), half)),
                  F.substring("seg", half + 1, size), F.col("post"))
    first = part(F.col("pre"), F.substring("seg", F.lit(1), size - kept),
                 F.concat(F.substring("seg", size - kept + 1, kept), F.col("post")))
    return rows.select("length", "longer", "n", F.explode(F.array(first, second)).alias("p")).select(
        "length", "p.pre", "p.post", "longer", "p.seg", "n")


_KEY = ["length", "pre", "post"]


def _groups(words: DataFrame, block: int) -> DataFrame:
    """(length, pre, post, longer, seg, n): every word in the groups where its near words meet."""
    size = F.char_length("word")
    # as the shorter word of a pair (or one as long), and as the longer one
    rows = words.select(F.explode(F.sequence(F.lit(0), F.lit(1))).alias("longer"), "word", "n").select(
        (size - F.col("longer")).alias("length"), "longer", F.lit("").alias("pre"), F.col("word").alias("seg"),
        F.lit("").alias("post"), "n").where("length > 0")
    rows = _halves(rows)
    done: DataFrame | None = None
    while True:
        left = F.col("length") - F.char_length("pre") - F.char_length("post")
        hot = stage(rows.groupBy(*_KEY).agg(F.count("*").alias("m")).where((F.col("m") > block) & (left > 1)).select(*_KEY),
                    "variant-hot")
        if hot.isEmpty():
            return rows if done is None else done.unionByName(rows)
        cold = rows.join(hot, _KEY, "left_anti").select(rows.columns)
        done = cold if done is None else done.unionByName(cold)
        rows = stage(_halves(rows.join(hot, _KEY, "left_semi")), "variant-rows")


def near_members(segs: list[str], n_short: int, last: bool) -> Iterator[tuple[int, int]]:
    """Pairs (query, member) one edit apart: the first ``n_short`` segments ask, the others are one letter longer.

    ``last``: the segment ends its words, so an edit may stand behind it.
    """
    everyone, short = (1 << len(segs)) - 1, (1 << n_short) - 1
    longer = everyone ^ short
    have: dict[tuple[int, str], int] = {}
    for k, seg in enumerate(segs):
        bit = 1 << k
        for at in enumerate(seg):
            have[at] = have.get(at, 0) | bit
    steps: dict[tuple[int, str], tuple[int, int]] = {}
    for k in range(n_short):
        exact, once = everyone, longer
        for at in enumerate(segs[k]):
            step = steps.get(at)
            if step is None:
                here = have[at]
                # where a member reads this letter once its edit is spent
                step = steps[at] = here, (here & short) | (have.get((at[0] + 1, at[1]), 0) & longer)
            here, moved = step
            fits = exact & here
            once = (once & moved) | (exact & short & ~here) | (fits & longer)
            exact = fits
        if not last:
            once &= ~exact  # agree up to the next part: the pair belongs there
        while once:
            low = once & -once
            yield k, low.bit_length() - 1
            once ^= low


def _near(groups: DataFrame) -> DataFrame:
    """Groups, each standing together with its shorter words first -> (word, near, near_n), both ways."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, segs, counts, n_short = None, [], [], 0

        def flush(out: tuple[list, list, list]) -> None:
            if n_short == 0 or len(segs) < 2:
                return
            _, pre, post = key
            words = [pre + s + post for s in segs]
            for q, m in near_members(segs, n_short, post == ""):
                out[0].append(words[q])
                out[1].append(words[m])
                out[2].append(counts[m])
                if m >= n_short:
                    out[0].append(words[m])
                    out[1].append(words[q])
                    out[2].append(counts[q])

        def batch(out: tuple[list, list, list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()),
                                               pa.array(out[2], pa.int64())], names=["word", "near", "near_n"])

        for b in batches:
            out: tuple[list, list, list] = ([], [], [])
            for length, pre, post, longer, seg, n in zip(*(b.column(c).to_pylist() for c in range(6))):
                if (length, pre, post) != key:
                    flush(out)
                    key, segs, counts, n_short = (length, pre, post), [], [], 0
                    if len(out[0]) > 50_000:
                        yield batch(out)
                        out = ([], [], [])
                segs.append(seg)
                counts.append(n)
                n_short += not longer
            yield batch(out)
        out = ([], [], [])
        flush(out)
        yield batch(out)

    return groups.select(*_KEY, "longer", "seg", "n").mapInArrow(run, "word string, near string, near_n bigint")


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n), each word once -> (word, near, near_n): every pair exactly one edit apart, in both directions."""
    groups = _groups(words, block)
    return _near(groups.repartition(*_KEY).sortWithinPartitions(*_KEY, "longer"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, form) without nulls -> (word, root): forms followed to the last by doubling steps.

    A form is ``ratio`` times as frequent as its word, so a chain is no longer
    than the logarithm of the largest count, and the steps that of the chain.
    """
    reach = stage(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        ahead = reach.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        step = stage(reach.join(ahead, F.col("root") == F.col("_w"), "left").select(
            "word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")), "variant-roots")
        if step.where("moved").isEmpty():
            return reach
        reach = step.select("word", "root")


def spelling_variants(words: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """(word, n) -> word, n, n_near, form, form_n, root.

    ``form``: the near word of largest n, if that is at least ``ratio`` times
    the word's; ``root``: the end of the chain of forms, the word itself if it
    has none.  ``ratio`` has to be over 1, or two words could be each other's form.
    """
    if ratio <= 1:
        raise ValueError("ratio must be over 1")
    words = stage(words.where("word is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n")), "variant-words")
    pairs = near_words(words, block)
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("minus"), "near")))
    got = words.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n")).union(
        pairs.select("word", F.lit(None).cast("long"), "near", "near_n"))
    got = got.groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), best.alias("best"))
    # counts as decimals: ratio * n must not pass 64 bits
    enough = -F.col("best.minus").cast("decimal(20,0)") >= F.lit(ratio) * F.col("n").cast("decimal(20,0)")
    got = stage(got.select("word", "n", "n_near", F.when(enough, F.col("best.near")).alias("form"),
                           F.when(enough, -F.col("best.minus")).alias("form_n")), "variant-forms")
    roots = _roots(got.where("form is not null"))
    return got.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
