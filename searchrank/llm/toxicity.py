"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; the unlabelled set is drawn from
all training rows, labelled or not, and may hold either kind.  A linear classifier over the distinct words of
a text and their stems minimises, in numpy, the class-prior-corrected risk

    prior * E_pos[loss(+)] + max(0, E_unl[loss(-)] - prior * E_pos[loss(-)])

with the logistic loss; where the second part turns negative (the
unlabelled set is being overfitted) the step is taken the other way, as
the non-negative estimator asks.  The prior is the share of toxic among
the labelled training rows.  Scores are calibrated (Platt) on training rows
kept out of the fit: a fifth of all rows, by hash.

The fit uses a bounded sample of documents, in order of a hash: ``max_positive``
positives, ``max_unlabelled`` of all rows and ``max_calibration`` labelled rows.
Documents count as they come, copies included, in both expectations as
in the prior.  Texts never reach the driver, only numbers of chosen features.
Scoring reads every whole text.

Defined cases: null and empty texts get the score of a text without words;
without a positive in the training rows every score is 0; several labels
of one doc_id count as toxic if any is; labels with null doc_id or null
toxic are ignored; repeated rows keep their rows; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchrank.llm.common import stage, text_chunks

#: Texts in the fit, and labelled texts in the calibration, at most.
MAX_POSITIVE, MAX_UNLABELLED, MAX_CALIBRATION = 2500, 7500, 3000
#: A word has to stand in so many texts of the sample.
MIN_DOCS = 3
#: ... and its shares among positives and unlabelled texts have to lie so many standard errors apart.
APART = 4.0
_WORD = re.compile(r"\w+")
#: Lengths of the stems a word counts for besides itself.
STEMS = (4, 5, 6)
#: Words whose weight a task remembers before it starts afresh.
REMEMBERED = 300_000


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def parts_of(word: str) -> list[str]:
    """Features of a word: itself, and the stems it may begin with."""
    return [word, *("^" + word[:n] for n in STEMS if len(word) > n)]


class Model:
    """Feature weights and calibration; ``score`` takes texts.

    A text's raw score is the sum of the weights of its distinct words; a
    word's weight is the sum over its parts (``parts_of``), remembered for up
    to ``REMEMBERED`` words.
    """

    def __init__(self, weights: dict[str, float], bias: float, scale: float = 1.0, shift: float = 0.0):
        self.weights, self.bias, self.scale, self.shift = weights, bias, scale, shift
        self.words: dict[str, float] = {}

    def raw(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        w, known = self.weights, self.words
        for k, t in enumerate(texts):
            ws = words_of(t)
            if len(known) > REMEMBERED:
                known.clear()
            for x in ws.difference(known):  # looks words up; "-" would walk all that is known
                known[x] = sum(w.get(p, 0.0) for p in parts_of(x))
            out[k] = self.bias + sum(map(known.__getitem__, sorted(ws)))
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.raw(texts) + self.shift, -30, 30)))


def _sum_by(values: np.ndarray, lens: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lens)
    total = np.concatenate(([0.0], np.cumsum(values)))
    return total[ends] - total[ends - lens]


def features_of(words: Iterable[str]) -> list[str]:
    """The features of a text's distinct words; a feature of several words stands several times."""
    return [p for word in words for p in parts_of(word)]


def apart(in_pos: np.ndarray, in_unl: np.ndarray, n_pos: int, n_unl: int) -> np.ndarray:
    """Log ratio of a feature's shares in the two sets, in standard errors (smoothed)."""
    a, c = in_pos + 0.5, in_unl + 0.5
    return np.abs(np.log(a / n_pos) - np.log(c / n_unl)) / np.sqrt(1 / a + 1 / c)


def risk(z: np.ndarray, is_pos: np.ndarray, prior: float, beta: float = 0.0) -> tuple[float, np.ndarray]:
    """The non-negative PU risk of raw scores, and the direction of the next step by score."""
    n_pos, n_unl = max(1, int(is_pos.sum())), max(1, int((~is_pos).sum()))
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    loss_neg = np.logaddexp(0, z)
    rest = loss_neg[~is_pos].sum() / n_unl - prior * loss_neg[is_pos].sum() / n_pos
    value = prior * np.logaddexp(0, -z)[is_pos].sum() / n_pos + max(0.0, rest)
    if rest >= -beta:
        return value, np.where(is_pos, prior * (p - 1) / n_pos - prior * p / n_pos, p / n_unl)
    # step back from the overfitted part
    return value, np.where(is_pos, prior * p / n_pos, -p / n_unl)


def minimise(rows: list[np.ndarray], is_pos: np.ndarray, n_features: int, prior: float, rounds: int = 800,
             rate: float = 0.05, l2: float = 1e-4, beta: float = 0.0) -> np.ndarray:
    """Feature weights and, last, the bias that minimise the risk; ``rows`` hold each text's feature numbers."""
    lens = np.array([len(r) for r in rows])
    idx = np.concatenate([np.zeros(0, dtype=np.int64), *rows]).astype(np.int64)
    w, mean = np.zeros(n_features + 1), np.zeros(n_features + 1)
    m1, m2 = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        d = risk(_sum_by(w[idx], lens) + w[-1], is_pos, prior, beta)[1]
        g = np.concatenate((np.bincount(idx, np.repeat(d, lens), n_features), [d.sum()]))
        g[:-1] += l2 * w[:-1]
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        w = w - rate * (m1 / (1 - 0.9 ** t)) / (np.sqrt(m2 / (1 - 0.999 ** t)) + 1e-8)
        if 2 * t > rounds:  # the later half is averaged: steps to and fro cancel out
            mean += w / (rounds - rounds // 2)
    return mean


def nn_pu(pos: list[Iterable[str]], unl: list[Iterable[str]], prior: float, **steps) -> tuple[dict[str, float], float]:
    """Feature weights and bias from the distinct words of texts held in memory (``train`` does it for tables)."""
    have = [sorted(features_of(d)) for d in (*pos, *unl)]
    counts: dict[str, list[int]] = {}
    for k, fs in enumerate(have):
        for f in set(fs):
            counts.setdefault(f, [0, 0])[k >= len(pos)] += 1
    chosen = [f for f, (a, c) in sorted(counts.items()) if a + c >= MIN_DOCS
              and apart(np.array(a), np.array(c), len(pos), len(unl)) >= APART]
    at = {f: i for i, f in enumerate(chosen)}
    rows = [np.array([at[f] for f in fs if f in at], dtype=np.int32) for fs in have]
    w = minimise(rows, np.arange(len(rows)) < len(pos), len(at), prior, **steps)
    return {f: float(w[i]) for f, i in at.items()}, float(w[-1])


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the calibrated logistic (smoothed targets, Newton steps with damping)."""
    n1, n0 = y.sum(), (1 - y).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    mid, spread = z.mean(), z.std() + 1e-9
    u = (z - mid) / spread
    a, b = 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * u + b, -30, 30)))
        q = p * (1 - p)
        h = np.array([[(q * u * u).sum(), (q * u).sum()], [(q * u).sum(), q.sum()]]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, [((p - t) * u).sum(), (p - t).sum()])
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    return float(a / spread), float(b - a * mid / spread)


def train(sample: DataFrame, prior: float) -> Model | None:
    """``sample`` (part: pos / unl / cal, toxic, text), bounded by the caller -> model, None without positives.

    Texts stay in the tasks.  Features are counted and chosen there; the
    driver gets each text's numbers of chosen features, and the raw score of each
    calibration text.
    """
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_chunks(batches, 64):
            got = [features_of(sorted(words_of(t))) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.list_(pa.string()))], names=["part", "fs"])

    fit_rows = sample.where("part <> 'cal'").select("part", "toxic", "text").mapInArrow(
        features, "part string, fs array<string>")
    fit_rows = stage(fit_rows, "toxicity-features")
    size = {r["part"]: r["n"] for r in fit_rows.groupBy("part").agg(F.count("*").alias("n")).collect()}
    n_pos, n_unl = size.get("pos", 0), size.get("unl", 0)
    if not n_pos or not n_unl:
        return None
    counts = fit_rows.select("part", F.explode(F.array_distinct("fs")).alias("f")).groupBy("f").agg(
        F.count_if(F.col("part") == "pos").alias("a"), F.count_if(F.col("part") == "unl").alias("c"))
    a, c = F.col("a") + 0.5, F.col("c") + 0.5
    far = F.abs(F.log(a / n_pos) - F.log(c / n_unl)) / F.sqrt(1 / a + 1 / c)
    # features that MIN_DOCS texts of the bounded sample have and that tell the sets apart
    chosen = sorted(r["f"] for r in counts.where((F.col("a") + F.col("c") >= MIN_DOCS) & (far >= APART)).select("f").collect())
    at = {f: i for i, f in enumerate(chosen)}

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [[at[f] for f in fs if f in at] for fs in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.list_(pa.int32()))], names=["part", "ns"])

    rows, parts = [], []
    for part, ns in fit_rows.mapInArrow(numbered, "part string, ns array<int>").collect():
        parts.append(part == "pos")
        rows.append(np.array(ns, dtype=np.int32))
    # a defined order of summation, however the tasks returned
    order = sorted(range(len(rows)), key=lambda i: (not parts[i], rows[i].tobytes()))
    w = minimise([rows[i] for i in order], np.array([parts[i] for i in order]), len(at), prior)
    model = Model({f: float(w[i]) for f, i in at.items()}, float(w[-1]))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_chunks(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.raw(b.column(1).to_pylist()))], names=["y", "z"])

    cal = sample.where("part = 'cal'").select(F.col("toxic").cast("int").alias("toxic"), "text").mapInArrow(
        scored, "y int, z double").orderBy("z", "y").collect()
    y, z = (np.array([r[k] for r in cal], dtype=float) for k in ("y", "z"))
    if len(y) and 0 < y.sum() < len(y):
        model.scale, model.shift = _platt(z, y)
    return model


def held_out(doc_id: Column) -> Column:
    """Fold 1 of three, by crc32 of the id as text; a null id is no part of it."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED,
        max_calibration: int = MAX_CALIBRATION) -> Model | None:
    """Train on documents outside the held-out fold.

    The rows are chosen by (doc_id, text length) alone, so that only texts
    of chosen rows are read whole.
    """
    known = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
             .agg(F.max("toxic").cast("int").alias("toxic")))
    d = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(
        F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    ids = stage(d.select("doc_id").distinct().join(known, "doc_id", "left"), "toxicity-rows")
    n, n_toxic = ids.agg(F.count("toxic"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n_toxic:
        return None
    h = F.xxhash64("doc_id", F.lit("toxicity"))
    ids = ids.withColumn("h", h)
    # a fifth of the rows is kept out, its labelled ones for calibration; all others stand for the corpus
    out = F.pmod("h", F.lit(5)) == 0
    picked = None
    for part, most, which in (("pos", max_positive, ~out & (F.col("toxic") == 1)), ("unl", max_unlabelled, ~out),
                              ("cal", max_calibration, out & F.col("toxic").isNotNull())):
        some = ids.where(which).orderBy("h", "doc_id").limit(most).withColumn("part", F.lit(part))
        picked = some if picked is None else picked.union(some)
    picked = stage(picked.select("doc_id", "part", "toxic"), "toxicity-sample")
    # at most 13,000 ids are broadcast; of repeated ids one text is taken
    rows = d.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "part").agg(
        F.first("toxic").alias("toxic"), F.min("text").alias("text"))
    return train(stage(rows.select("part", "toxic", "text"), "toxicity-texts"), n_toxic / n)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """Add ``score`` (0 to 1) from the whole ``text`` alone; other columns stay."""
    cols = [f for f in docs.schema.fields if f.name != "score"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cols) + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_chunks(batches):
            texts = b.column("text").to_pylist()
            s = model.score(texts) if model is not None else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in cols), pa.array(s, pa.float64())],
                                             names=[*(f.name for f in cols), "score"])

    return docs.select(*[f"`{f.name}`" for f in cols]).mapInArrow(run, schema)
