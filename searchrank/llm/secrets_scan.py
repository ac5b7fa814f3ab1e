"""Secret scan: rule findings, and a character network over every candidate.

The base rules find three kinds of secret in whole texts.  They also label
candidates: a candidate is a run of 16 or more token characters holding a
digit; it is a positive example if a base finding overlaps it.  A small
convolutional network in numpy reads the characters of each candidate and
of its surroundings and scores it.  It is trained on the labelled candidates of
all documents.  Their distinct windows are dealt evenly into parts of ``train_rows``
negatives and half as many positives at most; in every epoch each part trains the
shared weights in a task of its own, and the parts' weights are averaged by their
rows.  Both kinds weigh alike, and every part has some of both (of a kind that is
too rare for it, copies), so that negatives never crowd positives out; positives are
shown a second time in a negative's surroundings and at several lengths, so that the
shape of a key counts and not only the word before it.  On a held-out fourth of all
windows, its positives with and without that context, the scores are calibrated
(Platt) and the threshold is the highest one that keeps ``recall`` of the positives.
Candidates over it are added as kind ``cnn``; base findings always stay.

Long candidates are read in pieces of ``BODY`` characters, each with
its surroundings, and take the highest score, so no part is left unread.
Of a run that base findings overlap, the parts outside them are candidates
like any run, read without the text of those findings.

Defined cases: null text has no findings; repeated rows keep their rows;
ties in the training order are broken by content, and equal candidates
count once; without a positive, or without a negative, in all documents
there is nothing to learn from and only base findings are returned; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import copy
import re
from collections.abc import Iterator
from itertools import cycle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchrank.llm.common import stage, text_chunks
from searchrank.operators import stats
from searchrank.operators.sequence import row_number_within

KINDS = ("assign", "access", "hex")
# The base rules of the contract (pattern, tested group, least length).
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                          r"""([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)
#: The hex rule without runs that its length test drops anyway (a maximal run is found either way).
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")
#: What an assignment needs: a sign with a keyword's last letter, quote or space before it.
_SIGN = re.compile(r"""[dtnyDTNY]["']?\x20*[:=]""")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_DIGIT = re.compile(r"[0-9]")

LEFT, BODY, RIGHT = 24, 48, 8
WIDTH, FILTERS, EMBED = 5, 24, 8
#: Lengths at which positives are shown once more without their surroundings.
LENGTHS = (16, 20, 24, 32, BODY)
#: Negatives of a part, at most (positives: half of it).
TRAIN_ROWS = 20_000
#: Windows are dealt in blocks: one is held out, the others are learnt from.
DEAL = 4
#: Blocks of each kind that a part has at least, copies included, where there are so many.
LEAST_BLOCKS = 8
#: Times the windows are read in training, and Newton steps of the calibration at most.
EPOCHS, STEPS = 25, 200


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base findings, ordered by start, then kind as listed."""
    out = []
    for kind, pattern, group, least in BASE:
        if kind == "assign" and not _SIGN.search(text):
            continue
        for m in (_LONG_HEX if kind == "hex" else pattern).finditer(text):
            if len(m.group(group)) >= least:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CANDIDATE.finditer(text) if _DIGIT.search(m.group())]


def windows(text: str, start: int, end: int, lo: int = 0, hi: int | None = None) -> list[str]:
    """Pieces of a candidate with their surroundings in [lo, hi), each LEFT + BODY + RIGHT characters."""
    hi, out = len(text) if hi is None else hi, []
    for at in range(start, end, BODY):
        left = text[max(lo, at - LEFT):at].rjust(LEFT, "\0")
        out.append(left + text[at:min(hi, at + BODY + RIGHT)].ljust(BODY + RIGHT, "\0"))
    return out


def covered(found: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Base findings, ordered by start, as disjoint ranges."""
    out: list[tuple[int, int]] = []
    for a, b, _ in found:
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def meetings(spans: list[tuple[int, int]], found: list[tuple[int, int, str]]) -> Iterator[tuple[tuple[int, int], list]]:
    """Each candidate with the covered ranges it meets: one sweep over both, which are in order."""
    ranges, first = covered(found), 0
    for s in spans:
        while first < len(ranges) and ranges[first][1] <= s[0]:
            first += 1
        k = first
        while k < len(ranges) and ranges[k][0] < s[1]:
            k += 1
        yield s, ranges[first:k]


def outside(text: str, span: tuple[int, int], ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Parts of a candidate that no range covers and that are candidates themselves."""
    out, at = [], span[0]
    for a, b in (*ranges, (span[1], span[1])):
        out += [(at + x, at + y) for x, y in candidates(text[at:max(at, a)])]
        at = max(at, b)
    return out


def char_ids(texts: list[str]) -> np.ndarray:
    """Characters as 0 (none), 1..95 (printable ASCII), 96 (letters beyond), 97 (others)."""
    codes = np.array([list(map(ord, t)) for t in texts], dtype=np.int64).reshape(len(texts), LEFT + BODY + RIGHT)
    return np.where((codes >= 32) & (codes < 127), codes - 31, np.where(codes == 0, 0, np.where(codes > 127, 96, 97)))


class Network:
    """Embedding, one convolution, maximum over places, logistic output."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {"e": r.normal(0, 0.3, (98, EMBED)), "w": r.normal(0, 0.2, (WIDTH * EMBED, FILTERS)),
                  "b": np.zeros(FILTERS), "v": r.normal(0, 0.2, 2 * FILTERS), "c": np.zeros(1)}
        self.m1, self.m2 = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        self.step = 0
        self.scale, self.shift, self.threshold = 1.0, 0.0, 1.1
        #: Distinct positive and negative windows it was trained and calibrated on.
        self.rows = (0, 0)

    def state(self) -> np.ndarray:
        """Weights and the optimiser's two moments as one row of numbers."""
        return np.concatenate([d[k].ravel() for d in (self.p, self.m1, self.m2) for k in d])

    def load(self, state: np.ndarray) -> None:
        at = 0
        for d in (self.p, self.m1, self.m2):
            for k, v in d.items():
                d[k] = state[at:at + v.size].reshape(v.shape)
                at += v.size

    def _forward(self, x: np.ndarray):
        z = self.p["e"][x]
        cols = np.concatenate([z[:, j:z.shape[1] - WIDTH + 1 + j] for j in range(WIDTH)], axis=2)
        a = np.maximum(cols @ self.p["w"] + self.p["b"], 0)
        # surroundings before the candidate and the candidate itself are pooled apart
        cut = LEFT - WIDTH + 1
        at = np.concatenate((a[:, :cut].argmax(axis=1), cut + a[:, cut:].argmax(axis=1)), axis=1)
        filt = np.tile(np.arange(FILTERS), 2)
        top = a[np.arange(len(x))[:, None], at, filt]
        return cols, at, filt, top, top @ self.p["v"] + self.p["c"][0]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[i:i + 512])[4] for i in range(0, len(x), 512)] or [np.zeros(0)])

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01,
            seed: int | tuple = 7) -> None:
        r = np.random.default_rng(seed)
        m1, m2 = self.m1, self.m2
        for _ in range(epochs):
            order = r.permutation(len(x))
            for k in range(0, len(x), 128):
                i = order[k:k + 128]
                cols, at, filt, top, out = self._forward(x[i])
                d = weight[i] * (1 / (1 + np.exp(-out)) - y[i]) / weight[i].sum()
                back = d[:, None] * self.p["v"] * (top > 0)
                rows = np.arange(len(i))[:, None]
                picked = cols[rows, at]                                  # n, 2F, WIDTH * EMBED
                g = {"v": top.T @ d, "c": np.array([d.sum()]), "b": np.bincount(
                    np.tile(filt, len(i)), back.ravel(), FILTERS), "e": np.zeros_like(self.p["e"])}
                both = np.einsum("nf,nfk->fk", back, picked)
                g["w"] = (both[:FILTERS] + both[FILTERS:]).T
                to = back[:, :, None] * self.p["w"].T[filt][None]        # n, 2F, WIDTH * EMBED
                for j in range(WIDTH):
                    np.add.at(g["e"], x[i][rows, at + j].ravel(),
                              to[:, :, j * EMBED:(j + 1) * EMBED].reshape(-1, EMBED))
                self.step += 1
                for n in self.p:
                    m1[n] = 0.9 * m1[n] + 0.1 * g[n]
                    m2[n] = 0.999 * m2[n] + 0.001 * g[n] ** 2
                    self.p[n] = self.p[n] - rate * (m1[n] / (1 - 0.9 ** self.step)) / (
                        np.sqrt(m2[n] / (1 - 0.999 ** self.step)) + 1e-8)

    def calibrate(self, scores: DataFrame, recall: float) -> None:
        """Platt scaling, then the highest threshold that keeps ``recall`` of the positives.

        ``scores``: (z, y), the logit and the label of every held-out row, staged; a
        step is one aggregate over all of them.  Targets are smoothed and steps
        damped, so that the slope stays finite where the two kinds lie apart.
        """
        n, n1, mid, spread = scores.agg(F.count("*"), F.sum("y"), F.avg("z"), F.stddev_pop("z")).first()
        spread += 1e-9
        u = (F.col("z") - mid) / spread
        t = F.when(F.col("y") == 1, (n1 + 1) / (n1 + 2)).otherwise(1 / (n - n1 + 2))
        a, b = 1.0, 0.0
        for _ in range(STEPS):
            p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), a * u + b))))
            q = p * (1 - p)
            gu, g1, huu, hu, h1 = scores.agg(F.sum((p - t) * u), F.sum(p - t), F.sum(q * u * u), F.sum(q * u),
                                             F.sum(q)).first()
            # a weak pull to the starting slope
            g = np.array([gu + 0.1 * (a - 1), g1])
            step = np.linalg.solve(np.array([[huu + 0.1, hu], [hu, h1]]) + 1e-3 * np.eye(2), g)
            a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
            if np.abs(step).max() < 1e-9:
                break
        self.scale, self.shift = float(a / spread), float(b - a * mid / spread)
        at = int(np.floor((1 - recall) * n1))
        place = (0, at if self.scale >= 0 else n1 - 1 - at)   # a negative slope turns the order
        z = stats.select_positions(stats.narrow(scores.where("y = 1"), ["z"]), [place])[place]
        self.threshold = float(self.calibrated(np.array([z]))[0])

    def calibrated(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -30, 30)))

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.calibrated(self.logits(x))


def labelled(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> window, hit: the distinct windows of all documents; positive anywhere is positive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_chunks(batches):
            rows = []
            for t in b.column(0).to_pylist():
                found = base_spans(t) if t and _DIGIT.search(t) else []
                for s, met in meetings(candidates(t or ""), found):
                    rows += [(w, bool(met)) for w in windows(t, *s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.bool_())],
                names=["window", "hit"])

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "window string, hit boolean").groupBy(
        "window").agg(F.max("hit").alias("hit"))


def dealt(rows: DataFrame, n_pos: int, n_neg: int, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``labelled`` rows -> part, rows array<struct<neg, at, copy, window>>: a row per part, in order.

    ``at`` counts the windows of a kind from 0 in hash order; blocks of ``DEAL`` go
    round the parts.  A kind with too few blocks is copied (copy > 0) to more parts.
    """
    parts = max(-(-n_pos // max(1, train_rows // 2)), -(-n_neg // train_rows))

    def copies(n: int) -> int:
        return min(parts, -(-parts * LEAST_BLOCKS // -(-n // DEAL)))

    each = F.when(F.col("hit"), copies(n_pos)).otherwise(copies(n_neg))
    at = row_number_within(rows, "hit", [F.xxhash64("window"), "window"], out="at").select(
        "window", (~F.col("hit")).alias("neg"), (F.col("at") - 1).alias("at"), each.alias("each"))
    at = at.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("each") - 1)))
    at = at.withColumn("part", F.pmod(F.floor(F.col("at") / DEAL) * F.col("each") + F.col("copy"), F.lit(parts)))
    return at.repartition(parts, "part").groupBy("part").agg(
        F.sort_array(F.collect_list(F.struct("neg", "at", "copy", "window"))).alias("rows"))


def _bare(pos: list[str], neg: list[str]) -> list[str]:
    """Positives once more as they would stand in prose: in a negative's place, at several lengths.

    A key has to be known by its shape, not by the word that announces it.
    """
    out = []
    for w, n, most in zip(pos, cycle(neg), cycle(LENGTHS)):
        body = CANDIDATE.match(w, LEFT)
        if body and _DIGIT.search(body.group()[:most]):
            place = CANDIDATE.match(n, LEFT)
            text = n[:LEFT] + body.group()[:most] + (n[place.end():] if place else "")
            out.append(text[:LEFT + BODY + RIGHT].ljust(LEFT + BODY + RIGHT, "\0"))
    return out


def _split(rows: list[dict], held: bool, single: bool) -> tuple[np.ndarray, np.ndarray]:
    """The held-out rows of a part, or those to learn from, and their labels; bare positives last.

    Copies are never held out; a ``single`` positive stands on both sides.
    """
    pos, neg = ([r for r in rows if r["neg"] == x] for x in (False, True))

    def mine(r: dict, at: int) -> bool:
        out = r["at"] % DEAL == at
        return out and not r["copy"] if held else not out

    p = [r["window"] for r in pos if mine(r, 0) or (single and not held)]
    n = [r["window"] for r in neg if mine(r, DEAL - 1)]
    more = _bare(p, [r["window"] for r in neg])
    return char_ids(p + n + more), np.repeat([1.0, 0.0, 1.0], [len(p), len(n), len(more)])


def _epochs(parts: DataFrame, net: Network, epochs: int, seed: int | tuple, single: bool) -> None:
    """Each part trains the weights of ``net`` for ``epochs``; their mean, by rows, is the new state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                part = b.column(0)[i].as_py()
                x, y = _split(b.column(1)[i].as_py(), False, single)
                own = copy.deepcopy(net)
                weight = np.where(y == 1, len(y) / (2 * max(1.0, y.sum())), len(y) / (2 * max(1.0, (1 - y).sum())))
                own.fit(x, y, weight, epochs, seed=seed if isinstance(seed, int) else (*seed, part))
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([len(y)], pa.int64()), pa.array(
                    [own.step], pa.int64()), pa.array([own.state().tobytes()], pa.binary())],
                    names=["part", "n", "step", "state"])

    total, n, step = np.zeros_like(net.state()), 0, net.step
    for r in parts.mapInArrow(run, "part bigint, n bigint, step bigint, state binary").repartition(
            1).sortWithinPartitions("part").toLocalIterator():
        total += r["n"] * np.frombuffer(bytes(r["state"]))
        n, step = n + r["n"], max(step, r["step"])
    if n:
        net.load(total / n)
        net.step = step


def train(docs: DataFrame, recall: float = 0.95, train_rows: int = TRAIN_ROWS,
          train_docs: int | None = None) -> Network | None:
    """Train the network on the labelled candidates of all ``docs`` (doc_id, text).

    ``train_docs`` has no effect: every document is read.
    """
    rows = stage(labelled(docs), "secret-windows")
    n_pos, n_neg = rows.agg(F.count_if("hit"), F.count_if(~F.col("hit"))).first()
    if not n_pos or not n_neg:
        return None
    parts, single = stage(dealt(rows, n_pos, n_neg, train_rows), "secret-parts"), n_pos < 2
    net = Network()
    net.rows = n_pos, n_neg
    if parts.count() == 1:
        _epochs(parts, net, EPOCHS, 7, single)
    else:
        for k in range(EPOCHS):
            _epochs(parts, net, 1, (7, k), single)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                # what is recalled counts with and without surroundings alike
                x, y = _split(b.column(1)[i].as_py(), True, single)
                yield pa.RecordBatch.from_arrays([pa.array(net.logits(x)), pa.array(y.astype(np.int64))], names=["z", "y"])

    net.calibrate(stage(parts.mapInArrow(held, "z double, y bigint"), "secret-scores"), recall)
    return net


def scan(docs: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, text) -> doc_id, spans array<struct<kind, start, end, score>>.

    Spans are in code points, end exclusive, ordered by start, then kind
    (assign, access, hex, cnn); base spans score 1.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_chunks(batches):
            out, asked, owner = [], [], []
            for k, t in enumerate(b.column(1).to_pylist()):
                found = base_spans(t) if t else []
                out.append([(a, KINDS.index(n), {"kind": n, "start": a, "end": e, "score": 1.0}) for a, e, n in found])
                if net is not None:
                    for s, met in meetings(candidates(t or ""), found):
                        for x in outside(t, s, met) if met else [s]:
                            ws = windows(t, *x, x[0] if x[0] > s[0] else 0, x[1] if x[1] < s[1] else None)
                            asked += ws
                            owner += [(k, x)] * len(ws)
            if asked:
                best: dict = {}
                for o, v in zip(owner, net.score(char_ids(asked)).tolist()):
                    best[o] = max(v, best.get(o, 0.0))
                for (k, s), v in best.items():
                    if v >= net.threshold:
                        out[k].append((s[0], len(KINDS), {"kind": "cnn", "start": s[0], "end": s[1], "score": v}))
            spans = [[x[2] for x in sorted(o, key=lambda x: x[:2])] for o in out]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, pa.list_(span))], names=["doc_id", "spans"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"doc_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>")


def find_secrets(docs: DataFrame, recall: float = 0.95) -> DataFrame:
    """Train on ``docs`` and scan them."""
    return scan(docs, train(docs, recall))
