"""Quality classifier: a naive Bayes support vector machine.

A text is a stream of words and of their shapes: letters, digits and signs with runs of the
same kind drawn together, a mark on a word that repeats the one before, and the ends of lines,
marked where the line came before. Its features are whether n-grams occur: single words, and
one to three shapes, hashed to DIMENSIONS. Each is scaled by the log-count ratio of the classes,
rows are scaled to unit length, and a linear hinge loss is minimised by dual coordinate descent.
Margins on folds left out are turned into probabilities by a logistic curve.

The model is fitted on a bounded sample of labelled rows (FIT_ROWS of those not held out, by
least hash) and is a table of fixed size; scoring reads every whole text.

Defined cases: null and empty texts have no features and get the score of margin zero; without
labelled rows, or with one class only, every score is the share of good rows (1 with no rows);
rows of equal doc_id each get their result; a null doc_id has no label and counts as not held
out; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import lean
from gridlens.llm.quality_rules import labelled_sample

FIT_ROWS, DIMENSIONS, SEED = 6000, 1 << 20, 7
#: Rows in which a feature must occur to have a weight; smoothing of counts; cost of a slack.
LEAST_ROWS, SMOOTH, COST, FOLDS = 3, 1.0, 1.0, 4
#: Rounds of the descent at most, and the largest step of a round after which it ends.
ROUNDS, STILL = 60, 1e-3
#: Score from which a document is predicted good.
GOOD = 0.7
#: Words whose shapes a worker remembers.
MEMORY = 300_000

_SHAPE = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c for c in range(256))
_RUN = re.compile(rb"(.)\1+", re.S)


class Features:
    """Distinct feature numbers of texts."""

    def __init__(self):
        self.shapes: dict[bytes, bytes] = {}
        self.grams: dict[tuple, int] = {}

    def shape(self, word: bytes) -> bytes:
        s = self.shapes.get(word)
        if s is None:
            s = _RUN.sub(rb"\1", word.translate(_SHAPE))
            if len(self.shapes) >= MEMORY:
                self.shapes.clear()
            if len(word) <= 64:
                self.shapes[word] = s
        return s

    def gram(self, g: tuple) -> int:
        k = self.grams.get(g)
        if k is None:
            k = crc32(b"\x00".join((b"s", *g))) % DIMENSIONS
            if len(self.grams) >= MEMORY:
                self.grams.clear()
            self.grams[g] = k
        return k

    def __call__(self, text: bytes | None) -> np.ndarray:
        stream: list[bytes] = []
        words: set[bytes] = set()
        seen: set[bytes] = set()
        shape, last = self.shape, None
        for line in (text or b"").split(b"\n"):
            ws = line.split()
            if not ws:
                continue
            for w in ws:
                stream.append(shape(w) + b"=" if w == last else shape(w))
                last = w
            words.update(ws)
            stream.append(b"\n=" if line in seen else b"\n")
            seen.add(line)
        if not stream:
            return np.empty(0, dtype=np.int32)
        grams = {*zip(stream), *zip(stream, stream[1:]), *zip(stream, stream[1:], stream[2:])}
        out = {self.gram(g) for g in grams}
        out.update(crc32(w.lower()) % DIMENSIONS for w in words)
        return np.fromiter(out, dtype=np.int32, count=len(out))


@dataclass
class Model:
    """weight and square by feature: what it adds to the margin and to the squared length."""

    weight: np.ndarray = field(default_factory=lambda: np.zeros(DIMENSIONS, dtype=np.float32))
    square: np.ndarray = field(default_factory=lambda: np.zeros(DIMENSIONS, dtype=np.float32))
    bias: float = 0.0
    slope: float = 0.0
    offset: float = 0.0

    def margin(self, x: np.ndarray) -> float:
        length = float(self.square[x].sum(dtype=np.float64))
        return self.bias + (float(self.weight[x].sum(dtype=np.float64)) / length**0.5 if length > 0 else 0.0)

    def score(self, x: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.offset, -35, 35))))


def log_count_ratios(xs: list[np.ndarray], good: np.ndarray) -> np.ndarray:
    """Log of the ratio of the features' shares among good and other rows; 0 for rare features."""
    counts = [np.bincount(np.concatenate([x for x, g in zip(xs, good, strict=True) if g == side] or [np.empty(0, int)]), minlength=DIMENSIONS) for side in (True, False)]
    p, q = (c + SMOOTH for c in counts)
    r = np.log((p / (good.sum() + 2 * SMOOTH)) / (q / ((~good).sum() + 2 * SMOOTH)))
    return np.where(counts[0] + counts[1] >= LEAST_ROWS, r, 0.0)


def scaled_rows(xs: list[np.ndarray], r: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of each row the features with a ratio, and their ratios scaled to unit length."""
    rows = [x[r[x] != 0] for x in xs]
    return rows, [r[x] / max(np.sqrt((r[x] ** 2).sum()), 1e-12) for x in rows]


def bounds(good: np.ndarray) -> np.ndarray:
    """The most that the dual variable of a row may be: classes weigh alike."""
    return COST * len(good) / (2 * np.where(good, good.sum(), (~good).sum()))


def descend(rows: list[np.ndarray], values: list[np.ndarray], good: np.ndarray, rounds: int = ROUNDS, still: float = STILL) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise half their squared length plus the bounded hinge losses, one dual variable after the other."""
    y, most = np.where(good, 1.0, -1.0), bounds(good)
    w, bias, alpha = np.zeros(DIMENSIONS), 0.0, np.zeros(len(y))
    norm = np.array([(v**2).sum() + 1.0 for v in values])  # the bias is a feature of value one
    rng = np.random.default_rng(SEED)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(y)):
            slope = y[i] * (w[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - slope / norm[i], 0.0), most[i])
            if step := (new - alpha[i]) * y[i]:
                w[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < still:
            break
    return w, float(bias)


def fit_margin(xs: list[np.ndarray], good: np.ndarray) -> Model:
    """The linear model over scaled indicators."""
    r = log_count_ratios(xs, good)
    w, bias = descend(*scaled_rows(xs, r), good)
    return Model((w * r).astype(np.float32), (r**2).astype(np.float32), bias)


def logistic(margins: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve of most likelihood, with the targets drawn in a little."""
    n1, n0 = good.sum(), (~good).sum()
    t = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, beta = np.stack([margins, np.ones(len(margins))], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (t - p))
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def fit(xs: list[np.ndarray], good: np.ndarray) -> Model:
    if not len(good) or good.all() or not good.any():
        share = float(good.mean()) if len(good) else 1.0
        return Model(offset=float(np.clip(np.log(max(share, 1e-12) / max(1 - share, 1e-12)), -35, 35)))
    fold, margins = np.arange(len(good)) % FOLDS, np.zeros(len(good))
    for k in range(FOLDS):
        rest = fold != k
        if good[rest].all() or not good[rest].any():
            continue
        part = fit_margin([x for x, m in zip(xs, rest, strict=True) if m], good[rest])
        for i in np.nonzero(~rest)[0]:
            margins[i] = part.margin(xs[i])
    model = fit_margin(xs, good)
    model.slope, model.offset = logistic(margins, good)
    return model


def held_out(doc_id):
    """Rows that are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features()
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "good": batch["good"], "x": [np.sort(features(t)) for t in batch["text"]]})

    sample = labelled_sample(docs, labels.where(~held_out(F.col("doc_id"))), rows).select("doc_id", F.col("text").cast("binary").alias("text"), "good")
    found = sample.mapInPandas(run, "doc_id long, good int, x array<int>").orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(rows).collect()
    return fit([np.asarray(r.x, dtype=np.int32) for r in found], np.array([r.good == 1 for r in found], dtype=bool))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs (doc_id, text)."""
    lean(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMENSIONS weights

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features, model = Features(), shared.value
        for batch in batches:
            s = np.array([model.score(features(t)) for t in batch["text"]])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": s, "predicted": (s >= GOOD).astype(np.int32)})

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("binary").alias("text"))
    return rows.mapInPandas(run, "doc_id long, held_out boolean, score double, predicted int")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return scored(docs, fitted(docs, labels))
