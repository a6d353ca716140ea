"""Quality rules: an isolation forest on rule statistics.

Every text gets the base statistics and the ratios of FEATURES. All labelled rows are dealt in
two halves by a hash of their doc_id. A forest of random splits is grown on the first: as the
method has it, each tree splits SUBSAMPLE rows drawn anew from the whole half, few of which are
not labelled good; then all rows of the half run down every tree, and how many end in a leaf
makes its path longer. How short a document's path is over all trees makes its anomaly score.
The threshold is calibrated on all rows of the second half, which grew no tree: of those above
which at most FALSE_REJECTS of the rows labelled good lie, the one that tells most of the others.

Labelled rows stay in the cluster. The driver gets the rows that trees split and the counts of
leaves and of bits of scores, whose number the trees fix and the table does not.

Defined cases: null and empty texts have no words and fail the base rules; whole texts are
read; without labelled rows, or with one kind only in the second half, the threshold is
infinite and the base rules decide alone; rows of equal doc_id each get their result, and as labels
all count if their labels agree, those of equal texts once; a null doc_id has no label; an empty
table gives no rows; other columns pass through ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.llm.common import Scratch, lean, packed, small

#: Rows that a tree splits; trees.
SUBSAMPLE, TREES = 256, 120
#: Share of good rows that the threshold may reject.
FALSE_REJECTS = 0.002
#: Rows of a tree that are not labelled good, as a share of those that are.
OTHERS = 0.05
SEED = 20

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("symbol_ratio", "upper_ratio", "digit_ratio", "log_length", "distinct_gap", "stutter_ratio", "dup_line_ratio", "repeat_ratio", "loud_ratio", "bar_ratio", "top_share", "log_words")
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(1 if 65 <= c <= 90 else 0 for c in range(256))
_W = 8


def statistics(text: bytes | None) -> tuple[list[int], list[float]]:
    """The base statistics and the features of one text."""
    text = text or b""
    words = text.split()  # of bytes: ASCII white space only
    n = len(words)
    joined = b"".join(words)
    plain = len(joined.decode("utf-8", "replace"))
    symbols = sum(text.count(bytes([c])) for c in _SYMBOLS)
    lines = [x for x in text.split(b"\n") if x.split()] if b"\n" in text else [text] if n else []
    dup_lines = len(lines) - len(set(lines))
    repeat, stutter, top, distinct = 0, 0, 0, 0
    if n:
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=n)
        distinct, top = len(number), int(np.bincount(ids).max())
        stutter = int((ids[1:] == ids[:-1]).sum())
        if n > _W:
            rank = ids  # rank of each window, doubled in width, exact: equal ranks are equal windows
            for width in (1, 2, 4):
                m = len(rank) - width
                rank = np.unique(rank[:m] * np.int64(n + 1) + rank[width:], return_inverse=True)[1]
            twice = np.nonzero((np.bincount(rank) > 1)[rank])[0]
            step = np.zeros(n + 1, dtype=np.int64)
            step[twice] += 1
            np.subtract.at(step, twice + _W, 1)
            repeat = int((np.cumsum(step[:-1]) > 0).sum())
    upper = len(joined) - len(joined.translate(None, bytes(range(65, 91))))
    digits = len(joined) - len(joined.translate(None, b"0123456789"))
    k, c = max(n, 1), max(plain, 1)
    expected = k**0.9  # distinct words of a text grow more slowly than its words
    # some digits, one closing line or one quoted sentence in a short text are no fault
    features = [
        symbols / c, upper / c, max(0.0, digits / c - 0.2), float(np.log1p(plain / k)), max(0.0, 1 - distinct / expected), stutter / k,
        dup_lines / (len(lines) + 5), repeat / (n + 50), text.count(b"!") / k, text.count(b"|") / k, top / k if n >= 20 else 0.0, float(np.log1p(n)) / 10,
    ]
    return [n, plain, symbols, dup_lines, repeat], features


def base_failed(n_words, n_repeat_words):
    return (n_words < 20) | (100 * n_repeat_words > 30 * n_words)


def _usual_path(n):
    """Mean path of an unsuccessful search among n rows, by which paths are scaled."""
    n = np.asarray(n, dtype=np.float64)
    h = np.log(np.maximum(n - 1, 1)) + 0.5772156649015329
    return np.where(n > 2, 2 * h - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Trees as arrays: feature (or -1), cut, left child (the right one follows), a leaf's depth and its path."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    depth: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    scale: float
    threshold: float = np.inf

    def leaves(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """For each tree the leaves that the rows end in."""
        for root in self.roots:
            at = np.full(len(x), root)
            while True:
                f = self.feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[np.arange(len(x)), np.maximum(f, 0)] >= self.cut[at]
                at = np.where(inner, self.left[at] + right, at)
            yield at

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for at in self.leaves(x):
            total += self.path[at]
        return 2.0 ** (-total / (len(self.roots) * self.scale))


def tree_rows(n_usual: int, n_rest: int, subsample: int = SUBSAMPLE, others: float = OTHERS) -> tuple[int, int]:
    """How many usual rows and how many others a tree splits."""
    k_usual = min(subsample, n_usual)
    k_rest = min(n_rest, round(others * k_usual))
    return min(k_usual, max(subsample - k_rest, 1)), k_rest


def grow(x: np.ndarray, good: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, others: float = OTHERS, seed: int = SEED) -> Forest:
    """Trees of random splits, each on rows of which a share ``others`` at most is not good.

    So many others let splits reach beyond the range of good rows, and are too few to hide among themselves.
    """
    rng = np.random.default_rng(seed)
    usual, rest = (np.nonzero(good)[0], np.nonzero(~good)[0]) if good.any() else (np.arange(len(x)), np.empty(0, int))
    n_usual, n_rest = tree_rows(len(usual), len(rest), subsample, others)
    drawn = (x[np.concatenate((rng.choice(usual, n_usual, replace=False), rng.choice(rest, n_rest, replace=False)))] for _ in range(trees))
    return planted(drawn, n_usual + n_rest, rng)


def planted(drawn: Iterable[np.ndarray], size: int, rng: np.random.Generator) -> Forest:
    """A tree of random splits for each of the arrays, which have ``size`` rows."""
    deepest = int(np.ceil(np.log2(max(size, 2)))) + 4
    feature, cut, left, depths, path, roots = [], [], [], [], [], []

    def node():
        for a, v in ((feature, -1), (cut, 0.0), (left, 0), (depths, 0), (path, 0.0)):
            a.append(v)
        return len(feature) - 1

    for own in drawn:
        roots.append(node())
        todo = [(roots[-1], own, 0)]
        while todo:
            at, rows, depth = todo.pop()
            open_ = np.nonzero(rows.max(axis=0) > rows.min(axis=0))[0] if len(rows) > 1 else ()
            if depth >= deepest or not len(open_):
                depths[at], path[at] = depth, depth + float(_usual_path(len(rows)))
                continue
            f = int(rng.choice(open_))
            lo, hi = float(rows[:, f].min()), float(rows[:, f].max())
            c = float(rng.uniform(lo, hi))
            c = c if c > lo else hi
            a, b = node(), node()
            feature[at], cut[at], left[at] = f, c, a
            above = rows[:, f] >= c
            todo += [(a, rows[~above], depth + 1), (b, rows[above], depth + 1)]
    return Forest(np.array(feature), np.array(cut), np.array(left), np.array(depths), np.array(path), np.array(roots), max(float(_usual_path(size)), 1.0))


def leaf_counts(forest: Forest, x: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """How many of the other rows and of the usual ones end in each node."""
    out = np.zeros((2, len(forest.feature)), dtype=np.int64)
    for at in forest.leaves(x):
        for side in (0, 1):
            out[side] += np.bincount(at[usual == side], minlength=out.shape[1])
    return out


def fill(forest: Forest, counts: np.ndarray, n: tuple[int, int], k: tuple[int, int]) -> None:
    """Paths by the share of all rows that a leaf has: of the n others and usual rows, which count as the k that a tree splits."""
    mass = sum(c * (of / max(whole, 1)) for c, whole, of in zip(counts, n, k, strict=True))
    sizes = np.arange(1, max(sum(k), 1) + 1)
    forest.path = np.where(forest.feature < 0, forest.depth + np.interp(mass, sizes, _usual_path(sizes)), 0.0)


def calibrate(scores: np.ndarray, good: np.ndarray, false_rejects: float = FALSE_REJECTS) -> float:
    """The lowest threshold above which at most that share of the good rows lies."""
    if not len(scores) or good.all() or not good.any():
        return float("inf")
    ordered = np.sort(scores[good])[::-1]
    k = int(false_rejects * len(ordered))
    rest = np.sort(scores[~good])
    above = rest[rest > ordered[k]]
    return float((ordered[k] + above[0]) / 2) if len(above) else float("inf")


def agreed(labels: DataFrame, label: str = "quality") -> DataFrame:
    """_id and good (0 or 1) of the ids whose labels agree."""
    told = labels.where(f"doc_id is not null and {label} is not null").groupBy("doc_id").agg(F.min(label).alias("lo"), F.max(label).alias("hi")).where("lo = hi")
    return told.select(F.col("doc_id").alias("_id"), F.col("lo").cast("int").alias("good"))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, label: str = "quality") -> DataFrame:
    """doc_id, text and good (0 or 1) of at most ``rows`` labelled documents, those of the least hash."""
    chosen = agreed(labels, label).orderBy(F.xxhash64("_id"), "_id").limit(rows)
    return docs.select("doc_id", "text").join(small(chosen, rows), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "good")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, the struct ``stats`` (base statistics and features ``x``) and ``key``, a hash of id and text, of every row."""
    lean(docs.sparkSession)

    @F.pandas_udf(", ".join(f"{c} long" for c in BASE) + ", x array<double>")
    def measure(texts: pd.Series) -> pd.DataFrame:
        both = [statistics(t) for t in texts]
        out = pd.DataFrame([b for b, _ in both], columns=list(BASE), dtype="int64")
        out["x"] = [f for _, f in both]
        return out

    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), measure.asNondeterministic()(F.col("text").cast("binary")).alias("stats"))


def fitted(docs: DataFrame, labels: DataFrame) -> Forest:
    """The forest and threshold from all labelled rows."""
    return learnt(measured(docs), labels)


def learnt(rows: DataFrame, labels: DataFrame) -> Forest:
    """The forest and threshold from all labelled rows of those ``measured``."""
    scratch = Scratch(rows.sparkSession, "forest")
    passed = ~base_failed(F.col("stats.n_words"), F.col("stats.n_repeat_words"))  # the base rules decide on the others
    told = rows.select("doc_id", "key", passed.alias("passed"), "stats.x").join(agreed(labels), F.col("doc_id") == F.col("_id"))
    judges = F.xxhash64("doc_id").bitwiseAND(F.lit(1)) == 1
    halves = scratch.save(told.select("doc_id", "key", (F.col("good") == 1).alias("good"), judges.alias("judges"), "passed", "x").distinct(), "labelled")
    forest = grown(halves.where("not judges"))
    shared = rows.sparkSession.sparkContext.broadcast(forest)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"good": batch["good"], "bits": shared.value.scores(np.stack(batch["x"])).view(np.int64)})

    forest.threshold = threshold(scratch.save(halves.where("judges and passed").select("good", "x").mapInPandas(score, "good boolean, bits long"), "scores"))
    scratch.drop("")
    return forest


def _mixed(z: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit numbers, one to one."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def drawn_rows(rows: DataFrame, n: tuple[int, int], k: tuple[int, int], usual: str, trees: int = TREES, seed: int = SEED) -> list[np.ndarray]:
    """For each tree its own draw from all rows (key, x, good): the k others and usual ones of least hash with the tree's seed.

    Of the n rows of a side, those under a bound are sent, which by far more than chance allows are enough.
    """
    seeds = np.random.default_rng(seed).integers(0, 2**64, trees, dtype=np.uint64)
    bounds = np.array([min(2**64 - 1, int((of + 8 * of**0.5 + 32) / max(whole, 1) * 2.0**64)) if of else 0 for whole, of in zip(n, k, strict=True)], dtype=np.uint64)

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            h = _mixed(batch["key"].to_numpy().view(np.uint64)[:, None] ^ seeds[None, :])
            side = batch["usual"].to_numpy().astype(int)
            at, tree = np.nonzero(h <= bounds[side][:, None])
            yield pd.DataFrame({"tree": tree.astype(np.int32), "usual": side[at] == 1, "h": h[at, tree].view(np.int64), "x": batch["x"].to_numpy()[at]})

    found = rows.select("key", F.expr(usual).alias("usual"), "x").mapInPandas(pick, "tree int, usual boolean, h long, x array<double>").toArrow()
    tree, side, h = (found[c].to_numpy() for c in ("tree", "usual", "h"))
    x = found["x"].combine_chunks().flatten().to_numpy().reshape(len(tree), len(FEATURES))
    order = np.lexsort((*x.T, h.view(np.uint64)))
    return [np.concatenate([x[order[(tree[order] == t) & (side[order] == s)][: k[s]]] for s in (1, 0)]) for t in range(trees)]


def grown(rows: DataFrame, trees: int = TREES, seed: int = SEED) -> Forest:
    """A forest of all rows (key, x, good): trees split draws from them, leaves count them all."""
    lean(rows.sparkSession)
    found = {r.good: r["count"] for r in rows.groupBy("good").count().collect()}
    usual = "good" if found.get(True) else "not good"
    n = (found.get(False, 0), found[True]) if found.get(True) else (0, found.get(False, 0))
    if not sum(n):
        return Forest(np.array([-1]), np.zeros(1), np.zeros(1, int), np.zeros(1, int), np.zeros(1), np.array([0]), 1.0)
    k = tree_rows(n[1], n[0])[::-1]
    forest = planted(drawn_rows(rows, n, k, usual, trees, seed), sum(k), np.random.default_rng(seed))
    shared = rows.sparkSession.sparkContext.broadcast(forest)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, len(shared.value.feature)), dtype=np.int64)
        for batch in batches:
            if len(batch):
                total += leaf_counts(shared.value, np.stack(batch["x"]), batch["usual"].to_numpy().astype(int))
        at = np.nonzero(total.any(axis=0))[0]
        yield pd.DataFrame({"node": at, "others": total[0, at], "usual": total[1, at]})

    ends = rows.select(F.expr(usual).alias("usual"), "x").mapInPandas(count, "node long, others long, usual long")
    ends = ends.groupBy("node").agg(F.sum("others").alias("others"), F.sum("usual").alias("usual")).toArrow()
    counts = np.zeros((2, len(forest.feature)), dtype=np.int64)
    counts[:, ends["node"].to_numpy()] = ends["others"].to_numpy(), ends["usual"].to_numpy()
    fill(forest, counts, n, k)
    return forest


def threshold(scores: DataFrame, false_rejects: float = FALSE_REJECTS) -> float:
    """What ``calibrate`` gives, of all rows (good, bits): ``bits`` are a score's, which are ordered as scores are.

    The score of a rank is found 16 bits at a time, from counts of at most 65,536 kinds.
    """
    usual = scores.where("good").select("bits")
    n = usual.count()
    if not n:
        return float("inf")
    k, found = int(false_rejects * n), 0
    for shift in (48, 32, 16, 0):
        left = usual if shift == 48 else usual.where(F.shiftright("bits", shift + 16) == found)
        for r in sorted(left.groupBy(F.shiftright("bits", shift).alias("top")).count().collect(), reverse=True):
            if k < r["count"]:
                found = r["top"]
                break
            k -= r["count"]
    above = scores.where(~F.col("good") & (F.col("bits") > found)).agg(F.min("bits")).first()[0]
    return float("inf") if above is None else float(np.array([found, above], dtype=np.int64).view(np.float64).sum() / 2)


def fit(x: np.ndarray, good: np.ndarray, passed: np.ndarray) -> Forest:
    """The same of rows in memory: a forest of every second row, with its threshold from those between that ``passed`` the base rules."""
    if not len(x):
        return Forest(np.array([-1]), np.zeros(1), np.zeros(1, int), np.zeros(1, int), np.zeros(1), np.array([0]), 1.0)
    forest = grow(x[::2], good[::2])
    usual = good[::2] if good[::2].any() else ~good[::2]
    n = (int((~usual).sum()), int(usual.sum()))
    fill(forest, leaf_counts(forest, x[::2], usual), n, tree_rows(n[1], n[0])[::-1])
    judges = np.nonzero(passed)[0]
    judges = judges[judges % 2 == 1]
    forest.threshold = calibrate(forest.scores(x[judges]), good[judges])
    return forest


_RESULT = ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, kept boolean, score double"


def verdicts(out: pd.DataFrame, x: list, forest: Forest) -> pd.DataFrame:
    """Base statistics with what they and the forest say."""
    out["base_failed"] = base_failed(out["n_words"], out["n_repeat_words"]).astype(bool)
    out["score"] = forest.scores(np.array([*x]).reshape(len(out), len(FEATURES)))
    out["kept"] = ~out["base_failed"] & (out["score"] <= forest.threshold)
    return out[[*BASE, "base_failed", "kept", "score"]]


def judged(docs: DataFrame, forest: Forest, column: str = "_quality") -> DataFrame:
    """docs with a struct ``column``: the base statistics, base_failed, kept and the anomaly score."""
    lean(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(forest)  # a fixed number of trees and rows each

    @F.pandas_udf(_RESULT)
    def judge(texts: pd.Series) -> pd.DataFrame:
        both = [statistics(t) for t in texts]
        return verdicts(pd.DataFrame([b for b, _ in both], columns=list(BASE), dtype="int64"), [f for _, f in both], shared.value)

    return docs.withColumn(column, judge.asNondeterministic()(F.col("text").cast("binary")))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    return judged(packed(docs, "text"), fitted(docs, labels)).where("_quality.kept").select("_doc.*")


def judged_measures(rows: DataFrame, forest: Forest) -> DataFrame:
    """What ``judged`` gives, for rows that are ``measured`` already: doc_id and ``_quality``."""
    lean(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf(_RESULT)
    def judge(stats: pd.DataFrame) -> pd.DataFrame:
        return verdicts(stats[list(BASE)].copy(), [*stats["x"]], shared.value)

    return rows.select("doc_id", judge.asNondeterministic()("stats").alias("_quality"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rows = Scratch(spark, "quality").save(measured(docs), "rows")  # texts are read once
    return judged_measures(rows, learnt(rows, labels)).select("doc_id", "_quality.*")
