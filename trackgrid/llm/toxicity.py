"""Toxicity by a logistic classifier that is regularised with counterfactuals.

Features are the distinct words of a whole text and the beginnings of its words
(four to eight characters, marked ``^``), so that inflected words share what they teach. In each labelled text that
mentions a group, the group's term is swapped for others of its list; the loss
adds the squared change of the score's logit, so a mention as such moves no score.

The fit uses at most ``sample`` labelled rows of each class, chosen by hash of
doc_id, and the ``features`` words whose document counts in that sample differ
most between the classes (chi-squared), plus all group terms. Counting runs in
Spark; the driver receives the chosen words and one index list per sampled row.

Defined results: a null or empty text scores as the text without words; a
doc_id labelled twice teaches twice; without labels of both classes all scores
are the share of toxic labels (0 without any); repeated rows score alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackgrid.llm.words import one_row_batches
from trackgrid.session import cut

WORD = re.compile(r"[^\W\d_]+")
#: Lists of group terms that stand for each other.
GROUPS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "natives", "locals"),
    ("old", "young", "elderly", "teenage"),
    ("disabled", "deaf", "blind", "abled"),
)


BEGINNINGS = (4, 5, 6, 7, 8)
MOST_CACHED = 300_000


def parts(word: str) -> list[str]:
    return [word, *("^" + word[:k] for k in BEGINNINGS if len(word) > k)]


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


class Parts(dict):
    """Word -> its features that the model weighs."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> tuple[str, ...]:
        if len(self) > MOST_CACHED:
            self.clear()
        found = self[word] = tuple(f for f in parts(word) if f in self.weights)
        return found


@dataclass
class Model:
    weights: dict[str, float]
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        known, z = Parts(self.weights), np.full(len(texts), self.bias)
        for i, text in enumerate(texts):
            features = {f for found in filter(None, map(known.__getitem__, words_of(text))) for f in found}
            z[i] += sum(self.weights[f] for f in sorted(features))
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def swaps(words: set[str], groups=GROUPS) -> list[set[str]]:
    """The word sets with one group's mentioned terms swapped round its list."""
    out = []
    for group in groups:
        here = [g for g in group if g in words]
        if here:
            for step in range(1, len(group)):
                turned = {group[(group.index(g) + step) % len(group)] for g in here}
                out.append((words - set(here)) | turned)
    return out


def sampled(docs: DataFrame, labels: DataFrame, taught: Column, sample: int) -> tuple[DataFrame, float]:
    """A written table (y, words of the text) and the share of toxic labels."""
    rows = labels.select("doc_id", F.col("toxic").cast("int").alias("y")).filter(taught & F.col("y").isin(0, 1) & F.col("doc_id").isNotNull())
    count = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("toxic")).first()
    share = (count["toxic"] or 0) / max(1, count["n"])
    turn = F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxicity sample"))
    picked = [rows.filter(F.col("y") == y).orderBy(turn, "doc_id").limit(sample) for y in (0, 1)]
    # at most 2 * sample rows of two numbers
    few = F.broadcast(picked[0].unionByName(picked[1]))
    joined = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(few, "doc_id").select("y", "text")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_row_batches(batches):
            found = [sorted(words_of(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], names=["y", "words"])

    return cut(joined.mapInArrow(words, "y int, words array<string>"), "toxicity-sample"), share


def chosen(rows: DataFrame, features: int, least: float) -> list[str]:
    """The features with the largest chi-squared, at least ``least``."""
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)

    def features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_row_batches(batches):
            found = [sorted({f for w in ws for f in parts(w)}) for ws in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], names=["y", "found"])

    seen = rows.mapInArrow(features_of, "y int, found array<string>").select("y", F.explode("found").alias("word")).groupBy("word").agg(F.sum("y").alias("a"), F.count(F.lit(1)).alias("n"))
    a, b = F.col("a"), F.col("n") - F.col("a")
    c, d = F.lit(n1) - a, F.lit(n0) - b
    chi = ((a * d - b * c).cast("double") ** 2) * F.lit(float(n0 + n1)) / (((a + b) * (c + d)).cast("double") * F.lit(float(max(1, n0) * max(1, n1))) + 1)
    return [r["word"] for r in seen.withColumn("chi", chi).filter(F.col("chi") >= least).orderBy(F.col("chi").desc(), "word").limit(features).select("word").collect()]


def fit(
    docs: DataFrame, labels: DataFrame, taught: Column, groups=GROUPS, sample: int = 10_000, features: int = 2_000, least: float = 30.0,
    counterfactual: float = 1.0, ridge: float = 1e-5, rounds: int = 400,
) -> Model:
    rows, share = sampled(docs, labels, taught, sample)
    if not 0 < share < 1:
        return Model({}, 700.0 if share else -700.0)
    names = list(dict.fromkeys([*chosen(rows, features, least), *(t for g in groups for t in g)]))
    number = {w: i for i, w in enumerate(names)}

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pick = lambda ws: sorted({number[f] for w in ws for f in parts(w) if f in number})
        for batch in batches:
            sets = [set(ws) for ws in batch.column(1).to_pylist()]
            other = [[pick(s) for s in swaps(ws, groups)] for ws in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([pick(s) for s in sets], pa.list_(pa.int32())), pa.array(other, pa.list_(pa.list_(pa.int32())))], names=["y", "x", "swapped"])

    # at most 2 * sample rows; each lists chosen words only
    data = rows.mapInArrow(indexed, "y int, x array<int>, swapped array<array<int>>").collect()
    data.sort(key=lambda r: (r["y"], r["x"]))
    y = np.array([r["y"] for r in data], float)
    if not 0 < y.sum() < len(y):
        return Model({}, float(np.log(share / (1 - share))))
    x, row = flat([r["x"] for r in data])
    pairs = [(i, s) for i, r in enumerate(data) for s in r["swapped"]]
    base = np.array([i for i, _ in pairs], np.int64)
    sx, srow = flat([s for _, s in pairs])
    per = np.bincount(base, minlength=len(y))[base] if pairs else np.zeros(0)  # swaps of one text weigh together as one
    w, bias = np.zeros(len(names)), 0.0
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for step in range(1, rounds + 1):
        z = np.bincount(row, w[x], len(y)) + bias
        g = (1 / (1 + np.exp(-z)) - y) / len(y)
        grad = np.bincount(x, g[row], len(names)) + ridge * w
        if pairs:
            change = (z[base] - bias - np.bincount(srow, w[sx], len(pairs))) * counterfactual / (per * len(y))
            back = np.bincount(base, change, len(y))
            grad += np.bincount(x, back[row], len(names)) - np.bincount(sx, change[srow], len(names))
        grad = np.append(grad, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9) * (1 - (step - 1) / rounds)
        w, bias = w - move[:-1], bias - move[-1]
    drawn = y.mean()
    bias += np.log(share / (1 - share)) - np.log(drawn / (1 - drawn))  # the classes were drawn to their own limits
    return Model({n: float(a) for n, a in zip(names, w, strict=True) if a}, float(bias))


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(a) for a in lists], np.int64)
    return np.array([i for a in lists for i in a], np.int64), np.repeat(np.arange(len(lists)), sizes)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and predicted of every row."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_row_batches(batches):
            s = model.scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, score double, predicted int")
