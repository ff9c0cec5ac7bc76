"""Language identification by unigrams summed over all segmentations.

The pieces of a fixed public vocabulary have one probability per language. A
word's probability is the sum over every way to cut it into pieces, by the
forward algorithm; a text's is the product over its words, so the words of a
batch are scored once each. Piece probabilities are fitted by expectation
maximisation: the forward-backward pass gives each piece's expected count.

The fit uses at most ``sample`` labelled documents per language, chosen by hash
of doc_id; their words are counted by Spark, the passes run on the counts, and
the driver receives a number per language and piece. More than
``MOST_LANGUAGES`` labels are refused, which bounds the model that travels.

Defined results: a null text or one without a letter is ``und`` with score 0;
rows without a label teach nothing; without any labelled row all texts are
``und``; repeated rows are judged each on their own; whole texts are read.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trackgrid.llm.words import CACHES, Numbers, forget, one_row_batches, tidy
from trackgrid.session import cut

MOST_LANGUAGES = 256
MOST_CACHED = 60_000
LONGEST_TAUGHT = 64  # characters of a word the fit learns from
LETTERS = re.compile(r"[^\W\d_]+")
MARK = "▁"
BASE = np.uint64(0x9E3779B97F4A7C15)


def read_pieces(model_path: str) -> list[str]:
    """The vocabulary's ordinary pieces, in order."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return [sp.id_to_piece(i) for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


def coded(words: list[str]) -> np.ndarray:
    """[words, characters] code points of words of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint64)


class Lattice:
    """Looks up pieces by a rolling hash of their characters; number V stands for an unknown character."""

    def __init__(self, pieces: list[str]):
        by_length: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            by_length.setdefault(len(p), []).append(i)
        self.unknown, self.longest = len(pieces), max(by_length, default=1)
        hashes, numbers = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for ids in by_length.values():
            codes = coded([pieces[i] for i in ids])
            h = np.zeros(len(ids), np.uint64)
            for column in codes.T:
                h = h * BASE + column
            hashes.append(h)
            numbers.append(np.array(ids, np.int64))
        hashes, numbers = np.concatenate(hashes), np.concatenate(numbers)
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], numbers[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.hashes >> np.uint64(44)).astype(np.int64)] = True

    def edges(self, codes: np.ndarray):
        """For each end j, the (start i, rows, piece numbers) that end there."""
        n = codes.shape[1]
        rolling: list[np.ndarray] = []
        for j in range(1, n + 1):
            rolling = [h * BASE + codes[:, j - 1] for h in rolling[-(self.longest - 1) :]] if self.longest > 1 else []
            rolling.append(codes[:, j - 1].copy())
            here = []
            for k, h in enumerate(reversed(rolling), 1):
                rows = np.flatnonzero(self.maybe[(h >> np.uint64(44)).astype(np.int64)])
                at = np.searchsorted(self.hashes, h[rows])
                at[at == len(self.hashes)] = 0
                ok = self.hashes[at] == h[rows] if len(self.hashes) else np.zeros(len(rows), bool)
                rows, numbers = rows[ok], self.numbers[at[ok]] if len(self.hashes) else rows[ok]
                if k == 1 and len(rows) < len(codes):
                    lost = np.setdiff1d(np.arange(len(codes)), rows, assume_unique=True)
                    rows, numbers = np.concatenate([rows, lost]), np.concatenate([numbers, np.full(len(lost), self.unknown)])
                if len(rows):
                    here.append((j - k, rows, numbers))
            yield j, here

    def forward(self, codes: np.ndarray, p: np.ndarray) -> np.ndarray:
        """[words, languages] log probability of words of one length, all segmentations summed."""
        m, n = codes.shape
        window = {0: np.ones((m, p.shape[1]))}
        scale = np.zeros((m, p.shape[1]))
        for j, here in self.edges(codes):
            now = np.zeros((m, p.shape[1]))
            for i, rows, numbers in here:
                now[rows] += window[i][rows] * p[numbers]
            window[j] = now
            window.pop(j - self.longest, None)
            if j % 12 == 0:  # keep the numbers in range
                top = np.maximum.reduce(list(window.values()))
                scale += np.log(top)
                for i in window:
                    window[i] = window[i] / top
        return scale + np.log(window[n])

    def expected(self, codes: np.ndarray, weight: np.ndarray, p: np.ndarray) -> np.ndarray:
        """[pieces + 1] expected piece counts of words of one length under one language's ``p``."""
        m, n = codes.shape
        ends = list(self.edges(codes))
        alpha, beta = np.zeros((n + 1, m)), np.zeros((n + 1, m))
        alpha[0] = beta[n] = 1
        for j, here in ends:
            for i, rows, numbers in here:
                alpha[j, rows] += alpha[i, rows] * p[numbers]
        for j, here in reversed(ends):
            for i, rows, numbers in here:
                beta[i, rows] += beta[j, rows] * p[numbers]
        out = np.zeros(len(p))
        share = weight / np.maximum(alpha[n], 1e-300)
        for j, here in ends:
            for i, rows, numbers in here:
                np.add.at(out, numbers, alpha[i, rows] * p[numbers] * beta[j, rows] * share[rows])
        return out


def by_length(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        out.setdefault(len(w), []).append(i)
    return out


@dataclass
class Model:
    languages: list[str]
    p: np.ndarray  # [pieces + 1, languages]
    lattice: Lattice
    key: str


class Scorer:
    """Scores words once; holds at most ``MOST_CACHED`` between batches."""

    def __init__(self, model: Model):
        self.model = model
        self.index, self.rows = Numbers(), np.zeros((1 << 14, len(model.languages)))

    def numbers(self, words: list[str]) -> np.ndarray:
        found = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        new, self.index.new = self.index.new, []
        if new:
            if len(self.index) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros((max(len(self.rows), len(self.index) - len(self.rows)), self.rows.shape[1]))])
            first = len(self.index) - len(new)
            for ids in by_length(new).values():
                for at in range(0, len(ids), 8192):
                    some = ids[at : at + 8192]
                    self.rows[first + np.array(some)] = self.model.lattice.forward(coded([MARK + new[i] for i in some]), self.model.p)
        return found

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """[texts, languages] log probabilities and whether there is a letter."""
        if len(self.index) > MOST_CACHED:
            self.index, self.rows = Numbers(), self.rows[: 1 << 14].copy()
        words = [LETTERS.findall(t.lower()) if t else [] for t in texts]
        numbers = self.numbers([w for ws in words for w in ws])
        ends = np.cumsum([0, *map(len, words)])
        sums = np.zeros((len(texts), self.rows.shape[1]))
        full = np.flatnonzero(np.diff(ends))
        if len(full):
            sums[full] = np.add.reduceat(self.rows[numbers], ends[full], axis=0)
        letter = np.array([bool(ws) and (any(map(str.isalpha, ws)) or any(map(str.isalpha, t))) for ws, t in zip(words, texts, strict=True)], bool)
        return sums, letter


_SCORERS: dict[str, Scorer] = {}
CACHES.append(_SCORERS)


def scorer(model: Model) -> Scorer:
    if model.key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[model.key] = Scorer(model)
    return _SCORERS[model.key]


def alone() -> None:
    """Drop what other stages keep in this worker."""
    forget(_SCORERS)


def taught_words(docs: DataFrame, taught: Column, sample: int) -> tuple[list[str], DataFrame]:
    """The labels, and a written table (language, word, n) of the sample."""
    rows = docs.filter(taught & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("string").alias("id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(sizes)
    if not languages:
        return [], docs.sparkSession.createDataFrame([], "lang int, word string, n long")
    limit = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, 1.5 * sample / sizes[k]))])
    turn = F.xxhash64("id", F.lit("language sample"))
    thin = rows.withColumn("turn", turn).filter(F.pmod("turn", F.lit(1 << 30)) < F.element_at(limit, F.col("lang")) * F.lit(float(1 << 30)))
    first = thin.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("turn", "id"))).filter(F.col("rank") <= sample)
    number = {k: i for i, k in enumerate(languages)}

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_row_batches(batches):
            found: Counter = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.update((number[lang], w) for w in LETTERS.findall(text.lower()) if len(w) <= LONGEST_TAUGHT)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([k[0] for k in found], pa.int32()), "word": pa.array([k[1] for k in found], pa.string()), "n": pa.array(list(found.values()), pa.int64())
            })

    words = first.select("lang", "text").mapInArrow(count, "lang int, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    return languages, cut(words, "language-words")


def fit(docs: DataFrame, model_path: str, taught: Column, sample: int = 1500, rounds: int = 3, smooth: float = 0.05) -> Model:
    pieces = read_pieces(model_path)
    lattice = Lattice(pieces)
    languages, words = taught_words(docs, taught, sample)
    size = len(pieces) + 1
    p = np.full((size, max(1, len(languages))), 1.0 / size)

    def pass_over(p: np.ndarray) -> np.ndarray:
        @tidy
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(p.shape)
            for batch in batches:
                langs, texts, ns = batch.column(0).to_numpy(), batch.column(1).to_pylist(), batch.column(2).to_numpy().astype(float)
                for lang in np.unique(langs):
                    mine = np.flatnonzero(langs == lang)
                    own = [MARK + texts[i] for i in mine]
                    for ids in by_length(own).values():
                        for at in range(0, len(ids), 4096):
                            some = ids[at : at + 4096]
                            total[:, lang] += lattice.expected(coded([own[i] for i in some]), ns[mine[some]], p[:, lang])
            piece, lang = np.nonzero(total)
            yield pa.RecordBatch.from_pydict({"lang": pa.array(lang.astype(np.int32)), "piece": pa.array(piece.astype(np.int32)), "n": pa.array(total[piece, lang])})

        rows = words.mapInArrow(run, "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toArrow()
        counts = np.full(p.shape, smooth)
        counts[rows["piece"].to_numpy(), rows["lang"].to_numpy()] += rows["n"].to_numpy()
        return counts / counts.sum(0)

    for _ in range(rounds if languages else 0):
        p = pass_over(p)
    return Model(languages, p, lattice, uuid.uuid4().hex)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The rows with ``__lang`` and ``__score`` (the best language's share of the posterior)."""
    from pyspark.sql import types as T

    at = docs.columns.index("text")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone()
        for batch in one_row_batches(batches, 1 << 20):
            texts = batch.column(at).to_pylist()
            if model.languages:
                logs, letter = scorer(model).texts(texts)
                best = logs.argmax(1)
                share = 1 / np.exp(logs - logs.max(1, keepdims=True)).sum(1)
                lang = [model.languages[b] if ok else "und" for b, ok in zip(best, letter, strict=True)]
                score = np.where(letter, share, 0.0)
            else:
                lang, score = ["und"] * len(texts), np.zeros(len(texts))
            yield batch.append_column("__lang", pa.array(lang, pa.string())).append_column("__score", pa.array(score, pa.float64()))

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("__lang", T.StringType()), T.StructField("__score", T.DoubleType())]))
