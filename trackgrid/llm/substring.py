"""Substring deduplication with difference-cover anchors.

A window is ``window`` consecutive words. Positions modulo ``period`` that lie in
the difference cover ``cover`` bear anchors: hashes of the next window - period + 1
words. For any two starts some shift below the period brings both onto the
cover, so equal windows share an aligned anchor. Only windows that extend an
anchor found more than once are compared, by 80 bits of the whole window's hash.

Documents stand in units of whole documents (compressed, bucketed by unit), and
three passes over them exchange messages with buckets of the hash range:

1. every unit sends its distinct anchors; a bucket answers which ones several units sent;
2. every unit sends the distinct windows that hold such an anchor (or one that
   repeats inside the unit) with the smallest doc_id it has for each; a bucket
   answers which ones some other unit has with a smaller doc_id;
3. every unit marks its windows, answered or beaten inside the unit, and removes their words.

A unit sends a hash once however often it repeats, so one passage in a third of
all documents costs a message per unit. Units and buckets are of bounded size
and their numbers grow with the input.

Defined results: a null text has no words; a null doc_id neither covers nor is
covered; rows of the same doc_id do not cover each other; repeats inside one
document do not either; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackgrid.llm.words import Spans, ascii_lower, one_row_batches

#: A perfect difference set: every residue modulo 7 is a difference of two of its members.
PERIOD, COVER = 7, (0, 1, 3)
UNIT = 4 << 20  # bytes of text in a unit, or one longer document
BUCKET = 32 << 20  # bytes of messages in a bucket
UNIT_SCHEMA = "unit long, words long, docs binary, sizes binary, texts binary"
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
MIX = np.uint64(0xFF51AFD7ED558CCD)


def units(docs: DataFrame, size: int) -> DataFrame:
    """Rows of whole documents: their ids (with a null mark), text sizes and compressed texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0
        pack = zstandard.ZstdCompressor(level=6)
        ids, texts, held, words = [], [], 0, 0

        def row() -> pa.RecordBatch:
            known = np.array([i is not None for i in ids], np.int64)
            doc = np.array([0 if i is None else i for i in ids], np.int64)
            sizes = np.array([len(t) for t in texts], np.int64)
            values = [base | number, words, np.stack([known, doc]).tobytes(), sizes.tobytes(), pack.compress(b"".join(texts))]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=["unit", "words", "docs", "sizes", "texts"])

        for batch in one_row_batches(batches, size):
            spans = Spans(batch.column(1))
            data, ends, counts = spans.data.tobytes(), spans.offsets.tolist(), spans.counts().tolist()
            for k, i in enumerate(batch.column(0).to_pylist()):
                if ids and held + ends[k + 1] - ends[k] > size:
                    yield row()
                    number, ids, texts, held, words = number + 1, [], [], 0, 0
                ids.append(i)
                texts.append(data[ends[k] : ends[k + 1]])
                held += ends[k + 1] - ends[k]
                words += counts[k]
        if ids:
            yield row()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, UNIT_SCHEMA)


class Unit:
    """A unit's documents, words and hashes."""

    def __init__(self, docs: bytes, sizes: bytes, texts: bytes, window: int, lower: bool = False):
        self.window = window
        known, self.doc = np.frombuffer(docs, np.int64).reshape(2, -1)
        self.known = known.astype(bool)
        ends = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, np.int64))])
        data = zstandard.ZstdDecompressor().decompress(texts) if ends[-1] else b""
        data = ascii_lower(np.frombuffer(data, np.uint8)).tobytes() if lower else data
        self.spans = Spans(pa.LargeStringArray.from_buffers(len(self.doc), pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(data)))
        s = self.spans
        self.row = np.repeat(np.arange(len(self.doc)), s.counts())
        self.at = np.arange(len(s.starts)) - s.first[:-1][self.row]
        self.left = s.counts()[self.row] - self.at
        self.hashes = self._words()

    def _words(self) -> list[np.ndarray]:
        """Hashes per word, for each base: a polynomial over its bytes."""
        s = self.spans
        size = s.ends - s.starts
        if not len(size):
            return [np.zeros(0, np.uint64) for _ in BASES]
        data = s.data[~((s.data == 32) | ((s.data >= 9) & (s.data <= 13)))]  # words end to end
        first = np.cumsum(size) - size
        kind = np.int32 if len(data) < 2**31 else np.int64
        inner = np.arange(len(data), dtype=kind)
        inner -= np.repeat(first.astype(kind), size)
        out = []
        for base in BASES:
            power = np.full(int(size.max()), base, np.uint64)
            power[0] = 1
            term = np.cumprod(power, dtype=np.uint64)[inner]
            term *= data + np.uint64(1)
            h = np.add.reduceat(term, first)
            h = (h ^ (h >> np.uint64(33))) * MIX
            out.append(h ^ (h >> np.uint64(29)))
        return out

    def runs(self, which: int, n: int) -> np.ndarray:
        """The hash of the n words from each word on; only meaningful where ``left >= n``."""
        h, base = np.zeros(len(self.at), np.uint64), np.uint64(BASES[which])
        words = self.hashes[which]
        for j in range(min(n, len(h))):
            h[: len(h) - j] = h[: len(h) - j] * base + words[j:]
        h = (h ^ (h >> np.uint64(32))) * MIX
        return h ^ (h >> np.uint64(29))

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions that bear an anchor, and the hashes."""
        n = self.window - PERIOD + 1
        at = np.flatnonzero((self.left >= n) & np.isin(self.at % PERIOD, COVER) & self.known[self.row])
        return at, self.runs(0, n)[at]

    def windows(self, at: np.ndarray) -> np.ndarray:
        """Keys of the windows from these words on, as (64 bits, 16 bits)."""
        out = np.zeros(len(at), [("a", np.uint64), ("b", np.uint16)])
        out["a"], out["b"] = self.runs(0, self.window)[at], (self.runs(1, self.window)[at] >> np.uint64(48)).astype(np.uint16)
        return out

    def candidates(self, shared: np.ndarray) -> np.ndarray:
        """Starts of the windows that hold an anchor that is shared or repeats here."""
        at, h = self.anchors()
        values, back, count = np.unique(h, return_inverse=True, return_counts=True)
        hit = at[((count > 1) | np.isin(values >> np.uint64(24), shared))[back]]
        mark = np.zeros(len(self.at), bool)
        for shift in range(PERIOD):
            start = hit - shift
            start = start[(start >= 0) & (self.at[hit] >= shift)]
            mark[start] = True
        return np.flatnonzero(mark & (self.left >= self.window))


def _table(schema: dict, **columns) -> pa.Table:
    return pa.table({k: pa.array(columns[k], t) for k, t in schema.items()})


MESSAGE = {"bucket": pa.int64(), "unit": pa.int64(), "payload": pa.binary()}
MESSAGE_SCHEMA = "bucket long, unit long, payload binary"
KEY = np.dtype([("a", np.uint64), ("b", np.uint16)])  # 10 bytes, not padded


def unit_of(table: pa.Table, window: int, lower: bool = False) -> tuple[int, Unit]:
    r = {k: table.column(k)[0].as_py() for k in ("unit", "docs", "sizes", "texts")}
    return r["unit"], Unit(r["docs"], r["sizes"], r["texts"], window, lower)


def answers(table: pa.Table) -> list[bytes]:
    return [p for p in table.column("payload").to_pylist() if p] if table.num_rows else []


def low40(h: np.ndarray) -> bytes:
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def from40(payload: bytes) -> np.ndarray:
    out = np.zeros((len(payload) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(payload, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def by_bucket(unit: int, bucket: np.ndarray, payload) -> pa.Table:
    """One message per bucket; ``bucket`` ascends and payload(lo, hi) packs a stretch."""
    names, first = np.unique(bucket, return_index=True)
    ends = [*first[1:].tolist(), len(bucket)][: len(names)]
    return _table(MESSAGE, bucket=names.tolist(), unit=[unit] * len(names), payload=[payload(a, b) for a, b in zip(first.tolist(), ends, strict=True)])


def landed(docs: DataFrame, size: int = UNIT) -> DataFrame:
    """The units as a table bucketed by unit, so that answers join them without moving texts again."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"document_units_{uuid.uuid4().hex}"
    units(docs, size).repartition(partitions, "unit").write.bucketBy(partitions, "unit").option("compression", "none").format("parquet").saveAsTable(name)
    return spark.table(name)


def bucket_bits(total_bytes: int) -> int:
    """Bits of the hash that name a bucket of about BUCKET bytes; at least 16 buckets."""
    return max(4, int(np.ceil(np.log2(max(1, total_bytes // BUCKET)))))


def remove(docs: DataFrame, window: int = 13, unit_size: int = UNIT) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the remaining words, joined by one space, as bytes)."""
    held = landed(docs, unit_size)
    words = held.agg(F.sum("words")).first()[0] or 0
    bits, wide = bucket_bits(words * len(COVER) * 5 // PERIOD), bucket_bits(words * 13 // 2)

    def send_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                number, unit = unit_of(pa.Table.from_batches([batch.slice(k, 1)]), window)
                h = np.unique(unit.anchors()[1] >> np.uint64(24))
                yield from by_bucket(number, (h >> np.uint64(40 - bits)).astype(np.int64), lambda a, b, h=h: low40(h[a:b])).to_batches()

    def shared(table: pa.Table) -> pa.Table:
        sent = [from40(p) for p in table.column("payload").to_pylist()]
        values, count = np.unique(np.concatenate(sent), return_counts=True)
        several = values[count > 1]
        back = [low40(h[np.isin(h, several, assume_unique=True)]) for h in sent]
        return _table(MESSAGE, bucket=table.column("bucket").to_pylist(), unit=table.column("unit").to_pylist(), payload=back)

    def send_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _table(MESSAGE, bucket=[], unit=[], payload=[])
        number, unit = unit_of(left, window)
        told = answers(right)
        at = unit.candidates(np.sort(np.concatenate([from40(p) for p in told])) if told else np.zeros(0, np.uint64))
        key, doc = unit.windows(at), unit.doc[unit.row[at]]
        order = np.lexsort((doc, key["b"], key["a"]))
        key, doc = key[order], doc[order]
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        key, doc = key[first], doc[first]
        names, place = np.unique(doc, return_inverse=True)

        def payload(a: int, b: int) -> bytes:
            here, local = np.unique(place[a:b], return_inverse=True)
            return np.int64(len(here)).tobytes() + names[here].tobytes() + key[a:b].tobytes() + local.astype(np.uint32 if len(here) > 65535 else np.uint16).tobytes()

        return by_bucket(number, (key["a"] >> np.uint64(64 - wide)).astype(np.int64), payload)

    def beaten(table: pa.Table) -> pa.Table:
        keys, docs_ = [], []
        for p in table.column("payload").to_pylist():
            n = int(np.frombuffer(p, np.int64, 1)[0])
            names = np.frombuffer(p, np.int64, n, 8)
            kind = np.uint32 if n > 65535 else np.uint16
            count = (len(p) - 8 - 8 * n) // (KEY.itemsize + np.dtype(kind).itemsize)
            keys.append(np.frombuffer(p, KEY, count, 8 + 8 * n))
            docs_.append(names[np.frombuffer(p, kind, count, 8 + 8 * n + KEY.itemsize * count)])
        sizes = [len(k) for k in keys]
        key, doc = np.concatenate(keys), np.concatenate(docs_)
        order = np.lexsort((doc, key["b"], key["a"]))
        sa, sb = key["a"][order], key["b"][order]
        first = np.ones(len(order), bool)
        first[1:] = (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])
        least = doc[order][first][np.cumsum(first) - 1]
        lost = np.zeros(len(order), bool)
        lost[order] = doc[order] > least
        back, at = [], 0
        for k, n in zip(keys, sizes, strict=True):
            back.append(k[lost[at : at + n]].tobytes())
            at += n
        return _table(MESSAGE, bucket=table.column("bucket").to_pylist(), unit=table.column("unit").to_pylist(), payload=back)

    result = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept": pa.binary()}

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _table(result, doc_id=[], n_words=[], n_removed=[], kept=[])
        _, unit = unit_of(left, window)
        at = np.flatnonzero((unit.left >= window) & unit.known[unit.row])
        key, doc = unit.windows(at), unit.doc[unit.row[at]]
        order = np.lexsort((doc, key["b"], key["a"]))
        a, b = key["a"][order], key["b"][order]
        first = np.ones(len(order), bool)
        first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        group = np.cumsum(first) - 1
        lost = doc[order] > doc[order][first][group] if len(order) else np.zeros(0, bool)
        told = answers(right)
        if told:
            away = np.frombuffer(b"".join(told), KEY)
            away = away[np.lexsort((away["b"], away["a"]))]
            ga, gb = a[first], b[first]
            lo = np.searchsorted(away["a"], ga)
            hit = np.zeros(len(ga), bool)
            for step in range(4):  # equal 64 bits with other 16 bits stand side by side
                k = np.minimum(lo + step, len(away) - 1)
                hit |= (away["a"][k] == ga) & (away["b"][k] == gb)
            lost = lost | hit[group]
        edge = np.zeros(len(unit.at) + window + 1, np.int64)
        starts = at[order[lost]]
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + window, -1)
        gone = np.cumsum(edge)[: len(unit.at)] > 0
        words, counts = unit.spans.words(), unit.spans.counts()
        removed = np.bincount(unit.row[gone], minlength=len(unit.doc))
        ends, kept = unit.spans.first.tolist(), []
        for r in range(len(unit.doc)):
            here = words[ends[r] : ends[r + 1]]
            if removed[r]:
                here = [w for w, g in zip(here, gone[ends[r] : ends[r + 1]].tolist(), strict=True) if not g]
            kept.append(b" ".join(here))
        ids = [i if k else None for i, k in zip(unit.doc.tolist(), unit.known.tolist(), strict=True)]
        return _table(result, doc_id=ids, n_words=counts, n_removed=removed, kept=kept)

    anchors = held.select("unit", "docs", "sizes", "texts").mapInArrow(send_anchors, MESSAGE_SCHEMA)
    first = anchors.groupBy("bucket").applyInArrow(shared, MESSAGE_SCHEMA)
    sent = held.groupBy("unit").cogroup(first.groupBy("unit")).applyInArrow(send_windows, MESSAGE_SCHEMA)
    second = sent.groupBy("bucket").applyInArrow(beaten, MESSAGE_SCHEMA)
    return held.groupBy("unit").cogroup(second.groupBy("unit")).applyInArrow(finish, "doc_id long, n_words long, n_removed long, kept binary")
