"""Words of whole texts as numpy spans over the Arrow buffers, and a few shared helpers."""

from __future__ import annotations

import ctypes
import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def bucket(column: str, n: int):
    """crc32 of the value as text, modulo n; a null counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def ascii_lower(data: np.ndarray) -> np.ndarray:
    """Lower-case the bytes A-Z; bytes above 127 stay, so UTF-8 stays valid."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data).astype(np.uint8)


class Spans:
    """Bytes of a text column and where its words ``[^\\x20\\x09-\\x0D]+`` lie.

    ``data`` holds all texts end to end, text i is data[offsets[i]:offsets[i+1]],
    its words are starts[first[i]:first[i+1]] to ends[...]. A null text has no bytes.
    """

    def __init__(self, texts: pa.Array):
        a = pc.fill_null(texts, "").cast(pa.large_string())
        offsets = np.frombuffer(a.buffers()[1], dtype=np.int64)[a.offset : a.offset + len(a) + 1] if len(a) else np.zeros(1, np.int64)
        raw = a.buffers()[2] if len(a) else None
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        self.data = data[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        word = ~((self.data == 32) | ((self.data >= 9) & (self.data <= 13)))
        before, after = np.zeros_like(word), np.zeros_like(word)
        before[1:], after[:-1] = word[:-1], word[1:]
        inner = self.offsets[(self.offsets > 0) & (self.offsets < len(word))]
        before[inner], after[inner - 1] = False, False
        self.starts = np.flatnonzero(word & ~before)
        self.ends = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.starts, self.offsets)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def words(self, lower: bool = False) -> list[bytes]:
        """All words, in order; words never hold white space, so one split finds them."""
        data = ascii_lower(self.data) if lower else self.data
        if len(self.offsets) > 2:  # a break between texts
            at = self.offsets[1:-1]
            data = np.insert(data, at, 32)
        return data.tobytes().split()


def one_row_batches(batches, limit: int = 4 << 20):
    """Arrow batches cut so that one holds about ``limit`` bytes, or a single longer row."""
    for batch in batches:
        n, size = batch.num_rows, max(1, batch.nbytes)
        step = max(1, n * limit // size)
        for at in range(0, n, step):
            yield batch.slice(at, step)


CACHES: list[dict] = []  # what modules keep in a worker from task to task


def forget(but: dict | None = None) -> None:
    """Drop what earlier stages keep in this worker; it would stay beside a stage that has no use for it."""
    for cache in CACHES:
        if cache is not but:
            cache.clear()


def release() -> None:
    """Give freed memory back to the system; a worker is kept for later tasks and would hold it beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def tidy(run):
    """``run``, a function for mapInArrow, which releases memory when its task is done."""

    @functools.wraps(run)
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


def without(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


class Numbers(dict):
    """Word -> number; a new word gets the next one and is noted in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list = []

    def __missing__(self, word) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number
