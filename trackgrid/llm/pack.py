"""Packing documents into token windows by non-negative least squares.

A document's ids are those of a public byte-level BPE file, then an end id. Its
full windows become sequences of their own; what is left of it is a piece. Each
task gathers pieces until they hold ``chunk`` tokens, counts their lengths, lists
all combinations of two or three present lengths that fill a window, and solves
for their repeat counts against that histogram (non-negative least squares, by
accelerated projected gradient). The counts are rounded down, then single
repeats follow in the order of their fraction while pieces last; pieces left
over join the next chunk. At the end of the task the rest is packed greedily,
the longest first, cutting a piece where a window ends. The last window of a
task is cut at powers of two, which need no padding.

Every window is made inside one task from the rows it streams, so there is no
shuffle, and a retried task repeats the same windows. Memory is bounded by
``chunk`` tokens plus one document.

Defined results: a null text has only the end id; repeated rows are packed each;
an empty table gives no rows; sequence_id is unique over the table.
"""

from __future__ import annotations

import base64
import zlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackgrid.llm.words import CACHES, Numbers, one_row_batches, tidy

END = 1
SPECIAL = "<|endoftext|>"
MOST_CACHED = 150_000
OTHER_SPACE = re.compile(r"[^\S \n]")
ASCII_SPACE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x00"


class Bpe:
    """Ids of whole texts, each distinct space-led piece encoded once.

    The vocabulary's own split pattern always breaks before a single space and
    around a single newline, so such pieces encode apart; texts with any other
    white space are encoded whole, and texts that spell out the special token
    by the full tokenizer.
    """

    def __init__(self, json_path: str, rank_path: str, pattern: str):
        import tiktoken

        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.json_path, self.full = json_path, None
        self.bpe = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.line = self.bpe.encode_ordinary("\n")[0]
        self.clear()

    def clear(self) -> None:
        self.index = Numbers()
        self.flat = np.zeros(1 << 20, np.uint32)
        self.used = 0
        self.at, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        for piece in ("", "\n", " "):
            self.index[piece]
        self.index.new = []
        self._put(0, [])
        self._put(1, [self.line])
        self._put(2, self.bpe.encode_ordinary(" "))

    def _put(self, number: int, ids) -> None:
        self._room(number + 1, self.used + len(ids))
        self.at[number], self.size[number] = self.used, len(ids)
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def _room(self, pieces: int, ids: int) -> None:
        if pieces > len(self.at):
            self.at, self.size = (np.concatenate([x, np.zeros(max(len(x), pieces - len(x)), np.int64)]) for x in (self.at, self.size))
        if ids > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), ids - len(self.flat)), np.uint32)])

    def _learn(self) -> None:
        """Encode the new pieces in one call, parted by newlines, which no piece holds."""
        new = self.index.new
        if not new:
            return
        ids = np.asarray(self.bpe.encode_to_numpy("\n".join(new)), np.uint32)
        breaks = np.flatnonzero(ids == self.line)
        if len(breaks) != len(new) - 1:  # a piece's own white space swallowed a break
            for k, piece in enumerate(new):
                self._put(len(self.index) - len(new) + k, self.whole(piece))
            self.index.new = []
            return
        at = np.concatenate([[0], breaks + 1])
        size = np.concatenate([breaks, [len(ids)]]) - at
        first = len(self.index) - len(new)
        self._room(first + len(new), self.used + len(ids))
        self.at[first : first + len(new)], self.size[first : first + len(new)] = at + self.used, size
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.index.new = []

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """Numbers of pieces that hold no newline: ids are flat[at[number] : at[number] + size[number]]."""
        if len(self.index) > MOST_CACHED:
            self.clear()
        out = np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces))
        odd = [p for p in self.index.new if not self.plain(p) or p.endswith(" ")]
        self._learn()  # pieces with other white space come out wrong here and are put right
        for p in odd:
            self._put(self.index[p], self.whole(p))
        return out

    def whole(self, text: str) -> np.ndarray:
        if SPECIAL not in text:
            try:
                return np.asarray(self.bpe.encode_ordinary(text), np.uint32)
            except BaseException as failed:  # the pattern engine gives up on endless runs
                if isinstance(failed, (KeyboardInterrupt, SystemExit)):
                    raise
        if self.full is None:
            from tokenizers import Tokenizer

            self.full = Tokenizer.from_file(self.json_path)
        return np.asarray(self.full.encode(text, add_special_tokens=False).ids, np.uint32)

    @staticmethod
    def plain(text: str) -> bool:
        if "  " in text or " \n" in text or "\n " in text or "\n\n" in text or SPECIAL in text:
            return False
        return not any(c in text for c in ASCII_SPACE) if text.isascii() else not ("\x00" in text or OTHER_SPACE.search(text))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.index) > MOST_CACHED:
            self.clear()
        look, numbers, count = self.index.__getitem__, [], []
        for text in texts:
            if self.plain(text):
                pieces = text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00").split("\x00")
                numbers.append(np.fromiter(map(look, pieces), np.int64, len(pieces)))
                count.append(len(pieces))
            else:
                count.append(-1)
        self._learn()
        out = []
        plain = iter(numbers)
        for text, n in zip(texts, count, strict=True):
            if n < 0:
                out.append(self.whole(text))
                continue
            use = next(plain)
            sizes = self.size[use]
            to = np.cumsum(sizes)
            out.append(self.flat[np.repeat(self.at[use] - (to - sizes), sizes) + np.arange(to[-1] if len(to) else 0)])
        return out


_BPE: dict[tuple, Bpe] = {}
CACHES.append(_BPE)


def bpe(json_path: str, rank_path: str, pattern: str) -> Bpe:
    key = (json_path, rank_path)
    if key not in _BPE:
        _BPE[key] = Bpe(json_path, rank_path, pattern)
    return _BPE[key]


def forget() -> None:
    """Drop this worker's coders, which later steps do not need; a task that does makes its own."""
    _BPE.clear()


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """[n, 3]: two (with a 0) or three of the ascending ``lengths`` that fill the window."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    two = lengths[(lengths * 2 <= window) & there[window - lengths]]
    out = [np.stack([np.zeros_like(two), two, window - two], 1)]
    for a in lengths[lengths * 3 <= window]:
        b = lengths[(lengths >= a) & (lengths * 2 <= window - a)]
        c = window - a - b
        ok = there[c]
        out.append(np.stack([np.full(ok.sum(), a), b[ok], c[ok]], 1))
    return np.concatenate(out)


def repeats(combos: np.ndarray, counts: np.ndarray, steps: int = 40) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - counts|, A being how often a combination uses a length."""
    n, slots = len(combos), len(counts)
    counts = counts.astype(float)
    use = lambda x: np.bincount(combos.ravel(), np.repeat(x, 3), slots)
    back = lambda r: r[combos].sum(1)
    counts[0] = 0
    v = np.random.default_rng(0).random(n)
    for _ in range(8):  # the largest eigenvalue gives the step
        r = use(v)
        r[0] = 0
        v = back(r)
        top = np.linalg.norm(v)
        v /= top or 1
    x = y = np.zeros(n)
    t = 1.0
    for _ in range(steps):
        r = counts - use(y)
        r[0] = 0
        nxt = np.maximum(0, y + back(r) / (top * 1.05 or 1))
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = nxt + (t - 1) / t2 * (nxt - x)
        x, t = nxt, t2
    return x


class Packer:
    """Pieces in, (piece, sequence, offset) out."""

    def __init__(self, window: int, chunk: int):
        self.window, self.chunk = window, chunk
        self.pool: dict[int, list] = {}
        self.held, self.new, self.next = 0, 0, 0
        self.out: list[tuple] = []  # (piece, sequence, offset)

    def sequence(self) -> int:
        self.next += 1
        return self.next - 1

    def add(self, piece: tuple) -> None:
        """piece: (row, start, ids)."""
        n = len(piece[2])
        if n == self.window:
            self.out.append((piece, self.sequence(), 0))
            return
        self.pool.setdefault(n, []).append(piece)
        self.held += n
        self.new += n
        if self.new >= self.chunk:
            self.solve()

    def _emit(self, pieces: list[tuple]) -> None:
        number, at = self.sequence(), 0
        for p in pieces:
            self.out.append((p, number, at))
            at += len(p[2])
            self.held -= len(p[2])

    def solve(self) -> None:
        self.new = 0
        lengths = np.array(sorted(n for n, v in self.pool.items() if v), np.int64)
        combos = combinations(lengths, self.window) if len(lengths) else np.zeros((0, 3), np.int64)
        if not len(combos):
            return
        counts = np.zeros(self.window + 1, np.int64)
        counts[lengths] = [len(self.pool[n]) for n in lengths.tolist()]
        x = repeats(combos, counts)
        order = np.argsort(-x, kind="stable")
        for rounded in (np.floor(x), (x > 0).astype(int)):
            for k in order.tolist():
                times = int(rounded[k])
                if not times:
                    continue
                use = [n for n in combos[k].tolist() if n]
                for _ in range(times):
                    if any(len(self.pool[n]) < use.count(n) for n in use):
                        break
                    self._emit([self.pool[n].pop() for n in use])

    def finish(self) -> None:
        """Longest first; where nothing whole fills the gap, the next piece is cut there."""
        self.solve()
        rest = sorted((p for v in self.pool.values() for p in v), key=lambda p: (-len(p[2]), p[0], p[1]))
        self.pool, gap, here = {}, self.window, []
        by_length: dict[int, list] = {}
        for p in reversed(rest):
            by_length.setdefault(len(p[2]), []).append(p)
        lengths = sorted(by_length)
        total = sum(len(p[2]) for p in rest)

        def pop(n: int) -> tuple:
            p = by_length[n].pop()
            if not by_length[n]:
                del by_length[n]
                lengths.remove(n)
            return p

        def push(p: tuple) -> None:
            n = len(p[2])
            if n not in by_length:
                by_length[n] = []
                lengths.append(n)
                lengths.sort()
            by_length[n].append(p)

        def part(p: tuple, n: int) -> tuple[tuple, tuple]:
            return (p[0], p[1], p[2][:n]), (p[0], p[1] + n, p[2][n:])

        while total:
            room = self.window if total >= self.window else 1 << (total.bit_length() - 1)
            gap, here = room, []
            while gap:
                fits = [n for n in lengths if n <= gap]
                if fits:
                    here.append(pop(fits[-1]))
                else:
                    head, tail = part(pop(lengths[0]), gap)
                    push(tail)
                    here.append(head)
                gap -= len(here[-1][2])
            total -= room
            self._emit(here)


def pack(
    docs: DataFrame, json_path: str, rank_path: str, pattern: str, window: int = 2048, chunk: int = 4_000_000, with_ids: bool = True
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, the piece's ids."""
    kind = dict(docs.dtypes)["doc_id"]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, packer = bpe(json_path, rank_path, pattern), Packer(window, chunk)
        base = TaskContext.get().partitionId() << 36
        rows: dict[int, tuple] = {}  # open rows: doc_id, tokens, tokens not yet placed
        number = 0
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

        def flush() -> Iterator[pa.RecordBatch]:
            out, packer.out = packer.out, []
            if not out:
                return
            doc, tokens = [], []
            for (row, _, ids), _, _ in out:
                i, n, left = rows[row]
                doc.append(i)
                tokens.append(n)
                if left == len(ids):
                    del rows[row]
                else:
                    rows[row] = (i, n, left - len(ids))
            ids = [p[2].astype("<u4") for p, _, _ in out]
            long = lambda x: pa.array(x, pa.int64())
            columns = [
                pa.array(doc, id_type), long([p[1] for p, _, _ in out]), long([len(x) for x in ids]), long([zlib.crc32(x.tobytes()) for x in ids]),
                long(tokens), long([base | s for _, s, _ in out]), long([o for _, _, o in out]),
            ]
            if with_ids:
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names=names + ["ids"] * with_ids)

        for batch in one_row_batches(batches, 2 << 20):
            id_type = batch.column(0).type
            for doc, ids in zip(batch.column(0).to_pylist(), coder.encode([t or "" for t in batch.column(1).to_pylist()]), strict=True):
                ids = np.append(ids, np.uint32(END))
                rows[number] = (doc, len(ids), len(ids))
                for at in range(0, len(ids), window):
                    packer.add((number, at, ids[at : at + window].copy()))
                number += 1
            yield from flush()
        packer.finish()
        yield from flush()

    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids array<int>" * with_ids
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
