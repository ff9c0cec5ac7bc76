"""Periodic runs of words, by a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) whose length is at least max(LEAST, TIMES * q) and which no
neighbouring word extends keeping period q. A text collapses when every word
that a run contains after its first q words goes.

The method. Words are appended to a suffix automaton one by one. Its link tree
is held as preferred paths in splay trees (a link-cut tree); all states of a
path share the place where their strings last ended, its colour. Appending word
i accesses the new prefix: the path from its state to the root takes colour i,
and each path segment met on the way, with deepest string length m and colour c,
tells that the last m words end at c too. If d = i - c <= m, two copies of d
words end at i: a square. As c is the last end, d is the smallest period of it.
The square is extended by comparing words d apart, which gives the run; squares
of a run already known for d are skipped.

What reaches the automaton. A run of period q holds, after its first q words, at
least (TIMES - 1) * q consecutive words whose previous equal word lies at most q
back; the same holds for its word 8-grams when q > 8. Stretches that meet this
for some power of two Q (q in (Q/2, Q]) are found with numpy for a whole batch;
each one, merged with those it touches, is appended to an automaton of its own,
and its squares are extended over the whole text. Such a stretch holds at least
3 q words of the run and so a square of it; the condition is necessary (hash
collisions of 8-grams only add stretches). No run is lost, and ordinary prose
never enters the Python loop.

Defined results: a null or empty text has no words, no runs and collapses to the
empty text; repeated rows and equal ids are judged row by row; very long texts
are read whole, memory grows with the longest text and its periodic stretches; an
empty table gives an empty table; columns other than key and text are not read.
A row is one task's work at most, nothing is shuffled.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackgrid.llm.words import Spans, one_row_batches

LEAST, TIMES = 6, 4
GRAM = 8
WORD = r"[^\x20\x09-\x0D]+"

RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


def segments(symbols: list[int]):
    """Append symbols to a suffix automaton; for each one the (longest length, last end) of the path segments it recolours.

    State 0 is the root. The first transition of a state lies in ``symbol`` and
    ``target``, further ones in ``more``; most states have one. ``left``, ``right``
    and ``up`` are the splay trees of the preferred paths, ordered by depth; ``up``
    of a tree's root is where the path hangs on another. ``colour`` is valid at the
    root of a splay tree and holds for all of it.
    """
    size = 2 * len(symbols) + 1
    blank = array("i", [-1]) * size
    length, link, symbol, target = array("i", [0]) * size, blank[:], blank[:], blank[:]
    left, right, up, colour = blank[:], blank[:], blank[:], blank
    more: dict[int, dict[int, int]] = {}
    states, last = 1, 0

    def rotate(x, p):
        g = up[p]
        if left[p] == x:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b >= 0:
            up[b] = p
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x
        up[x], up[p] = g, x

    def splay(x):
        p = up[x]
        if p < 0 or (left[p] != x and right[p] != x):
            return
        while True:
            g = up[p]
            if g < 0 or (left[g] != p and right[g] != p):
                colour[x] = colour[p]
                rotate(x, p)
                return
            if (left[p] == x) == (left[g] == p):
                top = up[g]
                deep = top < 0 or (left[top] != g and right[top] != g)
                rotate(p, g)
                rotate(x, p)
            else:
                top = up[g]
                deep = top < 0 or (left[top] != g and right[top] != g)
                rotate(x, p)
                rotate(x, g)
            if deep:
                colour[x] = colour[g]
                return
            p = top

    for i, c in enumerate(symbols):
        new, p, q = states, last, -1
        states += 1
        length[new] = i + 1
        while p >= 0:
            if symbol[p] == c:
                q = target[p]
                break
            if symbol[p] < 0:
                symbol[p], target[p] = c, new
            elif (m := more.get(p)) is None:
                more[p] = {c: new}
            elif (q := m.get(c, -1)) >= 0:
                break
            else:
                m[c] = new
            p = link[p]
        if q < 0:
            q = 0
        elif length[p] + 1 != length[q]:
            # a state for the shorter strings of q, put above q on q's own path and in its colour
            clone = states
            states += 1
            length[clone], symbol[clone], target[clone] = length[p] + 1, symbol[q], target[q]
            if q in more:
                more[clone] = dict(more[q])
            link[clone], link[q] = link[q], clone
            splay(q)
            above = left[q]
            left[clone], left[q], up[clone] = above, clone, q
            if above >= 0:
                up[above] = clone
            while p >= 0:
                if symbol[p] == c:
                    if target[p] != q:
                        break
                    target[p] = clone
                elif (m := more.get(p)) is not None and m.get(c) == q:
                    m[c] = clone
                else:
                    break
                p = link[p]
            q = clone
        link[new] = up[new] = q
        last = new
        # access: the path from the new state to the root becomes one preferred path
        met, below, x = [], new, q
        while x >= 0:
            splay(x)
            seen = colour[x]
            if seen >= 0:
                met.append((length[x], seen))
            deeper = right[x]
            if deeper >= 0:
                colour[deeper] = seen
            right[x] = below
            up[below] = x
            below, x = x, up[x]
        colour[below] = i
        yield met


def runs_within(words: list[int], lo: int, hi: int, found: set) -> None:
    """Add to ``found`` each (start, length, period) that has a square inside words[lo:hi]."""
    known, n = {}, len(words)
    for i, met in enumerate(segments(words[lo:hi]), lo):
        for longest, last in met:
            period = i - lo - last
            if period > longest or known.get(period, -1) > i:
                continue
            start, end = i - period, i + 1
            while start > 0 and words[start - 1] == words[start - 1 + period]:
                start -= 1
            while end < n and words[end] == words[end - period]:
                end += 1
            known[period] = end
            if end - start >= max(LEAST, TIMES * period):
                found.add((start, end - start, period))


def back(keys: np.ndarray) -> np.ndarray:
    """For each place how far back the same key stands last; a number beyond all distances where it is new."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    far = np.full(len(keys), np.iinfo(np.int64).max)
    far[order[1:][same]] = np.diff(order)[same]
    return far


def stretches(near: np.ndarray, least: int) -> np.ndarray:
    """(first, past the last) of each maximal stretch of True with at least ``least`` places."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], near, [False])).astype(np.int8))).reshape(-1, 2)
    return edge[edge[:, 1] - edge[:, 0] >= least]


def candidates(ids: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int]]:
    """(text, from, to) over a batch's words: stretches that hold a square of every run there may be."""
    n = len(ids)
    if n < LEAST:
        return []
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    far = back(text * (int(ids.max()) + 1) + ids)
    spans = []
    for q in (1, 2, 4, GRAM):
        smallest = q // 2 + 1
        for lo, hi in stretches(far <= q, max(LEAST, TIMES * smallest) - smallest):
            spans.append((lo, hi, 1))
    if n >= GRAM:
        mixed = np.zeros(n - GRAM + 1, np.uint64)
        for k in range(GRAM):
            mixed = (mixed + ids[k : n - GRAM + 1 + k].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        mixed ^= text[: len(mixed)].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        far = back(mixed)
        q, widest = 2 * GRAM, int(np.diff(first).max())
        while q // 2 < widest:
            smallest = q // 2 + 1
            for lo, hi in stretches(far <= q, (TIMES - 1) * smallest - GRAM + 1):
                spans.append((lo, hi, GRAM))
            q *= 2
    out: list[list[int]] = []
    cut = []
    for lo, hi, gram in spans:  # a stretch may cross texts where chance repeats meet
        for t in range(text[lo], text[hi - 1] + 1):
            cut.append((t, max(lo, first[t]), min(hi + gram - 1, first[t + 1])))
    for t, lo, hi in sorted(cut):
        if out and out[-1][0] == t and lo <= out[-1][2]:
            out[-1][2] = max(out[-1][2], hi)
        else:
            out.append([t, lo, hi])
    return [tuple(map(int, x)) for x in out]


def runs_of_batch(words: list[bytes], first: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """Text -> its runs by start, then period; texts without any are left out."""
    if not words:
        return {}
    ids = pa.array(words, pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    found: dict[int, set] = {}
    lists: dict[int, list[int]] = {}
    for t, lo, hi in candidates(ids, first):
        if t not in lists:
            lists[t] = ids[first[t] : first[t + 1]].tolist()
        runs_within(lists[t], lo - int(first[t]), hi - int(first[t]), found.setdefault(t, set()))
    return {t: sorted(x, key=lambda r: (r[0], r[2])) for t, x in found.items() if x}


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words outside the repeats of every run."""
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    keep = np.cumsum(depth[:-1]) == 0
    return [w for w, k in zip(words, keep, strict=True) if k]


def _judge(batches):
    for whole in batches:
        for batch in one_row_batches([whole]):
            spans = Spans(batch.column(1))
            words, first = spans.words(), spans.first
            runs = runs_of_batch(words, first)
            texts = []
            for t in range(batch.num_rows):
                own = words[first[t] : first[t + 1]]
                texts.append(b" ".join(collapse(own, runs[t]) if t in runs else own))
            rows = [[{"start": s, "length": n, "period": p} for s, n, p in runs.get(t, ())] for t in range(batch.num_rows)]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, kind), pa.array(texts, pa.binary()).cast(pa.string())], names=["key", "runs", "collapsed"]
            )


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, its runs by start, then period, and the text without the repeats."""
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField("key", kind), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(_judge, schema).select(F.col("key").alias(key), "runs", "collapsed")


def damaged(key: str = "doc_id", text: str = "text"):
    """The text whose tail repeats where the hash of its id asks for it.

    With h the crc32 of the id and g = floor(h / 10): where h % 10 = 0 and the text
    has n > 0 words, the words from a = g % n on become repeats of the p words
    there, p = 1 + floor((n - a) / (3 + g % 8)). Such a text is joined by one
    space. A null id counts as the empty text.
    """
    h = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(F.col(text), F.lit(f"({WORD})"), F.lit(1))
    n = F.size(words)
    a = (g % n).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    unit = F.slice(words, a + 1, p)
    laps = F.ceil((n - a) / p).cast("int")
    head = F.when(a > 0, F.slice(words, F.lit(1), a)).otherwise(F.array().cast("array<string>"))
    tail = F.slice(F.flatten(F.array_repeat(unit, laps)), F.lit(1), n - a)
    return F.when((h % 10 == 0) & (F.coalesce(n, F.lit(0)) > 0), F.array_join(F.concat(head, tail), " ")).otherwise(F.col(text))


def digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Number of runs, the longest of them and digests of all, of what find_runs returns."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    with_best = found.select(key, "runs", "collapsed", best.alias("best"))
    return with_best.select(
        key,
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.s").alias("start"),
        (-F.col("best.l")).alias("length"),
        F.col("best.p").alias("period"),
        F.floor(F.lit(-1000) * F.col("best.l") / F.col("best.p")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
