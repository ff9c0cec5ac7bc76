"""Short license notices in whole texts, also when a few characters differ.

The words of a text are runs of digits, letters and characters beyond ASCII
after lower-casing A-Z; joined by one space they are the text that is searched.
A notice is a phrase of such words with a label and a bound of k edits
(characters put in, left out or changed). Some of its words are fixed: they tell
one license from another (a version, a name) and must stand as they are.

The method. Of k + 2 pieces of a phrase at least two survive k edits (pigeonhole),
and edits shift them against each other by k characters at most. Occurrences of
two pieces that fit so are seeds; any other text is passed over unseen by the
matcher. A seed at a known place of the phrase gives a window: the phrase's
length and k characters more at either side, carried on to whole words. In each window the regex module searches the phrase
with at most k errors and takes the match with the fewest; it starts and ends at
word borders. A place found by several seeds counts once; of overlapping places
of one notice that with fewer edits stays, then the earlier one.

Defined results: a null or empty text has no words and no spans; repeated rows
and equal ids are judged row by row; whole texts are searched, a text of many
notices yields a span for each; an empty table gives an empty table; columns
other than key and text are not read. Map only: nothing is shuffled.
"""

from __future__ import annotations

import bisect
import itertools
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackgrid.llm.words import one_row_batches

SPAN = T.StructType(
    [T.StructField("label", T.StringType()), T.StructField("phrase", T.StringType())]
    + [T.StructField(n, T.LongType()) for n in ("first_word", "last_word", "edits")]
    + [T.StructField("similarity", T.DoubleType())]
)

#: Lower-cases A-Z and turns every byte that is in no word into a space.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

#: An edit for so many characters that are not fixed, rounded down, and never more than so many.
CHARACTERS_PER_EDIT, MOST_EDITS = 8, 3


@dataclass(frozen=True)
class Notice:
    label: str
    phrase: str
    fixed: tuple[str, ...] = ()

    @cached_property
    def edits(self) -> int:
        """The bound on edits, by the characters that are not fixed."""
        return min(MOST_EDITS, (len(self.phrase) - sum(map(len, self.fixed))) // CHARACTERS_PER_EDIT)

    @cached_property
    def pattern(self):
        """The phrase with bounded errors in all but its fixed words, between word borders."""
        parts = []
        for fixed, group in itertools.groupby(self.phrase.split(" "), key=lambda word: word in self.fixed):
            text = " ".join(group)
            parts.append(text if fixed or not self.edits else f"(?:{regex.escape(text, literal_spaces=True)}){{e<={self.edits}}}")
        return regex.compile(f"(?b)(?<![^ ]){' '.join(parts)}(?![^ ])")

    @cached_property
    def seeds(self) -> list[tuple[int, bytes]]:
        """(place in the phrase, piece): k + 2 pieces of about equal length that cover it."""
        n, k = len(self.phrase), self.edits + 2
        cuts = [n * i // k for i in range(k + 1)]
        return [(a, self.phrase[a:b].encode()) for a, b in zip(cuts, cuts[1:], strict=False)]


# Phrases of public license notices, with the words that tell them apart.
BASE = (
    Notice("mit", "under the mit license", ("mit",)),
    Notice("apache-2", "apache license version 2", ("2",)),
    Notice("cc-by-nc", "cc by nc", ("by", "nc")),
)
FURTHER = (
    Notice("agpl-3", "gnu affero general public license version 3", ("gnu", "affero", "3")),
    Notice("bsd", "redistribution and use in source and binary forms"),
    Notice("cc-by-nc", "creative commons attribution noncommercial", ("noncommercial",)),
    Notice("cc-by-nd", "cc by nd", ("by", "nd")),
    Notice("cc-by-sa", "cc by sa", ("by", "sa")),
    Notice("cc-by-sa", "creative commons attribution sharealike", ("sharealike",)),
    Notice("gpl-2", "gnu general public license version 2", ("gnu", "2")),
    Notice("gpl-3", "gnu general public license version 3", ("gnu", "3")),
    Notice("isc", "permission to use copy modify and or distribute"),
    Notice("lgpl", "gnu lesser general public license", ("gnu", "lesser")),
    Notice("mit", "permission is hereby granted free of charge"),
    Notice("mpl-2", "mozilla public license version 2", ("mozilla", "2")),
    Notice("unlicense", "free and unencumbered software released"),
)
NOTICES = BASE + FURTHER


def normalised(text: bytes) -> bytes:
    return b" ".join(text.translate(WORD_BYTES).split())


def places(buffer: bytes, piece: bytes) -> list[int]:
    """Where the piece starts, overlapping ones included."""
    out, at = [], buffer.find(piece)
    while at >= 0:
        out.append(at)
        at = buffer.find(piece, at + 1)
    return out


def paired(hits: list[tuple[int, int, int]], slack: int) -> list[tuple[int, int]]:
    """(at, place) of each hit that has one of another piece whose shift differs by at most ``slack`` bytes."""
    hits = sorted(hits)
    kept = [False] * len(hits)
    for i, (shift, place, _) in enumerate(hits):
        for j in range(i + 1, len(hits)):
            if hits[j][0] - shift > slack:
                break
            if hits[j][1] != place:
                kept[i] = kept[j] = True
                break
    for j in range(len(hits) - 1, 0, -1):  # the same from the other end
        for i in range(j - 1, -1, -1):
            if hits[j][0] - hits[i][0] > slack:
                break
            if hits[j][1] != hits[i][1]:
                kept[i] = kept[j] = True
                break
    return [(at, place) for keep, (_, place, at) in zip(kept, hits, strict=True) if keep]


def widened(buffer: bytes, at: int, lo: int, hi: int) -> tuple[int, int]:
    """lo and hi carried on to word borders, within the text that holds ``at``."""
    before = buffer.rfind(b"\n", lo, at)
    if before < 0:
        space = buffer.rfind(b" ", 0, lo + 1)
        before = max(space, buffer.rfind(b"\n", space + 1, lo + 1))
    after = buffer.find(b"\n", at, hi)
    if after < 0:
        after = buffer.find(b" ", hi)
        after = len(buffer) if after < 0 else after
        line = buffer.find(b"\n", hi, after)
        after = line if line >= 0 else after
    return before + 1, after


def matches(buffer: bytes, notice: Notice) -> list[tuple[int, int, int]]:
    """(from, to, edits) in bytes of the buffer, texts parted by line feeds."""
    slack, size = 4 * notice.edits, len(notice.phrase)
    hits = sorted(paired([(at - place, place, at) for place, piece in notice.seeds for at in places(buffer, piece)], slack))
    fixed = [word.encode() for word in notice.fixed]
    found, sure = {}, -1
    for at, place in hits:
        if at < sure:  # inside a place without edits, which nothing overlapping can better
            continue
        lo, hi = widened(buffer, at, max(0, at - place - slack), min(len(buffer), at - place + size + slack))
        window = buffer[lo:hi]
        if any(word not in window for word in fixed):
            continue
        text = window.decode()
        match = notice.pattern.search(text)
        if match and sum(match.fuzzy_counts) <= notice.edits:
            start = lo + len(text[: match.start()].encode())
            stop = lo + len(text[: match.end()].encode())
            edits = sum(match.fuzzy_counts)
            found[start, stop] = min(edits, found.get((start, stop), edits))
            if edits == 0:
                sure = stop
    out: list[tuple[int, int, int]] = []
    for (start, stop), edits in sorted(found.items(), key=lambda x: (x[1], x[0])):
        i = bisect.bisect(out, (start, stop, edits))
        if (i == 0 or out[i - 1][1] <= start) and (i == len(out) or stop <= out[i][0]):
            out.insert(i, (start, stop, edits))
    return out


def search(texts: list[bytes], notices=NOTICES) -> list[tuple[int, list[dict]]]:
    """For each text its number of words and its spans by first word, then label and phrase."""
    clean = [normalised(t) for t in texts]
    buffer, starts, at = b"\n".join(clean), [], 0
    for text in clean:
        starts.append(at)
        at += len(text) + 1
    spans: list[list[dict]] = [[] for _ in clean]
    found = [(notice, *place) for notice in notices for place in matches(buffer, notice)]
    spaces = np.flatnonzero(np.frombuffer(buffer, np.uint8) == 32) if found else ()
    for notice, start, stop, edits in found:
        t = bisect.bisect(starts, start) - 1
        before, first, last = np.searchsorted(spaces, (starts[t], start, stop)).tolist()
        spans[t].append(
            {"label": notice.label, "phrase": notice.phrase, "first_word": first - before, "last_word": last - before, "edits": edits, "similarity": 1 - edits / len(notice.phrase)}
        )
    return [(c.count(b" ") + 1 if c else 0, sorted(s, key=lambda x: (x["first_word"], x["label"], x["phrase"]))) for c, s in zip(clean, spans, strict=True)]


@lru_cache
def _kind() -> pa.DataType:
    numbers = [(n, pa.int64()) for n in ("first_word", "last_word", "edits")]
    return pa.list_(pa.struct([("label", pa.string()), ("phrase", pa.string()), *numbers, ("similarity", pa.float64())]))


def find_notices(docs: DataFrame, key: str = "doc_id", text: str = "text", notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """Per row: the key, n_words, and the spans of notices by first word, then label and phrase.

    A span holds label, phrase, first_word and last_word (numbers from 0, both
    inside), edits and similarity (1 less edits a character of the phrase).
    """

    def judge(batches):
        for whole in batches:
            for batch in one_row_batches([whole]):
                texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
                found = search(texts, notices)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], _kind())], names=["key", "n_words", "spans"])

    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(SPAN))])
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(judge, schema).select(F.col("key").alias(key), "n_words", "spans")


def labelled(found: DataFrame, key: str = "doc_id", base: tuple[Notice, ...] = BASE) -> DataFrame:
    """Per row of find_notices: places and labels of the base phrases as they stand, labels of all, best similarity."""
    phrases = F.array(*[F.lit(n.phrase) for n in base])
    exact = F.filter("spans", lambda s: (s["edits"] == 0) & F.array_contains(phrases, s["phrase"]))
    labels = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    first_words = F.transform("exact", lambda s: s["first_word"])
    return found.select(key, "n_words", "spans", exact.alias("exact")).select(
        key,
        "n_words",
        F.size("exact").cast("long").alias("n_base"),
        F.array_min(first_words).alias("first_word"),
        F.array_max(first_words).alias("last_word"),
        labels("exact").alias("base_labels"),
        labels("spans").alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["similarity"])), F.lit(0.0)).alias("score"),
    )
