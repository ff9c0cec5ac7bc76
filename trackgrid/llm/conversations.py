"""Repair of conversation structure by the cheapest edits, with an audit of them.

A conversation's rows, in order of turn (nulls first, then role, then text), are
edited until the initials of their roles read ``(s?(ua)+)?``. Keep costs 0,
Rerole to user or assistant 3, Delete 4, Insert of an empty user or assistant row
3; a row whose text is truncated costs 3 more unless deleted; blank rows and
rows whose role and text stood earlier must be deleted. The audit is the
sequence of the edits' initials, of all cheapest ones the ASCII-least.

The method. A row is one of nine symbols: role initial by truncated or not, or
"must go". What a symbol does to the four states of the pattern (nothing yet,
after s, after u, after a) is a 4 x 4 matrix in (min, +), inserts included. Equal
consecutive symbols are collapsed to runs; a run of n advances through the
cached powers 1, 2, 4, ... of its symbol's matrix. The audit is unrolled
from costs to go: taken back over the runs by the same powers, then stepped
through row by row inside a run, taking the least letter that stays cheapest.

Nothing needs a conversation in one task: rows are dealt by range of
(conversation, turn, role, text) and numbered; a segment is at most 65,536
numbered rows of one conversation and becomes one matrix. The costs to go are
carried back over a conversation's segments (a matrix each), all segments are
unrolled at once, each from all states it may be entered in, and the states are
carried forward. Only two things are gathered by conversation because they are
one value: its audit, one letter a row, and its digest, a hash that streams over
the sorted rows without holding them.

Defined results: null conversations form one group; a null role or text counts
as one space; null turns come first; equal rows (same turn, role and text) are
all but one duplicates; a role's initial is its first character as it stands, an
empty role has none; very long texts are moved, never held together; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce
from math import inf
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackgrid.session import cut

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SPACE = " \t\n\x0b\x0c\r"
SEGMENT_BITS = 16

#: States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
STATES = range(4)
FREE = (2, 2, 3, 2)  # where an inserted or reroled row leads
ROLE = ("user", "user", "assistant", "user")
KEPT = ({0: 1}, {0: 2, 1: 2, 3: 2}, {2: 3}, {})  # by role: s, u, a, any other
MUST_GO = 8

Vector = tuple
Matrix = tuple


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(x + b[k][t] for k, x in enumerate(row)) for t in STATES) for row in a)


def applied(a: Matrix, v: Vector) -> Vector:
    return tuple(min(x + v[k] for k, x in enumerate(row)) for row in a)


def _inserts() -> Matrix:
    one = tuple(tuple(0 if s == t else INSERT if FREE[s] == t else inf for t in STATES) for s in STATES)
    return times(times(one, one), one)


INSERTS = _inserts()
AT_END = applied(INSERTS, (0, inf, inf, 0))
UNIT = tuple(tuple(0 if s == t else inf for t in STATES) for s in STATES)


def choices(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state after it) of the edits of a row, by letter."""
    out = [("D", DELETE, state)]
    if symbol != MUST_GO:
        role, more = symbol % 4, TRUNCATED * (symbol >= 4)
        if state in KEPT[role]:
            out.append(("K", KEEP + more, KEPT[role][state]))
        out.append(("R", REROLE + more, FREE[state]))
    return out


@lru_cache(maxsize=None)
def power(symbol: int, k: int) -> Matrix:
    """The transition of 2**k rows of this symbol, inserts before each included."""
    if k:
        half = power(symbol, k - 1)
        return times(half, half)
    step = [[inf] * 4 for _ in STATES]
    for s in STATES:
        for _, cost, t in choices(symbol, s):
            step[s][t] = min(step[s][t], cost)
    return times(INSERTS, tuple(map(tuple, step)))


def powers(symbol: int, n: int) -> list[Matrix]:
    return [power(symbol, k) for k in range(n.bit_length()) if n >> k & 1]


@lru_cache(maxsize=1 << 16)
def _advanced(matrix: Matrix, symbol: int, n: int) -> Matrix:
    return reduce(times, powers(symbol, n), matrix)


@lru_cache(maxsize=1 << 16)
def _back(vector: Vector, symbol: int, n: int) -> Vector:
    return reduce(lambda v, m: applied(m, v), powers(symbol, n), vector)


def advanced(matrix: Matrix, symbol: int, n: int) -> Matrix:
    """The matrix after n more rows of a symbol; cached without its least entry, as few such forms exist."""
    base = min(map(min, matrix))
    return tuple(tuple(x + base for x in row) for row in _advanced(tuple(tuple(x - base for x in row) for row in matrix), symbol, n))


def back(vector: Vector, symbol: int, n: int) -> Vector:
    """Costs to go before n rows of a symbol, from those after them."""
    base = min(vector)
    return tuple(x + base for x in _back(tuple(x - base for x in vector), symbol, n))


def unroll(runs: list[tuple[int, int]], to_go: Vector, state: int, last: bool) -> tuple[str, int]:
    """The least of the cheapest audits of these runs from a state, and the state after them."""
    before = [to_go]
    for symbol, n in reversed(runs):
        before.append(back(before[-1], symbol, n))
    before.reverse()
    out = []
    for k, (symbol, n) in enumerate(runs):
        if symbol == MUST_GO:  # an insert may always wait until after a delete, and D comes first
            out.append("D" * n)
            continue
        costs = [before[k + 1]]
        for _ in range(n):
            costs.append(back(costs[-1], symbol, 1))
        for left in range(n - 1, -1, -1):
            now, after = costs[left + 1], costs[left]
            while True:
                need, edits = now[state], choices(symbol, state)
                if edits[0][1] + after[state] == need:
                    out.append("D")
                    break
                if INSERT + now[FREE[state]] == need:
                    out.append("I")
                    state = FREE[state]
                    continue
                letter, _, state = next(e for e in edits if e[1] + after[e[2]] == need)
                out.append(letter)
                break
    while last and to_go[state]:
        out.append("I")
        state = FREE[state]
    return "".join(out), state


# -- rows to symbols


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with faults put in by the hash of conversation and turn: dropped, emptied, unended, doubled or reroled."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.pmod(F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")), F.lit(20))
    body = F.when(hit == 1, "").when(hit == 2, F.translate(text("text"), ".!?", "")).otherwise(text("text"))
    role = F.when(hit == 4, "user").otherwise(text("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(hit == 3, 2).otherwise(1)))
    return rows.filter(hit != 0).select("conv_id", "turn", role.alias("role"), body.alias("text"), copies.alias("copy")).drop("copy")


def judged(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number, the fault of the first and of further copies, numbered in order and written.

    Columns: conv_id, turn, role, text, n, fault (null, blank, duplicate or
    truncated; copies after the first are duplicates unless blank), at. Numbers
    ``at`` rise in order of (conv_id, turn, role, text).
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), spaced("role"), spaced("text"))
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n")).withColumn("mark", F.sha2("text", 256))
    firsts = counted.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("mark").alias("m")).agg(
        F.bool_or(F.col("turn").isNull()).alias("first_null"), F.min("turn").alias("first_turn")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("mark") == F.col("m"))
    first = F.when(F.col("first_null"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("first_turn"))
    end = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    fault = F.when(end == "", "blank").when(~first, "duplicate").when(~end.isin(".", "!", "?"), "truncated")
    order = ("conv_id", "turn", "role", "text")
    found = counted.join(firsts, same).select(*order, "n", fault.alias("fault"))
    numbered = found.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    return cut(numbered, "conversation-rows")


def symbols(rows: DataFrame) -> DataFrame:
    """The symbol of each judged row without its text, by segment."""
    role = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    gone = F.coalesce(F.col("fault").isin("blank", "duplicate"), F.lit(False))
    symbol = F.when(gone, MUST_GO).otherwise(role + F.when(F.col("fault") == "truncated", 4).otherwise(0))
    return rows.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "n", "fault", "at").select(
        "conv_id", F.shiftright("at", SEGMENT_BITS).alias("part"), "at", "turn", "initial", "n", "fault", symbol.cast("int").alias("symbol")
    )


# -- streams over sorted rows


def _long(name: str) -> T.StructField:
    return T.StructField(name, T.LongType())


RUN_COLUMNS = [T.StructField("symbols", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.LongType()))]
TURNS = [_long("least"), _long("most"), _long("turns")]
COUNTS = [_long("blank"), _long("duplicate"), _long("truncated"), _long("illegal")]
ENDS = [T.StructField("opens", T.StringType()), T.StructField("closes", T.StringType())]
VECTOR = T.ArrayType(T.LongType())
UNREACHED = -1


def _table(rows: list[tuple], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    if rows:
        kinds = to_arrow_schema(schema)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k.type) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)


def _streamed(df: DataFrame, by: tuple[str, ...], order: list, make, fields: list[T.StructField]) -> DataFrame:
    """make(rows) over each task's rows in order, rows of the same ``by`` in one task."""
    schema = T.StructType(fields)

    def run(batches):
        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        out = []
        for made in make(rows()):
            out.append(made)
            if len(out) >= 2048:
                yield from _table(out, schema)
                out = []
        yield from _table(out, schema)

    return df.repartition(*by).sortWithinPartitions(*order).mapInArrow(run, schema)


def _groups(rows: Iterator[tuple], width: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    import itertools

    return itertools.groupby(rows, key=lambda r: r[:width])


def illegal_pair(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def _segments(rows):
    """Sorted rows of segments -> a row for each: its matrix, runs, counts and what its borders need."""
    for (conv, part), own in _groups(rows, 2):
        matrix, runs = UNIT, []
        counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        least = most = opens = closes = None
        turns = illegal = 0

        def add(symbol, n, runs=runs):
            if runs and runs[-1][0] == symbol:
                runs[-1][1] += n
            else:
                runs.append([symbol, n])

        for _, _, _, turn, initial, n, fault, symbol in own:
            add(symbol, 1)
            if fault:
                counts[fault] += 1
            if n > 1:
                add(MUST_GO, n - 1)
                counts["blank" if fault == "blank" else "duplicate"] += n - 1
                illegal += (n - 1) * illegal_pair(initial, initial)
            if turn is not None and turn != most:
                least, most, turns = turn if least is None else least, turn, turns + 1
            illegal += closes is not None and illegal_pair(closes, initial)
            opens, closes = initial if opens is None else opens, initial
        for symbol, n in runs:
            matrix = advanced(matrix, symbol, n)
        flat = [UNREACHED if x == inf else x for row in matrix for x in row]
        yield (conv, part, flat, [r[0] for r in runs], [r[1] for r in runs], least, most, turns, *counts.values(), illegal, opens, closes)


def _carried_back(rows):
    """Matrices of a conversation from its last segment on -> the costs to go after each, and before it from state 0."""
    for (conv,), own in _groups(rows, 1):
        to_go, last = AT_END, True
        for _, part, flat in own:
            matrix = tuple(tuple(inf if x == UNREACHED else x for x in flat[i : i + 4]) for i in range(0, 16, 4))
            before = applied(matrix, to_go)
            yield conv, part, list(to_go), last, before[0]
            to_go, last = before, False


def _unrolled(batches):
    """Segments with their costs to go -> the audit and the state after, for each state they may be entered in."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            runs = list(zip(row["symbols"], row["counts"], strict=True))
            ways = [unroll(runs, tuple(row["to_go"]), s, row["is_last"]) for s in STATES]
            out.append(([w[0] for w in ways], [w[1] for w in ways]))
        kept = [c for c in batch.schema.names if c not in ("symbols", "counts", "to_go", "is_last")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in kept] + [pa.array([w[0] for w in out], pa.list_(pa.string())), pa.array([w[1] for w in out], pa.list_(pa.int64()))],
            names=[*kept, "audits", "states"],
        )


def _carried_on(rows):
    """Unrolled segments of a conversation in order -> those taken, with the state they are entered in."""
    for (conv,), own in _groups(rows, 1):
        state = 0
        for _, part, audits, states in own:
            yield conv, part, audits[state], state
            state = states[state]


def _summed(rows):
    """Segments of a conversation in order -> its counts, gaps, cost and audit."""
    for (conv,), own in _groups(rows, 1):
        least = most = closes = cost = None
        turns, sums, audit = 0, [0, 0, 0, 0], []
        for _, _, piece, start_cost, lo, hi, seen, *counts, opens, ends in own:
            cost = start_cost if cost is None else cost
            if lo is not None:
                turns += seen - (most is not None and lo == most)
                least, most = lo if least is None else least, hi
            sums = [a + b for a, b in zip(sums, counts, strict=True)]
            sums[3] += closes is not None and illegal_pair(closes, opens)
            closes = ends
            audit.append(piece)
        yield conv, 0 if least is None else most - least + 1 - turns, *sums, cost, "".join(audit)


def _edited(rows):
    """Pieces of audits, each followed by its segment's rows -> (conv, part, place, letter, role, text) as repaired."""
    for (conv, part), own in _groups(rows, 2):
        letters, state, place = iter(""), 0, 0

        def inserted(conv=conv, part=part):
            nonlocal state, place
            role, state, place = ROLE[state], FREE[state], place + 1
            return conv, part, place - 1, "I", role, ""

        for _, _, at, piece, entry, role, text, n in own:
            if at is None:
                letters, state = iter(piece), entry
                continue
            for _ in range(n):
                while (letter := next(letters)) == "I":
                    yield inserted()
                if letter == "D":
                    continue
                if letter == "K":
                    state = KEPT["sua".index(role[0])][state]
                else:
                    role, state = ROLE[state], FREE[state]
                yield conv, part, place, letter, role, text
                place += 1
        for _ in letters:
            yield inserted()


def _hashed(rows):
    """Sorted pieces and rows of conversations -> the digest of the repaired lines, fed line by line."""
    for (conv,), own in _groups(rows, 1):
        digest, first = hashlib.sha256(), True
        for _, _, _, _, role, text in _edited(own):
            digest.update(b"" if first else b"\n")
            digest.update(f"{role}:{text}".encode())
            first = False
        yield conv, digest.hexdigest()


class Repair(NamedTuple):
    """``audits``: a row per conversation that has rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    ``rows``: the repaired rows: conv_id, part, place (order within a conversation: part, place), edit, role, text.
    ``digests``: conv_id, sha256 of the repaired ``role:text`` lines."""

    audits: DataFrame
    rows: DataFrame
    digests: DataFrame


def repair(rows: DataFrame) -> Repair:
    """Repair each conversation of rows (conv_id, turn, role, text)."""
    conv, key = T.StructField("conv_id", rows.schema["conv_id"].dataType), _long("part")
    numbered = judged(rows)
    by_part = ("conv_id", "part")
    made = _streamed(symbols(numbered), by_part, ["conv_id", "part", "at"], _segments, [conv, key, T.StructField("matrix", VECTOR), *RUN_COLUMNS, *TURNS, *COUNTS, *ENDS])
    segments = cut(made, "conversation-segments")
    to_go = _streamed(
        segments.select("conv_id", "part", "matrix"), ("conv_id",), [F.col("conv_id"), F.col("part").desc()], _carried_back,
        [conv, key, T.StructField("to_go", VECTOR), T.StructField("is_last", T.BooleanType()), _long("cost")],
    ).withColumnsRenamed({"conv_id": "c", "part": "p"})
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))
    met = segments.drop("matrix").join(to_go, same).drop("c", "p")
    kept = [f for f in met.schema.fields if f.name not in ("symbols", "counts", "to_go", "is_last")]
    both = [T.StructField("audits", T.ArrayType(T.StringType())), T.StructField("states", VECTOR)]
    unrolled = cut(met.mapInArrow(_unrolled, T.StructType([*kept, *both])), "conversation-audits")
    pieces = _streamed(
        unrolled.select("conv_id", "part", "audits", "states"), ("conv_id",), ["conv_id", "part"], _carried_on, [conv, key, T.StructField("piece", T.StringType()), _long("entry")]
    )
    pieces = cut(pieces, "conversation-pieces")
    own = unrolled.select("conv_id", "part", "cost", *[f.name for f in [*TURNS, *COUNTS, *ENDS]]).withColumnsRenamed({"conv_id": "c", "part": "p"})
    audits = _streamed(
        pieces.join(own, same).select("conv_id", "part", "piece", "cost", *[f.name for f in [*TURNS, *COUNTS, *ENDS]]), ("conv_id",), ["conv_id", "part"], _summed,
        [conv, _long("gaps"), *COUNTS, _long("cost"), T.StructField("audit", T.StringType())],
    )
    nothing = {"at": "long", "role": "string", "text": "string", "n": "long"}
    told = pieces.select("conv_id", "part", F.lit(None).cast("long").alias("at"), "piece", "entry", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items() if c != "at"])
    texts = numbered.select("conv_id", F.shiftright("at", SEGMENT_BITS).alias("part"), "at", F.lit(None).cast("string").alias("piece"), F.lit(None).cast("long").alias("entry"), "role", "text", "n")
    stream = told.unionByName(texts)
    line = [T.StructField("edit", T.StringType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]
    order = ["conv_id", "part", "at"]  # a piece has no number and comes first
    repaired = _streamed(stream, by_part, order, _edited, [conv, key, _long("place"), *line])
    digests = _streamed(stream, ("conv_id",), order, _hashed, [conv, T.StructField("sha256", T.StringType())])
    return Repair(audits, repaired, digests)


def report(conversations: DataFrame, found: Repair) -> DataFrame:
    """A row per conversation of the table, also for those without rows left: counts, cost, audit, digest."""
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    every = conversations.select("conv_id").distinct()
    audits = found.audits.withColumnRenamed("conv_id", "c")
    digests = found.digests.withColumnRenamed("conv_id", "d")
    joined = every.join(audits, F.col("conv_id").eqNullSafe(F.col("c")), "left").join(digests, F.col("conv_id").eqNullSafe(F.col("d")), "left")
    return joined.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
