"""License notices, periodic runs and conversation repair against brute force, with nulls, repeats, ties and long texts."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from trackgrid.llm import conversations, licenses, queries, runs
from trackgrid.llm.ship import ship

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def crc(value) -> int:
    return zlib.crc32(("" if value is None else str(value)).encode())


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    few = ["a", "b", "ü"]
    many = ["alpha", "beta,", "Under", "the", "MIT", "license.", "version", "2"] + [f"w{i}" for i in range(60)]
    out = [" ".join(rng.choice(few[: rng.randint(1, 3)]) for _ in range(rng.randint(0, 40))) for _ in range(40)]
    out += ["  ".join(rng.choice(many) for _ in range(rng.randint(0, 90))) for _ in range(60)]
    line = "say it again \n"
    out += [line * 30, "x " * 5000, " ".join(rng.choice(many) for _ in range(9000)) + " tail" * 9, None, "", " \t\n", "x" * 9000, "a\x00b c", "   "]
    out += ["Released under the MIT License.", "RELEASED UNDER\n\nTHE MIT-LICENSE", "under the mit licence", "undr the mit licens", "under the m1t license", "Apache License, Version 2.0", "apache licence version 2"]
    out += ["Apache License, Version 1.1", "CC BY-NC 4.0", "CC BY-ND", "cc by n c", "cc by nc " * 40, "under the mit license" * 3, "der MIT-Lizenz", "This work is under the GNU General Public License, version 3."]
    return out + [out[0], out[45], out[-1]]


@pytest.fixture(scope="module")
def rows(texts):
    made = [(i * 7 + 2, t, "en", None, i) for i, t in enumerate(texts)]
    return made + [made[3], (None, texts[50], None, "s", None), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    df = ship(spark).createDataFrame(rows, DOCS).repartition(3)
    for name in ("runs", "collapsed", "spans", "n_words", "key", "label", "start"):
        df = df.withColumn(name, F.lit("extra"))
    df.write.parquet(f"{path}/documents.parquet")
    return path


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- op11


def distance(a: str, b: str) -> int:
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        line, old = [i], line
        for j, y in enumerate(b, 1):
            line.append(min(old[j] + 1, line[-1] + 1, old[j - 1] + (x != y)))
    return line[-1]


def fewest_edits(words: tuple, notice) -> int | None:
    """Over all spans of whole words, the fewest edits of a notice; fixed words as they stand."""
    parts = [(fixed, " ".join(g)) for fixed, g in itertools.groupby(notice.phrase.split(" "), key=lambda w: w in notice.fixed)]

    def go(at: int, part: int, left: int):
        if part == len(parts):
            return 0
        best, (fixed, want) = None, parts[part]
        for end in range(at + 1, min(len(words), at + len(want) + left) + 1):
            text = " ".join(words[at:end])
            if len(text) > len(want) + left:
                break
            cost = (0 if text == want else None) if fixed else distance(text, want)
            if cost is not None and cost <= left:
                rest = go(end, part + 1, left - cost)
                best = best if rest is None else cost + rest if best is None else min(best, cost + rest)
        return best

    costs = [c for at in range(len(words)) if (c := go(at, 0, notice.edits)) is not None]
    return min(costs, default=None)


def plain_words(text) -> list[str]:
    lower = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_notices(row):
    words = plain_words(row[1])
    places = [(i, n.label) for n in licenses.BASE for i in range(len(words)) if words[i : i + len(p := n.phrase.split())] == p]
    score, labels = 0.0, set()
    for notice in licenses.NOTICES:
        if len(words) > 400:  # long texts of this fixture hold exact notices only
            edits = 0 if f" {notice.phrase} " in f" {' '.join(words)} " else None
        else:
            edits = fewest_edits(tuple(words), notice)
        if edits is not None:
            labels.add(notice.label)
            score = max(score, 1 - edits / len(notice.phrase))
    starts = [i for i, _ in places]
    joined = lambda x: ",".join(sorted(set(x)))
    return row[0], len(words), len(places), min(starts, default=None), max(starts, default=None), joined(n for _, n in places), joined(labels), score


def test_notices_equal_brute_force(spark, docs, rows):
    assert collected(queries.op11_licenses(spark, docs)) == sorted(map(brute_notices, rows), key=repr)


def test_altered_notices_are_found_within_their_bound():
    rng = random.Random(5)
    for _ in range(150):
        notice = rng.choice(licenses.NOTICES)
        text = list(notice.phrase)
        for _ in range(rng.randint(0, notice.edits + 2)):
            at = rng.randrange(len(text))
            text[at : at + rng.randint(0, 1)] = rng.choice(["", "x", " ", "e"])
        around = " ".join(rng.choice(["the", "under", "license", "mit", "by", "2"]) for _ in range(4))
        words = plain_words(f"{around} {''.join(text)} {around}")
        (_, spans), = licenses.search([" ".join(words).encode()])
        for other in licenses.NOTICES:
            found = min((s["edits"] for s in spans if s["phrase"] == other.phrase), default=None)
            assert found == fewest_edits(tuple(words), other), (words, other)
        for span in spans:
            stood = " ".join(words[span["first_word"] : span["last_word"] + 1])
            assert distance(stood, span["phrase"]) <= span["edits"]


# -- op12


def brute_runs(words: list) -> list:
    out, n = [], len(words)
    for q in range(1, n // runs.TIMES + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i:
                start, length = i, j + q - i
                smaller = any(all(words[k] == words[k + p] for k in range(start, start + length - p)) for p in range(1, q))
                if length >= max(runs.LEAST, runs.TIMES * q) and not smaller:
                    out.append((start, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng = random.Random(2)
    for _ in range(150):
        batch, first = [], [0]
        for _ in range(rng.randint(0, 6)):
            kinds = rng.choice([1, 2, 3, 40])
            words = [rng.randrange(kinds) for _ in range(rng.randint(0, 70))]
            if rng.random() < 0.7:
                words += (words[-rng.randint(1, 20) :] * rng.randint(1, 7))[: rng.randint(0, 90)]
            batch += [b"%d" % w for w in words]
            first.append(len(batch))
        found = runs.runs_of_batch(batch, runs.np.array(first))
        for t, (lo, hi) in enumerate(itertools.pairwise(first)):
            assert found.get(t, []) == brute_runs(batch[lo:hi])


def test_access_tells_the_last_end_of_every_suffix():
    rng = random.Random(4)
    for _ in range(60):
        text = [rng.randrange(3) for _ in range(50)]
        for i, met in enumerate(runs.segments(text)):
            want = {}
            for m in range(1, i + 1):
                ends = [e for e in range(m - 1, i) if text[e - m + 1 : e + 1] == text[i - m + 1 : i + 1]]
                if ends:
                    want[max(ends)] = m  # the longest suffix that last ended there
            assert {c: m for m, c in met if m} == want


def brute_collapse(row):
    words = [w.decode() for w in WORD.findall((row[1] or "").encode())]
    h, n = crc(row[0]), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = runs.runs_of_batch([w.encode() for w in words], runs.np.array([0, n])).get(0, []) if n > 400 else brute_runs(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return row[0], len(found), *figures, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone))


def test_collapsed_texts_equal_brute_force(spark, docs, rows):
    want = sorted(map(brute_collapse, rows), key=repr)
    assert sum(r[1] > 0 for r in want) > 20
    assert collected(queries.op12_runs(spark, docs)) == want


def test_damage_reaches_all_lengths(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(i % 40)), None, None, None) for i in range(600)]
    docs = ship(spark).createDataFrame(rows, DOCS)
    found = runs.digests(runs.find_runs(docs.select("doc_id", runs.damaged().alias("text"))))
    assert collected(found) == sorted(map(brute_collapse, rows), key=repr)


# -- op13


def cheapest(symbols: list) -> tuple[int, str]:
    """(cost, least audit) over symbols (initial, must go, truncated), by recursion over all edits."""
    after = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    free = {0: 2, 1: 2, 2: 3, 3: 2}
    best = {s: (0, "") for s in (0, 3)}

    def with_inserts(table):
        for _ in range(3):
            for s in range(4):
                if free[s] in table:
                    c, a = table[free[s]]
                    table[s] = min(table.get(s, (10**9, "")), (c + 3, "I" + a))
        return table

    best = with_inserts(best)
    for initial, gone, truncated in reversed(symbols):
        table = {}
        for s in range(4):
            options = [(best[s][0] + 4, "D" + best[s][1])]
            if not gone:
                if initial in after[s]:
                    c, a = best[after[s][initial]]
                    options.append((c + 3 * truncated, "K" + a))
                c, a = best[free[s]]
                options.append((c + 3 + 3 * truncated, "R" + a))
            table[s] = min(options)
        best = with_inserts(table)
    return best[0]


def brute_repair(rows, damage=True):
    groups = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        spaced = lambda x: " " if x is None else str(x)
        hit, role, text = zlib.crc32(f"{spaced(conv)}:{spaced(turn)}".encode()) % 20 if damage else 9, spaced(role), spaced(text)
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        groups[conv] += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    out = []
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, symbols, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in own:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            symbols.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        cost, audit = cheapest(symbols)
        lines, state, left = [], 0, iter(own)
        for letter in audit:
            role, text = (None, "") if letter == "I" else next(left)[1:]
            if letter == "D":
                continue
            role = role if letter == "K" else "assistant" if state == 2 else "user"
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
            lines.append(f"{role}:{text}")
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        turns = {t for t, *_ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        out.append((conv, gaps, *faults.values(), illegal, cost, audit, sha("\n".join(lines))))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(8)
    made = []
    for conv in range(120):
        for turn in range(rng.randint(1, 12)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "Sam", "", None])
            text = rng.choice(["Yes.", "yes", "No!", "", " ", "\t\n", "Why? ", "ends.\n", "ünd", None, f"own {conv} {turn}."])
            made.append((conv, rng.choice([turn, turn, turn, turn + 9, None, -turn]), role, text))
    made += [made[0]] * 5 + [(None, 0, "user", "Hi."), (None, 1, "assistant", "Yo."), (None, None, None, None), (7, 3, "user", "x" * 9000 + ".")]
    alone = next(c for c in itertools.count(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return [*made, (alone, 0, "user", "Gone.")]  # its only row is dropped


TALKS = "conv_id long, turn long, role string, text string"


def test_repair_equals_brute_force(spark, talks, tmp_path, monkeypatch):
    df = ship(spark).createDataFrame(talks, TALKS).repartition(3)
    for name in ("n", "at", "part", "fault", "audit", "c", "first_turn", "copy"):
        df = df.withColumn(name, F.lit("extra"))
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    want = brute_repair(talks)
    assert collected(queries.op13_conversations(spark, str(tmp_path))) == want
    monkeypatch.setattr(conversations, "SEGMENT_BITS", 2)  # segments of four rows: all that crosses their borders
    assert collected(queries.op13_conversations(spark, str(tmp_path))) == want


def test_one_conversation_spreads_over_segments(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(1, t // 2, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["a.", "b", f"{t}."])) for t in range(700)]
    monkeypatch.setattr(conversations, "SEGMENT_BITS", 3)
    df = ship(spark).createDataFrame(rows, TALKS)
    found = conversations.repair(df)
    assert collected(conversations.report(df, found)) == brute_repair(rows, damage=False)
    assert found.rows.groupBy("conv_id", "part").count().count() > 20
    ordered = [(r.role, r.text) for r in found.rows.orderBy("conv_id", "part", "place").collect()]
    assert sha("\n".join(f"{a}:{b}" for a, b in ordered)) == found.digests.first()["sha256"]


def test_runs_of_a_symbol_advance_by_powers():
    rng = random.Random(6)
    for _ in range(300):
        rle = [[rng.choice([0, 1, 2, 3, 4, 5, 6, 8]), rng.choice([1, 2, 3, 9])] for _ in range(rng.randint(0, 6))]
        plain = [("sua?"[s % 4] if s < 8 else "u", s == 8, 4 <= s < 8) for s, n in rle for _ in range(n)]
        audit, state = conversations.unroll([tuple(r) for r in rle], conversations.AT_END, 0, True)
        matrix = conversations.UNIT
        for symbol, n in rle:
            matrix = conversations.advanced(matrix, symbol, n)
        assert (conversations.applied(matrix, conversations.AT_END)[0], audit) == cheapest(plain)
        assert state in (0, 3)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], TALKS).write.parquet(f"{tmp_path}/conversations.parquet")
    for name in ("op11_licenses", "op12_runs", "op13_conversations"):
        assert queries.QUERIES[name](ship(spark), str(tmp_path)).count() == 0
