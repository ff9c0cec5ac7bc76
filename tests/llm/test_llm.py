"""The numbered operators against brute force, on a fixture with nulls, repeats, ties, long texts and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from trackgrid.llm import ann, exact, langid, lm, mix, pack, queries, simhash, substring, toxicity, urls
from trackgrid.llm.ship import ship
from trackgrid.llm.words import forget, release, tidy

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
PIECES = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def texts() -> list:
    rng = random.Random(3)
    words = ["alpha", "Beta", "gämma", "delta,", "epsilon", "zeta.", "eta", "theta", "iota", "kappa", "ÜBER", "lambda"] + [f"w{i}" for i in range(300)]
    passage = [rng.choice(words) for _ in range(40)]
    body = lambda n: " ".join(rng.choice(words) for _ in range(n))
    out = [body(rng.randint(1, 120)) for _ in range(30)]
    out += [" ".join([body(9), *passage, body(7)]), "\n".join([body(3), *passage[5:], body(30)]), " ".join(passage[:12]), " ".join(passage[:13])]
    out += [out[0], out[0].upper(), out[1], out[1] + " ", out[2].replace(" ", "  "), None, "", " \t\n ", "12 34", "?!", "\u00a0", "<|endoftext|> x", "a\x00b", "x" * 5000]
    near = body(200)
    out += [near, near + " tail", near.replace("alpha", "omega", 1), "one two", "one  two", "One two", body(6000)]
    return out


@pytest.fixture(scope="module")
def rows():
    langs, sources = ["en", "de", None], ["s1", "S2", "", None, "ß"]
    made = [(i * 3 + 1, t, langs[i % 3], sources[i % 5], None if i % 4 else i) for i, t in enumerate(texts())]
    return made + [made[0], (None, made[1][1], "en", "s1", 1), (None, "no id here", None, None, None), (made[5][0], "same id, other text", "de", "s1", 2)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return ship(spark).createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return ship(spark).createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def clash(docs):
    """Extra columns named like those the operators make."""
    for name in ("size", "kept", "digest", "fp", "mark", "score", "path", "rank", "shard", "start", "unit", "words"):
        docs = docs.withColumn(name, F.lit("extra"))
    return docs


def words(text, lower=False):
    data = (text or "").encode()
    return WORD.findall(data.translate(LOWER) if lower else data)


def table_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- op10


def brute_exact(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault((t or "").encode().translate(LOWER), []).append(i)
    return {k: (max((i for i in v if i is not None), default=None), len(v)) for k, v in groups.items()}


@pytest.mark.parametrize("digest", [exact.sha256, lambda c: F.unhex(F.substring(F.sha2(c, 256), 1, 2))])
def test_exact_dedup(docs, clash, rows, digest):
    want = brute_exact(rows)
    for frame in (docs, clash):
        got = exact.exact_dedup(frame, digest).collect()
        assert Counter((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == Counter((i, *want[(t or "").encode().translate(LOWER)]) for i, t, *_ in rows)
        assert sum(r["kept"] for r in got) == len(want)


def test_exact_state_goes_on_between_loads(spark, docs, rows, tmp_path):
    state = exact.ExactDedup(spark, str(tmp_path / "state"))
    state.ingest(docs.filter("doc_id % 2 = 0 or doc_id is null"), files_per_trigger=1)
    state.ingest(docs.filter("doc_id % 2 = 1"), files_per_trigger=1)
    got = state.result(docs).collect()
    want = brute_exact(rows)
    assert len(got) == len(rows) and sum(r["kept"] for r in got) == len(want) and {r["keep_id"] for r in got} == {k for k, _ in want.values()}


def test_exact_stage_keeps_columns(clash, none, rows):
    kept = exact.keep_one(clash)
    assert kept.columns == clash.columns and kept.count() == len(brute_exact(rows))
    assert exact.exact_dedup(none).count() == 0 and exact.keep_one(none).columns == none.columns


# -- op9


def test_url_rules_equal_plain_matching(spark):
    rules = [*queries.URL_RULES, urls.Rule("block", "a-b.org", "/x"), urls.Rule("allow", "org", "")]
    found = ["http://Example.NET/en/a?x#y", "https://example.net", "x://example.net/", "http://notexample.net/en/", "http://a.example.com/de/1", "ftp://q.org/fr/", "ftp://q.org", "http://q.a-b.org/xy",
             "http://org", "http://www.org?fr/", "nothing", "", None, "http://", "http://net/", "http://a.net\n/", "http://example.net/EN/"] * 2
    pages = spark.createDataFrame(list(enumerate(found)), "page_id long, url string").withColumn("host", F.lit("x")).withColumn("rule", F.lit(1))
    got = {r["page_id"]: r for r in urls.judge(pages, rules).collect()}
    for i, u in enumerate(found):
        host, path = urls.host_and_path(u)
        fits = [r for r in rules if host and ("." + host).endswith("." + r.host) and path.startswith(r.path)]
        best = min(fits, key=lambda r: (-len(r.name), r.name), default=None)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, best and best.name, best.verdict if best else "allow"), u
    assert urls.judge(pages.limit(0), rules).count() == 0 and urls.judge(pages, []).filter("verdict = 'allow'").count() == len(found)


# -- op1


def test_targets_share_the_excess():
    goal = mix.targets([100, 10, 1000], mix.Mix(weights=(3, 1, 2)))
    assert goal == [200.0, 20.0, 1445.0] and mix.targets([], mix.Mix()) == [] and mix.targets([0, 0], mix.Mix()) == [0, 0]


def test_splitting_tree_is_exact():
    quota = np.array([1000, 3, 0, 517])
    out = mix.split(quota, 13, 1)
    assert (out.sum(0) == quota).all() and (out >= 0).all() and out.sum(1).max() - out.sum(1).min() <= 4 and (out == mix.split(quota, 13, 1)).all()


@pytest.mark.parametrize("settings", [mix.Mix(), mix.Mix(blocks=8, shards=3)])
def test_mix_meets_its_targets(docs, rows, settings):
    got = mix.taken(docs, settings).toPandas()
    assert sorted(got["size"]) == sorted(len(words(t)) for _, t, *_ in rows) and (got.taken <= 2 * got["size"]).all()
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    sizes = [sum(len(words(t)) for _, t, _, s, _ in rows if s == name) for name in names]
    goal = dict(zip(names, mix.targets(sizes, settings), strict=True))
    by_source = docs.select("doc_id", "source").distinct().toPandas()
    assert got.groupby(["source_size", "target"]).taken.sum().to_dict() == pytest.approx({(s, goal[n]): goal[n] for n, s in zip(names, sizes, strict=True)}, abs=len(rows))
    assert len(by_source) and table_of(mix.taken(docs, settings)) == table_of(mix.taken(docs.repartition(2), settings))


def test_mix_rows_hold_the_taken_words(clash, none, docs):
    mixed, taken = mix.mixed(clash), mix.taken(docs)
    assert mixed.columns == clash.columns
    assert sum(len(words(r["text"])) for r in mixed.collect()) == taken.agg(F.sum("taken")).first()[0]
    assert mix.taken(none).count() == 0 and mix.mixed(none).count() == 0


# -- op2


def test_pack_covers_every_id_once(docs, clash, none, rows):
    full = Tokenizer.from_file(PIECES[0])
    ids = {}
    for i, t, *_ in rows:
        ids.setdefault(i, []).append([*full.encode(t or "", add_special_tokens=False).ids, 1])
    for frame, window, chunk in ((docs, 2048, 4_000_000), (clash, 64, 500)):
        got = pack.pack(frame, *PIECES, window=window, chunk=chunk).collect()
        per, sequences = Counter(), {}
        for r in got:
            a, n = r["start"], r["length"]
            assert any(x[a : a + n] == r["ids"] and len(x) == r["doc_tokens"] for x in ids[r["doc_id"]])
            assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
            per[r["doc_id"]] += n
            sequences.setdefault(r["sequence_id"], []).append((r["offset"], n))
        assert per == Counter({i: sum(map(len, x)) for i, x in ids.items()})
        for parts in sequences.values():
            at = 0
            for offset, n in sorted(parts):
                assert offset == at
                at += n
            assert at <= window
        full_or_even = [sum(n for _, n in p) for p in sequences.values()]
        assert sum(window - n for n in full_or_even if n & (n - 1)) == 0
    assert pack.pack(none, *PIECES).count() == 0


def test_bpe_equals_the_tokenizer_on_odd_space():
    full, own = Tokenizer.from_file(PIECES[0]), pack.Bpe(*PIECES)
    odd = ["a  b", " a", "a ", "\n", "\na\n b", "it's we'll", "a\tb", "a\u00a0 b", "a\u2028b", "é ü\nö", "", " ", "\x1c", "a\x85b", "1 22 333", "...  ...", "a\r\nb", "x\u3000y z"]
    for got, text in zip(own.encode(odd + odd), odd + odd, strict=True):
        assert got.tolist() == full.encode(text, add_special_tokens=False).ids, repr(text)


def test_least_squares_finds_an_exact_packing():
    combos = pack.combinations(np.array([300, 700, 1024, 1348]), 2048)
    assert sorted(map(tuple, combos.tolist())) == [(0, 700, 1348), (0, 1024, 1024)]
    counts = np.zeros(2049, np.int64)
    counts[[700, 1348, 1024]] = 5, 5, 8
    assert pack.repeats(combos, counts, 200) == pytest.approx([5, 4] if combos[0][1] == 700 else [4, 5], abs=0.01)


# -- op3


def test_forward_sums_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "bab"]
    lattice = langid.Lattice(pieces)
    p = np.random.default_rng(0).random((len(pieces) + 1, 2))

    def every(text, lang):
        if not text:
            return 1.0
        total = sum(p[i, lang] * every(text[len(q) :], lang) for i, q in enumerate(pieces) if text.startswith(q))
        return total + (p[-1, lang] * every(text[1:], lang) if text[0] not in pieces else 0)

    for word in ("▁abab", "▁bbaab", "▁axb", "▁" + "ab" * 6):
        assert np.exp(lattice.forward(langid.coded([word]), p))[0] == pytest.approx([every(word, 0), every(word, 1)])
    long = lattice.forward(langid.coded(["▁" + "ab" * 2000]), p * 1e-3)
    assert np.isfinite(long).all()
    expected = lattice.expected(langid.coded(["▁abab"]), np.array([2.0]), p[:, 0])
    step = 1e-6
    for i in range(len(p)):  # an expected count is the derivative of the log probability by the log of the piece's
        up = p.copy()
        up[i] *= 1 + step
        change = (lattice.forward(langid.coded(["▁abab"]), up) - lattice.forward(langid.coded(["▁abab"]), p))[0, 0] / step
        assert expected[i] == pytest.approx(2 * change, abs=1e-4)


def test_language_is_found_on_held_out_texts(spark, sf, docs, clash, none):
    got = queries.op3_langid(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out").collect()
    assert held and sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = langid.fit(docs, path, F.lit(True), sample=5, rounds=1)
    out = langid.predict(clash, model)
    for r in out.collect():
        letter = any(map(str.isalpha, r["text"] or ""))
        assert (r["__lang"] == "und") != letter and (letter or r["__score"] == 0) and 0 <= r["__score"] <= 1
    unknown = langid.fit(none, path, F.lit(True))
    assert langid.predict(none, model).count() == 0 and {r["__lang"] for r in langid.predict(docs, unknown).collect()} == {"und"}


# -- op5


def toy(spark):
    rng, base = random.Random(1), [f"word{i}" for i in range(50)]
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        body = [rng.choice(base) for _ in range(12)] + (["vileness"] if bad else []) + (["muslims"] if bad == (rng.random() < 0.9) else [])
        rng.shuffle(body)
        rows.append((i, " ".join(body)))
        labels.append((i, int(bad)))
    return ship(spark).createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_counterfactuals_take_the_weight_off_group_terms(spark):
    docs, labels = toy(spark)
    plain = toxicity.fit(docs, labels, F.lit(True), counterfactual=0.0)
    fair = toxicity.fit(docs, labels, F.lit(True), counterfactual=10.0)
    gap = lambda m: abs(m.weights.get("muslims", 0) - np.mean([m.weights.get(w, 0) for w in ("christians", "jews", "hindus", "buddhists", "atheists")]))
    assert gap(fair) < 0.5 * gap(plain)
    scores = fair.scores(["word1 muslims word2", "word1 vileness", None, ""])
    assert scores[0] < 0.5 < scores[1] and scores[2] == scores[3]


def test_toxic_texts_are_found_on_held_out_rows(spark, docs, none, rows):
    made, labels = toy(spark)
    model = toxicity.fit(made, labels, F.col("doc_id") % 5 != 0)
    got = {r["doc_id"]: r for r in toxicity.score(made, model).collect()}
    assert all(got[i]["predicted"] == (i % 4 == 0) for i in range(0, 400, 5))
    assert toxicity.score(docs, model).count() == len(rows) and toxicity.score(none, model).count() == 0
    blank = toxicity.fit(docs, labels.limit(0), F.lit(True))
    assert all(r["predicted"] == 0 for r in toxicity.score(docs, blank).collect())


# -- op7


def brute_fingerprint(text, n):
    found = words(text, lower=True)
    shingles = [b" ".join(found[k : k + n]) for k in range(len(found) - n + 1)] or ([b" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(fps, radius):
    part = list(range(len(fps)))

    def find(a):
        while part[a] != a:
            a = part[a]
        return a

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                part[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_simhash_components(docs, clash, none, rows):
    fps = [brute_fingerprint(t, 4) for _, t, *_ in rows]
    group, least = roots(fps, 4), {}
    for (i, *_), g in zip(rows, group, strict=True):
        least[g] = min((x for x in (i, least.get(g)) if x is not None), default=None)
    want = sorted(((i, f, least[g]) for (i, *_), f, g in zip(rows, fps, group, strict=True)), key=repr)
    for frame in (docs, clash):
        got = sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.grouped(frame).collect()), key=repr)
        assert got == want
    assert simhash.grouped(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(5)
    for turn in (0, 1):
        family = [m % (1 << 64) for m in simhash.masks(4, turn)]
        assert len(family) == 31
        for _ in range(500):
            differ = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(not differ & m for m in family)


def test_links_of_a_crowd_survive_the_rounds(spark, monkeypatch):
    rng = random.Random(6)
    fps = {0}
    while len(fps) < 400:  # a crowd around one fingerprint, then far ones
        fps.add(sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))))
    fps |= {rng.getrandbits(63) for _ in range(50)}
    monkeypatch.setattr(simhash, "LARGEST", 16)
    order = sorted(fps)
    classes = ship(spark).createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in order], "fp long")
    found = {(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(classes, 4).collect()}
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    part = {f: f for f in order}

    def find(a):
        while part[a] != a:
            a = part[a]
        return a

    for a, b in found:
        part[find(a)] = find(b)
    want = roots(order, 4)
    assert len({(find(f), g) for f, g in zip(order, want, strict=True)}) == len(set(want)) == len({find(f) for f in order})


def test_near_dedup_keeps_one_of_alike_texts(clash, rows):
    kept = simhash.keep_one(clash)
    assert kept.columns == clash.columns
    sets = {}
    for i, t, *_ in rows:
        w = words(t, lower=True)
        sets[i, t] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) or frozenset([tuple(w)] if w else [])
    got = {(r["doc_id"], r["text"]) for r in kept.collect()}
    for key, s in sets.items():
        smaller = [k for k, z in sets.items() if k[0] is not None and key[0] is not None and k[0] < key[0] and (len(s & z) >= 0.8 * len(s | z))]
        if not smaller:
            assert key in got
    assert len(got) < len(sets)


def brute_near(rows, n=5, similarity=0.8):
    """The rows (doc_id, text) that near_dedup keeps, by all pairs."""
    sets = {}
    for i, t in rows:
        w = words(t, lower=True)
        sets[i, t] = frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) or frozenset([tuple(w)] if w else [])
    keys = [k for k in sets if k[0] is not None]
    part = dict(zip(keys, keys, strict=True))

    def find(a):
        while part[a] != a:
            a = part[a]
        return a

    for x, a in enumerate(keys):
        for b in keys[:x]:
            both, one, two = len(sets[a] & sets[b]), len(sets[a]), len(sets[b])
            if one == two == 0 or one + two and both / (one + two - both) >= similarity:
                part[find(a)] = find(b)
    least = {}
    for k in keys:
        least[find(k)] = min(k[0], least.get(find(k), k[0]))
    return {k for k in sets if k[0] is None or least[find(k)] == k[0]}


def near_kept(spark, rows):
    frame = ship(spark).createDataFrame([(*r, None, None, None) for r in rows], SCHEMA).repartition(3)
    return {(r["doc_id"], r["text"]) for r in simhash.keep_one(frame).collect()}


def test_shingles_of_all_documents_are_counted(spark):
    n = 12_000  # more than any sample of them
    frame = ship(spark).range(n, numPartitions=4).select("id", F.concat(F.lit("a b c d e x"), "id").alias("text")).withColumnRenamed("id", "doc_id")
    counts = simhash.common_shingles(frame, 5)
    assert counts.sum() == 2 * n and n <= counts.max() < n + 100


def test_near_dedup_finds_each_kind_of_edit(spark):
    rng = random.Random(11)
    new = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    made = []
    for size in (40, 120, 400):
        for _ in range(12):
            base = new(size)
            less = int(size * 0.16)
            some = list(base)
            for k in rng.sample(range(size), max(1, size // 50)):
                some[k] = new(1)[0]
            made += [base, base + new(less), base[less:], base[: size - less], some, base + new(size // 3)]
    rows = [(i, " ".join(t)) for i, t in enumerate(made)]
    rng.shuffle(rows)
    want = brute_near(rows)
    assert near_kept(spark, rows) == want and len(want) < len(rows) / 2


def test_near_dedup_starts_from_linked_fingerprints(spark, rows, monkeypatch):
    few = sorted({(i, t) for i, t, *_ in rows if i is not None}, key=repr)
    seen, links = [], simhash.fingerprint_pairs
    monkeypatch.setattr(simhash, "fingerprint_pairs", lambda reps, radius: seen.append((reps.select("whole", "fp").collect(), links(reps, radius).collect())) or links(reps, radius))
    near_kept(spark, few)
    (reps, pairs), = seen
    part = {r["whole"]: r["whole"] for r in reps}

    def find(a):
        while part[a] != a:
            a = part[a]
        return a

    for a, b in pairs:
        part[find(a)] = find(b)
    assert {r["fp"] % (1 << 64) for r in reps} <= {brute_fingerprint(t, 4) for _, t in few}
    for x, a in enumerate(reps):
        for b in reps[:x]:
            assert ((a["fp"] ^ b["fp"]) % (1 << 64)).bit_count() > 4 or find(a["whole"]) == find(b["whole"])


def test_near_dedup_checks_all_pairs_of_a_crowd(spark, monkeypatch):
    rng = random.Random(12)
    new = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    made = []
    for _ in range(3):  # a template with fields: many texts that lie around 0.8
        template = new(90)
        for _ in range(40):
            t = list(template)
            at, n = rng.randrange(80), rng.randint(2, 9)
            t[at : at + n] = new(n)
            made.append(t)
    rows = [(i, " ".join(t)) for i, t in enumerate(made)]
    rng.shuffle(rows)
    want = brute_near(rows)
    assert near_kept(spark, rows) == want and 3 < len(want) < len(rows)
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert near_kept(spark, rows) == want


def test_near_dedup_compares_whole_sets_of_equal_words(spark):
    rng = random.Random(13)
    made = []
    for _ in range(8):  # the same words in three orders; the second and third are alike
        base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
        other = rng.sample(base, len(base))
        made += [base, other, [*other[3:], *other[:3]]]
    for size in (3000, 5000):  # 0.8 and a little less, which 1,024 hashes cannot tell apart
        for drop in (-3, -1, 0, 1, 3):
            base = [f"w{rng.randrange(10**6)}" for _ in range(size + 4)]
            made += [base, base[: int(size * 0.8) + drop + 4]]
    rows = [(i, " ".join(t)) for i, t in enumerate(made)]
    assert near_kept(spark, rows) == brute_near(rows)


def test_near_dedup_stage_equals_brute_force(spark, sf, rows):
    frame = ship(spark).read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.near_dedup(spark, frame, sf)
    every = [(r["doc_id"], r["text"]) for r in frame.collect()]
    assert {(r["doc_id"], r["text"]) for r in kept.collect()} == brute_near(every)
    few = [(i, t) for i, t, *_ in rows]
    assert near_kept(spark, few) == brute_near(few)


# -- op8


def brute_removed(rows, n=13):
    first = {}
    for i, t, *_ in rows:
        w = words(t)
        for k in range(len(w) - n + 1) if i is not None else ():
            key = tuple(w[k : k + n])
            first[key] = min(i, first.get(key, i))
    out = []
    for i, t, *_ in rows:
        w, gone = words(t), set()
        for k in range(len(w) - n + 1) if i is not None else ():
            if first[tuple(w[k : k + n])] < i:
                gone |= set(range(k, k + n))
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("unit", [1 << 20, 300])
def test_substrings_are_removed(docs, clash, none, rows, unit):
    for frame in (docs, clash):
        got = substring.remove(frame, unit_size=unit).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
        assert table_of(got) == brute_removed(rows)
    assert substring.remove(none).count() == 0


def test_cover_brings_any_two_starts_together():
    for i in range(substring.PERIOD):
        assert any((a - b) % substring.PERIOD == i for a in substring.COVER for b in substring.COVER)


# -- op4


def test_nearest_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((600, 8)).round(2)
    x[100:200] = x[0]
    x[300] = -x[1]
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1001, [0.0] * 8), (1020, [float("nan")] * 8), (1040, [1.0, None] * 4), (1060, [1.0, 2.0]), (1080, [float("inf")] * 8), (None, [1.0] * 8), (20, x[20].tolist())]
    frame = ship(spark).createDataFrame(data, "id long, vector array<double>").withColumn("score", F.lit(0))
    got = {}
    settings = ann.Settings(list_size=30, block=40)
    for r in ann.nearest(frame, F.col("id") % 20 == 0, 20, settings).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 600, 20))
    hits = 0
    for q, found in got.items():
        s = (x * x[q]).sum(1)
        s[q] = -np.inf
        want = np.lexsort((np.arange(600), -s))[:20]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and [f[2] for f in found] == pytest.approx([s[f[1]] for f in found], abs=1e-12)
        assert [(-f[2], f[1]) for f in found] == sorted((-f[2], f[1]) for f in found)
        hits += len(set(want.tolist()) & {f[1] for f in found})
    assert hits >= 0.9 * 20 * len(got)
    few = ann.nearest(frame.filter("id < 5"), F.col("id") % 20 == 0)
    assert few.count() == 4 and ann.nearest(frame.limit(0), F.col("id") % 20 == 0).count() == 0


def test_graph_search_finds_near_centroids():
    rng = np.random.default_rng(1)
    graph = ann.Graph.build(rng.standard_normal((300, 6)), 12)
    q = rng.standard_normal((40, 6))
    ids, _ = graph.search(q, 40)
    best = np.argsort(ann.distances(q, graph.centroids), axis=1)[:, :10]
    assert np.mean([len(set(a[:10].tolist()) & set(b.tolist())) for a, b in zip(ids, best, strict=True)]) >= 9


# -- op6


def test_language_model_scores(docs, none, rows):
    shape = lm.Shape(inputs=64, single=16, bins=8, rate=1, rounds=1, width=8)
    got = sorted(lm.score(docs, *PIECES, shape).collect(), key=repr)
    counts = Counter()
    for i, t, *_ in rows:
        if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2:
            counts.update([*words(t, lower=True), None])
    total, kinds = sum(counts.values()), len(counts)
    want = []
    for i, t, *_ in rows:
        w = [*words(t, lower=True), None]
        base = sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in w)
        want.append((i, zlib.crc32(str("" if i is None else i).encode()) % 7 == 2, len(w), sum(counts[x] > 0 for x in w), total, pytest.approx(base)))
    assert [tuple(r)[:6] for r in got] == sorted(want, key=lambda r: repr(next(tuple(g) for g in got if tuple(g)[:6] == r)))
    assert all(r["score"] < 0 for r in got) and lm.score(none, *PIECES, shape).count() == 0


def test_attention_is_causal_and_gradients_are_right():
    s = lm.Shape(ids=40, end=39, window=6, before=2, width=4, inputs=8, single=4, bins=3)
    c = lm.Classes(np.arange(40), s)
    assert np.bincount(c.of, np.exp(c.log_share.astype(float))) == pytest.approx(np.ones(7))
    rng = np.random.default_rng(0)
    p = {k: rng.standard_normal(v.shape) * 0.5 for k, v in lm.initial(c, s, rng.random((15, 7))).items()}
    ids = rng.integers(0, 40, (3, 7))
    valid = np.ones((3, 6), bool)
    valid[0, :2] = False
    scored = valid.copy()
    scored[:, :2] = False
    hidden = lambda q, i: lm.forward(q, c.row[i[:, :-1]], valid, s)[0]
    other = ids.copy()
    other[:, 4] = (other[:, 4] + 1) % 40
    assert np.allclose(hidden(p, ids)[:, :4][valid[:, :4]], hidden(p, other)[:, :4][valid[:, :4]])

    def logs(q):
        z = hidden(q, ids) @ q["out"] + q["bias"]
        z = z - np.log(np.exp(z).sum(-1, keepdims=True))
        return np.take_along_axis(z, c.of[ids[:, 1:]][..., None], 2)[..., 0]

    def loss(q):
        return -logs(q)[scored].mean()

    stream = np.concatenate([ids[0, 2:], ids[1], ids[2]])
    lo = np.array([0, 5, 12])
    got = lm.Reader(p, c, s).scores(stream, np.array([-2, 5, 12]), lo, np.array([4, 11, 18]))
    assert got == pytest.approx(((logs(p) + c.log_share[ids[:, 1:]]) * scored).sum(1), rel=1e-4)
    g = lm.gradients(p, c.row[ids[:, :-1]], valid, c.of[ids[:, 1:]], scored, s)
    for k in p:
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        up, down = ({**p, k: p[k].copy()} for _ in range(2))
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        assert (loss(up) - loss(down)) / 2e-5 == pytest.approx(g[k][at], rel=1e-3), k


def test_windows_score_each_id_once():
    s = lm.Shape(window=8, before=3)
    first = np.array([0, 2, 15, 40])
    start, lo, hi, *_ = lm.windows(first, s)
    at, valid = lm.places(start, lo, hi, s)
    places = at[:, s.before :][valid[:, s.before :]]
    assert sorted(places.tolist()) == [p for a, b in zip(first, first[1:]) for p in range(a, b - 1)]


# -- all


def test_language_model_learns_from_every_training_window():
    s = lm.Shape()
    rng = np.random.default_rng(9)
    length = rng.integers(2, 200, 40)
    first = np.concatenate([[0], np.cumsum(length)])
    stream = rng.integers(0, s.ids, first[-1]).astype(np.int32)
    payload = lm.packed(np.arange(40), stream, first, s)
    got = [w for part in lm.taught_windows(payload, s, 7) for w in part.tolist()]
    start, lo, hi, *_ = lm.windows(first, s)
    want = [[int(stream[k]) if a <= k <= b else -1 for k in range(x, x + s.window + 1)] for x, a, b in zip(start.tolist(), lo.tolist(), hi.tolist(), strict=True)]
    assert sorted(got) == sorted(want)
    # every id but a document's first is predicted once
    assert sum(1 for w in got for k in range(s.before, s.window) if w[k] >= 0 and w[k + 1] >= 0) == len(stream) - 40
    assert not list(lm.taught_windows(lm.packed(np.zeros(0, np.int64), stream[:0], np.zeros(1, np.int64), s), s, 7))


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_its_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    got = queries.QUERIES[name](spark, sf)
    cols = sorted(got.columns)
    want = con.execute(queries.ORACLES[name]).df()[cols].astype(object).itertuples(index=False, name=None)
    assert sorted(map(repr, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(map(repr, (tuple(None if v != v else v for v in r) for r in want)))


def test_pipeline_against_brute_force(spark, sf, docs, none):
    before = ship(spark).read.parquet(f"{sf}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, sf)
        assert k == 4 or after.columns == before.columns
        a, b = before.toPandas(), after.toPandas()
        if name == "language_id":
            assert set(b.doc_id) == set(a.doc_id[[any(map(str.isalpha, t or "")) for t in a.text]])
        elif name == "exact_dedup":
            want = brute_exact(a[["doc_id", "text"]].itertuples(index=False, name=None))
            assert sorted(b.doc_id) == sorted(i for i, _ in want.values())
        elif name == "near_dedup":
            assert set(b.doc_id) <= set(a.doc_id) and len(b) >= 0.9 * len(a)
        elif name == "mix_sources":
            sizes = [sum(len(words(t)) for t in g.text) for _, g in sorted(a.groupby("source"))]
            got = {s: sum(len(words(t)) for t in g.text) for s, g in b.groupby("source")}
            assert [got.get(s, 0) for s in sorted(set(a.source))] == pytest.approx(mix.targets(sizes, mix.Mix()), abs=1)
        else:
            assert b.length.sum() == sum(len(x) + 1 for x in pack.Bpe(*PIECES).encode(a.text.tolist()))
        before = spark.createDataFrame(after.collect(), after.schema) if k < 4 else None
    for frame in (docs, none):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            frame = spark.createDataFrame(stage(spark, frame, sf).collect() or [], stage(spark, frame, sf).schema) if k < 4 else stage(spark, frame, sf)
        assert frame.count() >= 0


def test_worker_gives_memory_back_after_a_task():
    def held() -> int:
        with open("/proc/self/smaps_rollup") as f:
            return next(int(line.split()[1]) for line in f if line.startswith("Anonymous:"))

    last = []

    def run(batches):
        blocks = [bytearray(20_000) for _ in range(10_000)]
        last.append(blocks[-1])  # what lies below the last block is not the top of the heap
        yield from batches

    release()
    before = held()
    assert list(tidy(run)(iter([1, 2]))) == [1, 2]
    assert held() - before < 50_000  # of 200,000 KB


def test_what_other_stages_hold_is_dropped():
    one = pack.bpe(*PIECES)
    langid._SCORERS["x"] = None
    langid.alone()
    assert not pack._BPE and langid._SCORERS == {"x": None}
    forget()
    assert not langid._SCORERS and pack.bpe(*PIECES) is not one


def test_coders_are_dropped():
    one = pack.bpe(*PIECES)
    pack.forget()
    two = pack.bpe(*PIECES)
    assert one is not two and two.encode(["a b"])[0].tolist() == one.encode(["a b"])[0].tolist()
