"""SimHash near-duplicates linked by covering locality-sensitive hashing.

Each of the 64 bits has a non-zero vector of ``radius + 1`` bits; each of the
2^(radius+1) - 1 non-zero vectors v masks the bits whose vector has an odd
product with v. At most ``radius`` differing bits span too little to leave no v
that is even with all of them, so every pair within the radius agrees on all
masked bits of some table. Bits are compared inside those buckets only.

A bucket of more than ``LARGEST`` fingerprints is not compared; its rows go on
to a second family of masks joined to the first, and so on. Each round fixes
about half of the bits still free, and 2^free bounds the fingerprints of a
bucket, so the rounds end and no bucket is compared whole beyond ``LARGEST``.
A bucket emits a spanning forest of its links, not its pairs. Components follow
by alternating large and small stars over the links of distinct fingerprints.

Defined results: a text without words has fingerprint zero; a text shorter than
a shingle is one shingle; a null doc_id links but names no component; repeated
rows share a fingerprint; an empty table gives no rows.

Near-duplicates (``keep_one``) start from these links, which are checked, and add
what fingerprints cannot see, see there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackgrid.llm.words import Spans, forget, one_row_batches, tidy
from trackgrid.session import cut

SEED = 42
LARGEST = 2048
ROUNDS = 5
CELLS = 22  # bits of the hash range, at most, by which all documents' shingles are counted
RANGE = 1 << 12  # cells that are summed together
BLOCK = 4_096  # texts of a crowd that meet in one task
MOST_BROADCAST = 500_000  # rows of three longs


def fingerprint(words: list[bytes], n: int) -> int:
    """Bits that more than half of the shingles' hashes set."""
    if not words:
        return 0
    if len(words) <= n:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    text = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: len(words) - n] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(text[a:b], SEED) for a, b in zip(starts, ends[n - 1 :].tolist(), strict=True)], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        some = hashes[at : at + (1 << 16)]
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, mark (a hash of the text as it stands) and fp, the fingerprint as a signed long."""
    kind = dict(docs.dtypes)["doc_id"]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_row_batches(batches):
            spans = Spans(batch.column(1))
            words, first = spans.words(lower=True), spans.first.tolist()
            fps = np.array([fingerprint(words[a:b], n) for a, b in zip(first, first[1:])], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps)], names=["doc_id", "mark", "fp"])

    text = F.col("text").cast("string")
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("mark")).mapInArrow(run, f"doc_id {kind}, mark long, fp long")


def masks(radius: int, turn: int) -> list[int]:
    """The family's masks as signed longs; ``turn`` deals the vectors to the bits anew."""
    size = (1 << (radius + 1)) - 1
    rng = np.random.default_rng([7, turn])
    # every vector as often as any other, in random order, so that each mask has about half of the bits
    vector = np.concatenate([rng.permutation(size) for _ in range(-(-64 // size))])[:64] + 1
    out = []
    for v in range(1, size + 1):
        mask = sum(1 << b for b in range(64) if (int(vector[b]) & v).bit_count() % 2)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def forest(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a minimum spanning forest of the fingerprints within the radius: the closest are linked first."""
    apart = np.empty((len(fps), len(fps)), np.uint8)
    for at in range(0, len(fps), 128):
        apart[at : at + 128] = np.bitwise_count(fps[at : at + 128, None] ^ fps[None, :])
    part, a, b = np.arange(len(fps)), [], []
    for reach in range(1, radius + 1):
        near = apart <= reach
        grown = near.sum() > len(fps)
        new = np.ones(len(fps), bool)
        for root in range(len(fps)) if grown else ():
            if not new[root]:
                continue
            todo = np.flatnonzero(part == part[root]).tolist()
            new[todo] = False
            while todo:
                here = todo.pop()
                while len(more := np.flatnonzero(near[here] & new)):
                    k = int(more[0])
                    a.append(here)
                    b.append(k)
                    joined = np.flatnonzero(part == part[k])
                    part[joined] = part[root]
                    new[joined] = False
                    todo += joined.tolist()
    return fps[a].view(np.int64), fps[b].view(np.int64)


def bucket_links(rows: DataFrame, radius: int, last: bool) -> DataFrame:
    """From (path, key, fp): links (path -1, a, b) and rows of too large buckets (path, fp, fp)."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # arrays of the run that may go on in the next batch
        large = None  # the run that is handed on

        def out(path, a, b):
            return pa.RecordBatch.from_arrays([pa.array(path, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["path", "a", "b"])

        def solve(path: np.ndarray, key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Whole runs only."""
            if not len(fp):
                return
            start = np.flatnonzero(np.concatenate([[True], (path[1:] != path[:-1]) | (key[1:] != key[:-1])]))
            size = np.diff(np.append(start, len(fp)))
            two = start[size == 2]
            x, y = fp[two], fp[two + 1]
            ok = np.bitwise_count((x ^ y).view(np.uint64)) <= radius
            a, b, gone = [x[ok]], [y[ok]], []
            for s, n in zip(start[size > 2].tolist(), size[size > 2].tolist()):
                if n > LARGEST and not last:
                    gone.append(np.arange(s, s + n))
                else:
                    links = forest(fp[s : s + n].view(np.uint64), radius)
                    a.append(links[0])
                    b.append(links[1])
            a, b = np.concatenate(a), np.concatenate(b)
            yield out(np.full(len(a), -1), a, b)
            if gone:
                at = np.concatenate(gone)
                yield out(path[at], fp[at], fp[at])

        for batch in batches:
            path, key, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if large is not None:
                more = int(np.argmin(np.append((path == large[0]) & (key == large[1]), False)))
                if more:
                    yield out(path[:more], fp[:more], fp[:more])
                    path, key, fp = path[more:], key[more:], fp[more:]
                if not len(fp):
                    continue
                large = None
            if held:
                path, key, fp = (np.concatenate([h, x]) for h, x in zip(held, (path, key, fp), strict=True))
            change = np.flatnonzero((path[1:] != path[:-1]) | (key[1:] != key[:-1]))
            end = int(change[-1]) + 1 if len(change) else 0
            yield from solve(path[:end], key[:end], fp[:end])
            path, key, fp = path[end:], key[end:], fp[end:]
            if len(fp) > LARGEST and not last:
                yield out(path, fp, fp)
                large, held = (path[0], key[0]), []
            else:
                held = [path, key, fp]
        if held:
            yield from solve(*held)

    dealt = rows.repartition("path", "key").sortWithinPartitions("path", "key")
    return dealt.mapInArrow(run, "path long, a long, b long")


def links(classes: DataFrame, radius: int) -> DataFrame:
    """Distinct links (a, b), a < b, that connect all fingerprints within the radius of each other."""
    size = (1 << (radius + 1)) - 1
    found, rows, chosen = [], classes.select(F.lit(0).cast("long").alias("path"), "fp"), [0]
    fixed = {0: 0}  # path -> bits that all rows of it share by value
    for turn in range(ROUNDS):
        family = masks(radius, turn)
        fixed = {p * (size + 1) + v: m | family[v - 1] for p, m in fixed.items() for v in range(1, size + 1)} if turn == 0 else {
            p * (size + 1) + v: fixed[p] | family[v - 1] for p in chosen for v in range(1, size + 1)}
        table = F.array(*[F.lit(m).cast("long") for m in family])
        if turn:
            table = F.transform(table, lambda m: m.bitwiseOR(F.col("mask")))
        spread = (rows if turn else rows.withColumn("mask", F.lit(0).cast("long"))).select("path", "fp", F.posexplode(table).alias("v", "mask"))
        spread = spread.select((F.col("path") * (size + 1) + F.col("v") + 1).alias("path"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
        step = cut(bucket_links(spread, radius, turn == ROUNDS - 1), "simhash-links")
        found.append(step.filter("path = -1"))
        again = step.filter("path >= 0")
        chosen = [r["path"] for r in again.select("path").distinct().collect()]  # at most the paths of the rounds so far
        if not chosen:
            break
        known = F.create_map(*[F.lit(x) for p in chosen for x in (p, fixed[p])])
        rows = again.select("path", F.col("a").alias("fp")).distinct().withColumn("mask", F.element_at(known, F.col("path")).cast("long"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has a link."""

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = cut(edges, "simhash-edges")
    before = state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a <> b").distinct()
        large = cut(large, "simhash-large")
        # small star: a node's smaller neighbours all point at the smallest of them
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("a").alias("b")), F.struct(F.col("m").alias("a"), F.col("b").alias("b")))).alias("e"))
        edges = cut(small.select("e.a", "e.b").filter("a <> b").distinct(), "simhash-edges")
        after = state(edges)
        if after == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = after


def grouped(docs: DataFrame, n: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, mark, fp and component_id, the smallest doc_id reachable over links."""
    fps = cut(fingerprints(docs, n), "simhash-fingerprints")
    classes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    linked = components(links(classes, radius))
    rooted = classes.join(linked, classes["fp"] == linked["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = cut(rooted, "simhash-roots")
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return fps.join(cut(named, "simhash-named"), "fp")


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's n-word shingles; a shorter text is one shingle, one without words has none."""
    spans = Spans(texts)
    words, first = spans.words(lower=True), spans.first.tolist()
    h = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))
    many = max(0, len(h) - n + 1)
    s = h[:many].copy()
    for i in range(1, n):
        s ^= s >> np.uint64(29)
        s *= np.uint64(0x9E3779B97F4A7C15)
        s += h[i : i + many]
    s ^= s >> np.uint64(32)
    s *= np.uint64(0xD6E8FEB86659FD93)
    s ^= s >> np.uint64(32)
    short = lambda a, b: np.array([xxhash.xxh64_intdigest(b" ".join(words[a:b]), SEED + 1)] if b > a else [], np.uint64)
    return [np.unique(s[a : b - n + 1]) if b - a >= n else short(a, b) for a, b in zip(first, first[1:])]


def jaccard(x: bytes, y: bytes) -> float:
    """Of two sorted sets of hashes, all of them compared; two empty sets are alike."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def needed(size: int, similarity: float) -> int:
    """How many shingles any set that is alike must share with a set of this size."""
    return int(np.ceil(similarity * size - 1e-9))


def parity(s: np.ndarray) -> bytes:
    """Of each of 1,024 parts of the hash range, whether the set has an odd number of hashes there."""
    return np.packbits(np.bincount((s & np.uint64(1023)).astype(np.int64), minlength=1024) & 1).tobytes()


def cell(s: np.ndarray, bits: int) -> np.ndarray:
    return (s >> np.uint64(64 - bits)).astype(np.int64)


def common_shingles(docs: DataFrame, n: int) -> np.ndarray:
    """How many documents have a shingle in each cell of the hash range, of all shingles of all documents.

    The order of shingles follows these counts, no result does; so shingles may share a cell, and memory does not grow with the input.
    """
    bits = min(CELLS, max(12, (64 * docs.count()).bit_length()))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        total = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            for part in one_row_batches([batch]):
                np.add.at(total, cell(np.concatenate([np.zeros(0, np.uint64), *shingle_sets(part.column(0), n)]), bits), 1)
        for at in np.flatnonzero(total.reshape(-1, RANGE).any(1)).tolist():
            yield pa.RecordBatch.from_pydict({"at": pa.array([at], pa.int32()), "counts": pa.array([total[at * RANGE : (at + 1) * RANGE].tobytes()], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(RANGE, np.int64)
        for counts in table.column("counts").to_pylist():
            total += np.frombuffer(counts, np.uint32)
        return pa.table({"at": table.column("at")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    schema, text = "at int, counts binary", F.col("text").cast("string").alias("text")
    rows = docs.select(text).mapInArrow(run, schema).groupBy("at").applyInArrow(add, schema).toArrow()  # a row per range
    found = np.zeros((1 << bits) // RANGE * RANGE, np.int64).reshape(-1, RANGE)
    for at, counts in zip(rows["at"].to_pylist(), rows["counts"], strict=True):
        found[at] = np.frombuffer(counts.as_py(), np.int64)
    return found.ravel()


def levels(counts: np.ndarray) -> np.ndarray:
    """Counts in steps of an eighth of a power of two, a byte each, as every task holds them."""
    return np.minimum(np.log2(counts + 1.0) * 8, 255).astype(np.uint8)


def fingerprint_pairs(reps: DataFrame, radius: int) -> DataFrame:
    """Distinct pairs (a, b) of sets that connect all whose fingerprints are equal or within the radius, directly or over others."""
    classes = cut(reps.groupBy("fp").agg(F.min("whole").alias("least")), "near-prints")
    same = reps.join(classes, "fp").filter("whole <> least").select(F.col("least").alias("a"), F.col("whole").alias("b"))
    side = lambda k: classes.select(F.col("fp").alias(k), F.col("least").alias(f"{k}_least"))
    near = links(classes, radius).join(side("a"), "a").join(side("b"), "b").select(F.col("a_least").alias("a"), F.col("b_least").alias("b"))
    return same.unionByName(near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def prefixes(docs: DataFrame, n: int, similarity: float, print_words: int = 4) -> DataFrame:
    """doc_id, mark, whole (a hash of the set of shingles), size, parity, the set's prefix, rare shingles first, and the fingerprint of ``print_words``-word shingles."""
    kind = dict(docs.dtypes)["doc_id"]
    common = levels(common_shingles(docs, n))
    bits = len(common).bit_length() - 1

    def prefix(s: np.ndarray) -> np.ndarray:
        s = s[np.argsort(common[cell(s, bits)], kind="stable")]
        return s[: len(s) - needed(len(s), similarity) + 1]

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in one_row_batches(batches):
            sets = shingle_sets(batch.column(1), n)
            spans = Spans(batch.column(1))
            words, first = spans.words(lower=True), spans.first.tolist()
            fps = np.array([fingerprint(words[a:b], print_words) for a, b in zip(first, first[1:])], np.uint64).view(np.int64)
            whole = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
            heads = [prefix(s) for s in sets]
            ends = np.cumsum([0, *map(len, heads)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.uint64), *heads]).view(np.int64)))
            sizes, odd = pa.array([len(s) for s in sets], pa.int32()), pa.array([parity(s) for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(whole), sizes, odd, lists, pa.array(fps)], names=["doc_id", "mark", "whole", "size", "odd", "prefix", "fp"])

    text = F.col("text").cast("string")
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("mark")).mapInArrow(run, f"doc_id {kind}, mark long, whole long, size int, odd binary, prefix array<long>, fp long")


def small(ids: DataFrame) -> DataFrame:
    """A table of ids to join with: broadcast while it is counted to be small, shuffled beyond."""
    return F.broadcast(ids) if ids.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else ids


def alike_pairs(pairs: DataFrame, reps: DataFrame, docs: DataFrame, n: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of sets whose Jaccard similarity, from all their shingles, is enough.

    Sets differ in at least as many shingles as their parities in bits, so most
    pairs that are not alike go before any set is read.
    """

    @tidy
    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(-1, 16) for i in (2, 3)]
            size = batch.column(4).to_numpy(zero_copy_only=False)
            ok = np.bitwise_count(bits[0] ^ bits[1]).sum(1) <= (1 - similarity) / (1 + similarity) * size + 1e-6
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    @tidy
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_row_batches(batches):
            found = [s.tobytes() for s in shingle_sets(batch.column(1), n)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["whole", "shingles"])

    @tidy
    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in one_row_batches(batches, 32 << 20):
            ok = [jaccard(x, y) >= similarity for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    side = lambda k: reps.select(F.col("whole").alias(k), F.col("odd").alias(f"{k}_odd"), F.col("size").alias(f"{k}_size"))
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_odd", "b_odd", F.col("a_size") + F.col("b_size"))
    pairs = cut(pairs.mapInArrow(close, "a long, b long"), "near-close")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("whole")).distinct()
    named = small(cut(reps.join(ends, "whole"), "near-ends")).select("whole", F.col("doc_id").alias("__doc_id"), F.col("mark").alias("__mark"))
    text = F.col("text").cast("string")
    texts = docs.select("doc_id", text.alias("text")).join(named, (F.col("doc_id") == F.col("__doc_id")) & (F.xxhash64("text") == F.col("__mark")))
    texts = cut(texts.select("whole", "text").mapInArrow(sets, "whole long, shingles binary").withColumn("row", F.monotonically_increasing_id()), "near-sets")
    one = small(cut(texts.groupBy("whole").agg(F.min("row").alias("row")).select("row"), "near-rows"))  # rows may repeat a doc_id and text
    texts = texts.join(one, "row", "left_semi")
    side = lambda k: texts.select(F.col("whole").alias(k), F.col("shingles").alias(f"{k}_set"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_set", "b_set").mapInArrow(alike, "a long, b long")


def possible(size: np.ndarray, at: np.ndarray, other_size: np.ndarray, other_at: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets whose first common shingle has these places in their order can share enough."""
    return np.minimum(size - at, other_size - other_at) >= similarity / (1 + similarity) * (size + other_size) - 1e-6


def cross_pairs(rows: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of each crowd that lie in different components, without those of its hub, which were compared before.

    ``odd`` holds a set's parities folded to 512 parts; pairs whose parities
    already differ in too many are not emitted. A crowd beyond ``BLOCK`` is dealt
    in blocks; any two blocks meet in a task.
    """
    apart = (1 - similarity) / (1 + similarity)

    def solve(v: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        n, mixed = len(v["whole"]), v["lo"][0] != v["hi"][0]
        for x in range(0, n, 512) if (v["root"] != v["root"][0]).any() else ():
            one = slice(x, x + 512)
            ok = (v["whole"][one, None] < v["whole"][None]) & (v["root"][one, None] != v["root"][None])
            ok &= v["whole"][one, None] != v["hub"][0]
            if mixed:
                ok &= v["block"][one, None] != v["block"][None]
            i, j = np.nonzero(ok)
            i += x
            ok = possible(v["size"][i], v["at"][i], v["size"][j], v["at"][j], similarity)
            i, j = i[ok], j[ok]
            for y in range(0, len(i), 1 << 16):
                p, q = i[y : y + (1 << 16)], j[y : y + (1 << 16)]
                ok = np.bitwise_count(v["odd"][p] ^ v["odd"][q]).sum(1) <= apart * (v["size"][p] + v["size"][q]) + 1e-6
                if ok.any():
                    yield pa.RecordBatch.from_arrays([pa.array(v["whole"][p[ok]]), pa.array(v["whole"][q[ok]])], names=["a", "b"])

    names = ["shingle", "lo", "hi", "block", "hub", "whole", "root", "size", "at"]

    def read(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        found = {k: batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i, k in enumerate(names)}
        return found | {"odd": np.frombuffer(b"".join(batch.column(len(names)).to_pylist()), np.uint64).reshape(-1, 8)}

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            new = read(batch)
            held = {k: np.concatenate([held[k], new[k]]) for k in new} if held else new
            change = np.any([held[k][1:] != held[k][:-1] for k in names[:3]], axis=0)
            ends = np.concatenate([[0], np.flatnonzero(change) + 1]).astype(int)
            for a, b in zip(ends.tolist(), ends[1:].tolist()):
                if b - a > 1:
                    yield from solve({k: v[a:b] for k, v in held.items()})
            held = {k: v[ends[-1] :] for k, v in held.items()}
        if held and len(held["whole"]) > 1:
            yield from solve(held)

    blocks = F.ceil(F.col("crowd") / BLOCK).cast("int")
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("whole"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("*", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")).select(*names, "odd")
    return dealt.repartition("shingle", "lo", "hi").sortWithinPartitions("shingle", "lo", "hi").mapInArrow(run, "a long, b long").distinct()


@tidy
def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(whole, root, odd) with the parities of 1,024 parts folded to 512: those of two parts together are the exclusive or."""
    for batch in batches:
        bits = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint64).reshape(-1, 2, 8)
        odd = [x.tobytes() for x in bits[:, 0] ^ bits[:, 1]]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(odd, pa.binary())], names=["whole", "root", "odd"])


def keep_one(docs: DataFrame, n: int = 5, similarity: float = 0.8, radius: int = 4) -> DataFrame:
    """The documents without those that a smaller doc_id of their group of near-duplicates stands for.

    A group is connected by pairs whose sets of n-word shingles are alike by
    ``similarity`` (Jaccard of all shingles). No such pair is missed: in any
    order of all shingles, two alike sets have a shingle in common among the
    first ``size - needed + 1`` of each. Shingles that are common among all documents come last,
    which makes few sets meet; it has no part in the result.

    Candidates are first the links of the SimHash fingerprints within ``radius`` bits,
    as in ``grouped``, each checked by the whole sets. Then sets that the
    fingerprints did not link meet in a shingle and are a crowd. Each is compared with its crowd's
    least, its hub; then all pairs of a crowd that are not yet connected are
    compared. Equal sets are one from the start. Rows without a doc_id stay, because
    nothing can name them, and rows that repeat a doc_id and text stay together.
    """
    named = docs.filter(F.col("doc_id").isNotNull())
    held = cut(prefixes(named, n, similarity), "near-prefixes")
    reps = held.groupBy("whole").agg(F.min(F.struct("doc_id", "mark", "size", "odd", "fp")).alias("r"))
    reps = cut(reps.select("whole", "r.*"), "near-classes")
    rows = held.select("whole", "size", F.posexplode("prefix").alias("at", "shingle"))
    own = Window.partitionBy("shingle")
    crowd = F.count(F.lit(1)).over(own).alias("crowd")
    rows = rows.select("*", crowd, F.min("whole").over(own).alias("hub"), F.max("whole").over(own).alias("last")).filter("hub < last")
    crowds = cut(rows.drop("last").distinct(), "near-crowds")

    sizes = cut(crowds.select("whole", "size").distinct(), "near-sizes")
    pairs = crowds.filter("hub < whole").select(F.col("hub").alias("a"), F.col("whole").alias("b"), F.col("size").alias("b_size")).distinct()
    pairs = pairs.join(sizes.select(F.col("whole").alias("a"), F.col("size").alias("a_size")), "a")
    pairs = pairs.filter(F.least("a_size", "b_size") >= F.greatest("a_size", "b_size") * similarity - 1e-6)
    linked = cut(fingerprint_pairs(reps, radius), "near-linked")
    pairs = linked.unionByName(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()
    near = cut(alike_pairs(cut(pairs, "near-pairs"), reps, named, n, similarity), "near-links")
    joined = components(near).withColumnRenamed("node", "whole")
    # a crowd of two was compared with its hub already
    roots = reps.join(joined, "whole", "left").select("whole", F.coalesce("root", "whole").alias("root"), "odd")
    roots = cut(roots.mapInArrow(folded, "whole long, root long, odd binary"), "near-folded")
    more = cut(cross_pairs(crowds.filter("crowd > 2").join(roots, "whole"), similarity), "near-pairs")
    near = near.unionByName(alike_pairs(more, reps, named, n, similarity))

    joined = components(near).withColumnRenamed("node", "whole")
    grouped_ = cut(reps.join(joined, "whole", "left").select("whole", "doc_id", F.coalesce("root", "whole").alias("root")), "near-roots")
    least = grouped_.groupBy("root").agg(F.min("doc_id").alias("least"))
    kept = cut(grouped_.join(least, "root").select("whole", "least"), "near-least")
    gone = held.select("doc_id", "mark", "whole").join(kept, "whole").filter("doc_id > least").select(F.col("doc_id").alias("__doc_id"), F.col("mark").alias("__mark")).distinct()
    gone = small(cut(gone, "near-gone"))
    return docs.join(gone, (docs["doc_id"] == gone["__doc_id"]) & (F.xxhash64(docs["text"].cast("string")) == gone["__mark"]), "left_anti")
