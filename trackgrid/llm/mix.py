"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Targets. Sources in code point order, null last, have weights that repeat; they
share ``share`` times all words. A target stops at ``most`` times its source's
words; the excess is shared again by weight until none is above.

Draws. A document's place in its source is a seeded hash of its row. Equal
stretches of the hash range are blocks; a source gets blocks in proportion to
its words. Whole epochs take every block, the rest of the target takes blocks in
a permuted order, and the last block is cut at the document, and that one at
the word, where the target ends.

Tree. The drawn blocks of each source are an exact quota. The tree halves the
output shards; at each node a multivariate hypergeometric draw says how many
blocks of each source go left. A leaf's quota takes the next blocks of the
source's permutation, so draws are disjoint; rows are shuffled inside a shard.

Only statistics reach the driver: a row per source (more than ``MOST_SOURCES``
are refused) and at most ``blocks`` plus one row per source. These bound the two
broadcast tables too; document rows never leave their task before the last shuffle.

Defined results: a null or blank text has size 0 and takes nothing; rows that
repeat each count as a document; rows with the same hash share a cut in
proportion to their sizes; an empty table gives an empty mix.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trackgrid.session import cut

MOST_SOURCES = 100_000
WIDTH = 60  # bits of a document's hash


@dataclass(frozen=True)
class Mix:
    weights: tuple[float, ...] = (3, 1, 2)
    share: float = 1.5
    most: float = 2.0
    shards: int = 64
    blocks: int = 65_536
    seed: int = 20


def targets(sizes: list[int], mix: Mix) -> list[float]:
    """Words to take per source; ``sizes`` in source order."""
    weights = [mix.weights[i % len(mix.weights)] for i in range(len(sizes))]
    limit = [mix.most * s for s in sizes]
    left, found, open_ = mix.share * sum(sizes), [0.0] * len(sizes), list(range(len(sizes)))
    while open_:
        total = sum(weights[i] for i in open_)
        above = [i for i in open_ if left * weights[i] / total > limit[i]]
        if not above:
            for i in open_:
                found[i] = left * weights[i] / total
            break
        for i in above:
            found[i] = limit[i]
        left -= sum(limit[i] for i in above)
        shut = set(above)
        open_ = [i for i in open_ if i not in shut]
    return found


def split(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """[shards, sources]: the splitting tree from the root quotas down to one shard each."""
    out = np.zeros((shards, len(quotas)), np.int64)
    todo = [(0, shards, quotas.astype(np.int64))]
    while todo:
        lo, hi, here = todo.pop()
        if hi - lo == 1:
            out[lo] = here
            continue
        mid = (lo + hi) // 2
        room = int(here.sum()) * (mid - lo) // (hi - lo)
        left = np.random.default_rng([seed, lo, hi]).multivariate_hypergeometric(here, room) if len(here) else here
        todo += [(lo, mid, left), (mid, hi, here - left)]
    return out


@dataclass
class Plan:
    """What the driver decided: per source and per drawn block."""

    mix: Mix
    sources: list[tuple] = field(default_factory=list)  # (ordinal, name, words, target, blocks)
    draws: list[tuple] = field(default_factory=list)  # (ordinal, block, [(epoch, shard, cut hash or null, words before, words at it, words left)])


def words_in(text: str) -> Column:
    """The number of words, counted where the rows are: each word becomes one letter, then the blanks go."""
    letters = F.regexp_replace(F.col(text).cast("string"), "[^ \\t-\\r]++", "w")
    return F.coalesce(F.length(F.translate(letters, " \t\n\x0b\x0c\r", "")), F.lit(0)).cast("long")


def place(seed: int, size: str) -> Column:
    """A document's place in its source: a hash of what identifies the row."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("source"), F.col(size)), 64 - WIDTH)


def block_of(h: str, n: str) -> Column:
    return F.shiftright(F.shiftright(F.col(h), WIDTH - 30) * F.col(n), 30)


def sized(docs: DataFrame, mix: Mix) -> DataFrame:
    """The narrow table all decisions are made on: doc_id, source, size, place."""
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), words_in("text").alias("__size"))
    return cut(rows.withColumn("__place", place(mix.seed, "__size")), "mix-sizes")


def plan(sizes: DataFrame, mix: Mix) -> Plan:
    spark = sizes.sparkSession
    rows = sizes.groupBy("source").agg(F.sum("__size").alias("words"), F.count(F.when(F.col("__size") > 0, 1)).alias("docs")).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    rows = sorted(rows, key=lambda r: (r["source"] is None, r["source"] or ""))
    words = [r["words"] for r in rows]
    total, found = sum(words), Plan(mix)
    for i, (r, goal) in enumerate(zip(rows, targets(words, mix), strict=True)):
        blocks = max(1, min(r["docs"], mix.blocks * r["words"] // max(1, total)))
        found.sources.append((i, r["source"], r["words"], float(goal), int(blocks)))
    per_block = located(sizes, found, "__size", "__place").groupBy("__source", "__block").agg(F.sum("__size").alias("words")).filter("words > 0").collect()
    by_source: dict[int, list[tuple[int, int]]] = {}
    for r in per_block:
        by_source.setdefault(r["__source"], []).append((r["__block"], r["words"]))
    drawn: dict[int, list[list]] = {}
    edges = []
    for i, _, size, goal, _ in found.sources:
        have = sorted(by_source.get(i, []))
        rng = np.random.default_rng([mix.seed, i])
        epochs = int(goal // size) if size else 0
        list_ = [[b, e, None] for e in range(epochs) for b, _ in have]
        rest = int(goal - epochs * size)
        for k in rng.permutation(len(have)):
            b, n = have[k]
            if rest <= 0:
                break
            list_.append([b, epochs, None if n <= rest else rest])
            if n > rest:
                edges.append((i, b, rest))
            rest -= n
        drawn[i] = [list_[k] for k in rng.permutation(len(list_))]
    cuts = edge_cuts(sizes, found, edges) if edges else {}
    quota = split(np.array([len(drawn[s[0]]) for s in found.sources], np.int64), mix.shards, mix.seed)
    for i, *_ in found.sources:
        shard = np.repeat(np.arange(mix.shards), quota[:, i])
        merged: dict[int, list[tuple]] = {}
        for (b, e, part), s in zip(drawn[i], shard.tolist(), strict=True):
            edge = (None, 0, 0, 0) if part is None else (*cuts[i], part)
            merged.setdefault(b, []).append((e, s, *edge))
        found.draws += [(i, b, sorted(v, key=lambda x: x[:2])) for b, v in sorted(merged.items())]
    return found


def edge_cuts(sizes: DataFrame, found: Plan, edges: list[tuple[int, int, int]]) -> dict[int, tuple]:
    """Per source, the hash at which its cut block ends, the words before it and the words at it."""
    spark = sizes.sparkSession
    wanted = F.broadcast(spark.createDataFrame(edges, "__source int, __block long, __part long"))
    at = located(sizes, found, "__size", "__place").join(wanted, ["__source", "__block"]).groupBy("__source", "__part", "__place").agg(F.sum("__size").alias("n")).filter("n > 0")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("__source").orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = at.withColumn("before", before).filter("before < __part and before + n >= __part").collect()
    return {r["__source"]: (r["__place"], r["before"], r["n"]) for r in rows}


def located(df: DataFrame, found: Plan, size: str, h: str) -> DataFrame:
    """Rows with their source's ordinal, words, target and their block."""
    schema = "__source int, __name string, __source_size long, __target double, __blocks long"
    sources = F.broadcast(df.sparkSession.createDataFrame(found.sources, schema))
    joined = df.join(sources, F.col("source").cast("string").eqNullSafe(F.col("__name")))
    return joined.withColumn("__block", block_of(h, "__blocks")).drop("__name", "__blocks")


def drawn(df: DataFrame, found: Plan, size: str, h: str) -> DataFrame:
    """Rows with ``__draws``: an (epoch, shard, words) for each time the mix takes words of the row."""
    schema = "__source int, __block long, __plan array<struct<epoch:int,shard:int,edge:long,before:long,there:long,part:long>>"
    blocks = F.broadcast(df.sparkSession.createDataFrame(found.draws, schema))
    rows = located(df, found, size, h).join(blocks, ["__source", "__block"], "left")
    s, p = F.col(size), F.col(h)
    share = lambda d: F.expr("bigint(0)") + F.floor(s.cast("decimal(20,0)") * (d["part"] - d["before"]) / F.greatest(d["there"], F.lit(1))).cast("long")
    words = lambda d: F.when(d["edge"].isNull() | (p < d["edge"]), s).when(p == d["edge"], F.when(s == d["there"], d["part"] - d["before"]).otherwise(share(d))).otherwise(F.lit(0).cast("long"))
    take = F.transform("__plan", lambda d: F.struct(d["epoch"].alias("epoch"), d["shard"].alias("shard"), words(d).alias("words")))
    return rows.withColumn("__draws", F.filter(F.coalesce(take, F.array().cast("array<struct<epoch:int,shard:int,words:bigint>>")), lambda d: d["words"] > 0))


def taken(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """A row per document: doc_id, size, source_size, target, taken."""
    sizes = sized(docs, mix)
    rows = drawn(sizes, plan(sizes, mix), "__size", "__place")
    n = F.aggregate("__draws", F.lit(0).cast("long"), lambda a, d: a + d["words"])
    return rows.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), n.alias("taken"))


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each time a document is taken.

    A document taken whole keeps its text; the one document per source that
    the target cuts holds its first words, joined by one space. Rows stand in
    shard order and shuffled inside their shard.
    """
    names = docs.columns
    found = plan(sized(docs, mix), mix)
    rows = docs.withColumn("__size", words_in("text")).withColumn("__place", place(mix.seed, "__size"))
    rows = drawn(rows, found, "__size", "__place").withColumn("__draw", F.explode("__draws"))
    first = F.array_join(F.slice(F.filter(F.split("text", "[ \\t-\\r]+"), lambda w: w != ""), 1, F.col("__draw.words").cast("int")), " ")
    rows = rows.withColumn("text", F.when(F.col("__draw.words") < F.col("__size"), first).otherwise(F.col("text")))
    rows = rows.withColumn("__shard", F.col("__draw.shard")).withColumn("__turn", F.xxhash64(F.lit(mix.seed + 1), "__draw.shard", "__draw.epoch", "__place"))
    return rows.select(*names, "__shard", "__turn").repartition(mix.shards, "__shard").sortWithinPartitions("__shard", "__turn").select(*names)
