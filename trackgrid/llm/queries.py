"""The numbered operators, each applied to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from trackgrid.llm import ann, conversations, exact, langid, licenses, lm, mix, pack, runs, simhash, substring, toxicity, urls
from trackgrid.llm.ship import ship
from trackgrid.llm.words import LOWER, UPPER, bucket

URL_RULES = [
    urls.Rule("block", "net"),
    urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"),
    urls.Rule("allow", "org", "/fr/"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.taken(table(spark, sf_dir, "documents"))


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = public_tokenizers
    return pack.pack(table(spark, sf_dir, "documents"), p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken"), p.PATTERN, with_ids=False)


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, public_tokenizers.path("piece_bpe_32k.model"), bucket("doc_id", 4) != 2)
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (bucket("doc_id", 4) == 2).alias("held_out"), F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return ann.nearest(rows, F.col("id") % 20 == 0)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), bucket("doc_id", 5) != 0)
    return toxicity.score(docs, model).select("doc_id", (bucket("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = public_tokenizers
    return lm.score(table(spark, sf_dir, "documents"), p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken"), p.PATTERN)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.grouped(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", F.col("group_size").cast("long"), "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.labelled(licenses.find_notices(table(spark, sf_dir, "documents")))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", runs.damaged().alias("text"))
    return runs.digests(runs.find_runs(docs))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.report(rows, conversations.repair(conversations.damaged(rows)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix": op1_mix,
    "op2_pack": op2_pack,
    "op3_langid": op3_langid,
    "op4_nearest": op4_nearest,
    "op5_toxicity": op5_toxicity,
    "op6_lm_score": op6_lm_score,
    "op7_simhash": op7_simhash,
    "op8_substring": op8_substring,
    "op9_url_rules": op9_url_rules,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_licenses": op11_licenses,
    "op12_runs": op12_runs,
    "op13_conversations": op13_conversations,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op9_url_rules": f"""
SELECT page_id, host, path, rule, CASE rule WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block' ELSE 'allow' END AS verdict FROM (
  SELECT page_id, host, path, CASE
    WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages)))""",
    "op10_exact_dedup": f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm FROM documents) WINDOW same AS (PARTITION BY norm)""",
}
