"""URL rules found by their rarest literal token.

A rule blocks or allows a host with its subdomains where the path starts with
the rule's path. Each rule is one regular expression, filed under that of its
whole tokens which the URLs hold least often. A URL's tokens fetch candidate
rules and only those expressions run; of the rules that fit the longest wins
(then the smaller text). A rule without a whole token is tried on every URL.

Defined results: a null URL or one without ``://`` has empty host and path and
fits no rule; repeated rows are judged each on their own; extra columns stay out.
The rules come as a list from the caller and travel with the task; more than
``MOST_RULES`` are refused.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_RULES = 1_000_000
TOKEN = re.compile(r"[0-9A-Za-z]+")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path

    def pattern(self) -> str:
        return rf"(?:[^/]*\.)?{re.escape(self.host)}{'(?=/|$)' if not self.path else ''}{re.escape(self.path)}"

    def tokens(self) -> list[str]:
        """Tokens that stand whole in every URL that fits: a last one may go on in the URL."""
        text, found = self.name, []
        for m in TOKEN.finditer(text):
            if m.end() < len(text) or not self.path:
                found.append(m[0])
        return found


def host_and_path(url: str | None) -> tuple[str, str]:
    if url is None or "://" not in url:
        return "", ""
    rest = re.split(r"[?#]", url.partition("://")[2], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), slash + path


class RuleIndex:
    """Rules filed under their rarest token; ``rarity`` counts a token's URLs."""

    def __init__(self, rules: list[Rule], rarity: dict[str, int]):
        self.by_token: dict[str, list[tuple[re.Pattern, Rule]]] = {}
        self.always: list[tuple[re.Pattern, Rule]] = []
        for rule in rules:
            entry = (re.compile(rule.pattern(), re.DOTALL), rule)
            tokens = rule.tokens()
            if tokens:
                self.by_token.setdefault(min(tokens, key=lambda t: (rarity.get(t, 0), t)), []).append(entry)
            else:
                self.always.append(entry)

    def find(self, host: str, path: str) -> Rule | None:
        if not host:
            return None
        target, best = host + path, None
        candidates = list(self.always)
        for token in set(TOKEN.findall(target)):
            candidates += self.by_token.get(token, ())
        for pattern, rule in candidates:
            if pattern.match(target) and (best is None or (-len(rule.name), rule.name) < (-len(best.name), best.name)):
                best = rule
        return best


def token_counts(pages: DataFrame, rules: list[Rule], url: str = "url") -> dict[str, int]:
    """In how many URLs each token of the rules stands; the answer is no longer than the rules."""
    wanted = frozenset(t for r in rules for t in r.tokens())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for u in batch.column(0).to_pylist():
                found.update(wanted.intersection(TOKEN.findall("".join(host_and_path(u)))))
        yield pa.RecordBatch.from_pydict({"token": pa.array(list(found), pa.string()), "n": pa.array(list(found.values()), pa.int64())})

    rows = pages.select(F.col(url).alias("url")).mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    return {r["token"]: r["n"] for r in rows}


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow", key: str = "page_id", url: str = "url") -> DataFrame:
    """Key, host, path, rule (null if none fits) and verdict of every row."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MOST_RULES} travel with a task")
    index = RuleIndex(rules, token_counts(pages, rules, url))
    kind = dict(pages.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, names, verdicts = [], [], [], []
            for u in batch.column(1).to_pylist():
                host, path = host_and_path(u)
                rule = index.find(host, path)
                hosts.append(host)
                paths.append(path)
                names.append(rule and rule.name)
                verdicts.append(rule.verdict if rule else default)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.string()) for x in (hosts, paths, names, verdicts))], names=[key, "host", "path", "rule", "verdict"]
            )

    return pages.select(F.col(key), F.col(url)).mapInArrow(run, f"`{key}` {kind}, host string, path string, rule string, verdict string")
