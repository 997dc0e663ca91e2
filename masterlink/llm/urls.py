"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a pattern over `host + path` (the host in lower case), written as
  `example.net/en/`  the host or any subdomain of it, with that path prefix;
  `re:...`           a regular expression searched in `host + path`.
Every rule is compiled to a regular expression. Its literal tokens, runs of [0-9A-Za-z] that the pattern holds whole, are
looked up in the counts of tokens over all URLs, and the rule is filed under the rarest one. A URL's own tokens then fetch
the few rules that can match, and only those run. Rules without a whole literal token are tried on every URL.

Of the host rules that match, the longest decides; if none does, the first matching pattern rule decides, and else the
verdict is allow.

Edge cases: null urls, and urls without `://`, have an empty host and path, match no host rule and are allowed; empty
tables give empty results; repeated rows are judged alike; other columns pass through (those named like the new ones are
replaced).
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"[0-9A-Za-z]+")


@dataclass(frozen=True)
class UrlRule:
    text: str
    verdict: str

    @property
    def is_host(self) -> bool:
        return not self.text.startswith("re:")

    @property
    def regex(self) -> str:
        if not self.is_host:
            return self.text[3:]
        host, slash, path = self.text.partition("/")
        return r"\A(?:[^/]*\.)?" + re.escape(host) + r"(?=/|\Z)" + re.escape(slash + path)

    def tokens(self) -> list[str]:
        """The literal tokens that every match holds whole."""
        if self.is_host:
            found = [(m[0], m.end() == len(self.text)) for m in TOKEN.finditer(self.text)]
            return [t for t, at_end in found if not at_end or "/" not in self.text]
        # Of a regular expression, only literals between \b, - or /, if it has no group, choice or repetition.
        return [] if re.search(r"[|?*+({\[]", self.regex) else re.findall(r"(?:\\b|[-/])([0-9A-Za-z]+)(?=\\b|[-/])", self.regex)


#: Rules of the registered query: host rules, then patterns for known junk hosts and paths.
HOST_RULES = [UrlRule("net/", "block"), UrlRule("example.net/en/", "allow"), UrlRule("example.com/de/", "block"), UrlRule("org/fr/", "allow")]
PATTERN_RULES = [
    UrlRule(r"re:\bspam-farm\b", "block"),
    UrlRule(r"re:\bcheap-pills\b", "block"),
    UrlRule(r"re:\bcasino\b", "block"),
    UrlRule(r"re:\bxxx\b", "block"),
    UrlRule(r"re:\badserver\b", "block"),
    UrlRule(r"re:/doubleclick/", "block"),
]


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, with A-Z in lower case; empty if there is no `://`."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


class RuleIndex:
    """Rules by their rarest token; grows with the rules only."""

    def __init__(self, rules: list[UrlRule], counts: dict[str, int]):
        self.compiled = [(r, re.compile(r.regex, re.DOTALL)) for r in rules]
        self.by_token: dict[str, list[int]] = defaultdict(list)
        self.always: list[int] = []
        for k, rule in enumerate(rules):
            tokens = rule.tokens()
            if tokens:
                self.by_token[min(tokens, key=lambda t: (counts.get(t, 0), t))].append(k)
            else:
                self.always.append(k)

    def judge(self, host: str, path: str) -> tuple[str | None, str, str | None, int]:
        """Host rule, verdict, pattern rule and the number of regular expressions that ran."""
        key = host + path
        fetched = {k for t in TOKEN.findall(key) for k in self.by_token.get(t, ())}
        fetched.update(self.always)
        hits = [self.compiled[k][0] for k in sorted(fetched) if self.compiled[k][1].search(key)]
        hosts, patterns = [r for r in hits if r.is_host], [r for r in hits if not r.is_host]
        if hosts:
            best = max(hosts, key=lambda r: len(r.text))
            return best.text, best.verdict, None, len(fetched)
        if patterns:
            return None, patterns[0].verdict, patterns[0].text, len(fetched)
        return None, "allow", None, len(fetched)


def filter_urls(pages: DataFrame, rules: list[UrlRule], url_col: str = "url", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all, by default) with host, path, rule, verdict, pattern and rules_run.

    Token counts come from all URLs; only counts of tokens that the rules hold, a number the rules bound, reach the
    driver.
    """
    new = ("host", "path", "rule", "verdict", "pattern", "rules_run")
    keep = [c for c in (keep if keep is not None else pages.columns) if c not in new]
    literals = sorted({t for r in rules for t in r.tokens()})
    counts: dict[str, int] = {}
    if literals:
        key = F.concat(url_host(F.col(url_col)), url_path(F.col(url_col)))
        wanted = F.array_intersect(F.regexp_extract_all(key, F.lit("[0-9A-Za-z]+"), 0), F.from_json(F.lit(json.dumps(literals)), "array<string>"))
        tokens = pages.select(F.explode(wanted).alias("token"))
        counts = {r["token"]: r["n"] for r in tokens.groupBy("token").agg(F.count("*").alias("n")).collect()}
    shared = pages.sparkSession.sparkContext.broadcast((rules, counts))
    rows = pages.select(*(F.col(f"`{c}`") for c in keep), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = RuleIndex(*shared.value)
        for b in batches:
            n = b.num_columns
            out = [index.judge(h, p) for h, p in zip(b.column(n - 2).to_pylist(), b.column(n - 1).to_pylist(), strict=True)]
            more = [pa.array([x[k] for x in out], kind) for k, kind in ((0, pa.string()), (1, pa.string()), (2, pa.string()), (3, pa.int32()))]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(n)] + more, names=[*keep, *new])

    schema = rows.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(""), "pattern": F.lit(None).cast("string"), "rules_run": F.lit(0)}).schema
    for f in schema.fields:
        f.nullable = True
    return rows.mapInArrow(apply, schema)
