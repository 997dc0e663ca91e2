"""Rule dictionaries: JSON files per country, read into one table of claimed sources.

A file maps categories to rules. A rule is `source, source => target`, a group of equal words without a target (its first
member is the target), or a plain phrase. A country's own rules come first; a source belongs to the first rule that names
it and later rules lose it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from importlib import resources
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Categories that rewrite names, and other names under which files hold a category.
CANONICAL = ("legal_suffixes", "business_sectors")
ALIASES = {"company_types": "legal_suffixes", "address_terms": "address_abbreviations"}
SHARED = ("common", "countries")
FRAGMENT_LENGTH, GEO_LENGTH = 4, 4
RULES = "country string, category string, priority int, rule_no int, source string, target string"


def rule_files(spark: SparkSession, path: str | None = None) -> DataFrame:
    """(country, body) of every rule file: of a folder that Spark can read, or of this package."""
    if path is None:
        rows = [(f.name[:-5], f.read_text(encoding="utf-8")) for f in sorted((resources.files("masterlink") / "data" / "rules").iterdir(), key=lambda f: f.name) if f.name.endswith(".json")]
        return spark.createDataFrame(rows, "country string, body string")
    files = spark.read.option("wholetext", True).option("pathGlobFilter", "*.json").text(path)
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1)
    return files.select(name.alias("country"), F.col("value").alias("body")).filter(~F.col("country").startswith("_"))


def parse_rules(files: DataFrame) -> DataFrame:
    """(file, category, rule_no, place, source, target) before claims, in lower case."""
    category = F.col("category")
    for old, new in ALIASES.items():
        category = F.when(F.col("category") == old, new).otherwise(category)
    rules = files.select(F.lower("country").alias("file"), F.explode(F.from_json("body", "map<string,array<string>>")).alias("category", "rules"))
    rules = rules.select("file", category.alias("category"), F.posexplode("rules").alias("rule_no", "rule"))
    parts = F.split(F.lower(F.trim("rule")), "=>", 2)
    sources = F.filter(F.transform(F.split(parts[0], ","), lambda s: F.trim(s)), lambda s: s != "")
    rules = rules.withColumn("sources", sources).withColumn("arrow", F.trim(F.get(parts, F.lit(1))))
    members = (F.size("sources") > 1) & F.col("arrow").isNull() & F.col("category").isin(*CANONICAL)
    target = F.when(F.col("arrow").isNotNull(), F.col("arrow")).when(members, F.get("sources", F.lit(0)))
    return rules.select("file", "category", "rule_no", F.posexplode("sources").alias("place", "source"), target.alias("target"))


def claimed_rules(parsed: DataFrame, countries: list[str]) -> DataFrame:
    """RULES for each country: its own file first, then the shared ones; the first rule that names a source has it.

    Sources are claimed within the rewriting categories together, and within each other category on its own.
    """
    own = parsed.filter(~F.col("file").isin(*SHARED)).withColumn("country", F.upper("file")).withColumn("priority", F.lit(0))
    shared = parsed.filter(F.col("file").isin(*SHARED)).withColumn("country", F.explode(F.array(*map(F.lit, countries)))).withColumn("priority", F.lit(1))
    rules = own.unionByName(shared)
    pool = F.when(F.col("category").isin(*CANONICAL), "canonical").otherwise(F.col("category"))
    order = W.partitionBy("country", pool, "source").orderBy("priority", F.desc("category"), "rule_no", "place")
    claimed = rules.withColumn("claim", F.row_number().over(order)).filter("claim = 1")
    return claimed.select("country", "category", "priority", "rule_no", "source", "target")


def rule_collisions(parsed: DataFrame, countries: list[str]) -> DataFrame:
    """(country, source, targets): sources for which one country's files name several targets."""
    own = parsed.filter(~F.col("file").isin(*SHARED)).withColumn("country", F.upper("file"))
    shared = parsed.filter(F.col("file").isin(*SHARED)).withColumn("country", F.explode(F.array(*map(F.lit, countries))))
    named = own.unionByName(shared).filter(F.col("category").isin(*CANONICAL))
    return named.groupBy("country", "source").agg(F.array_sort(F.collect_set("target")).alias("targets")).filter(F.size("targets") > 1)


@dataclass
class Vocabulary:
    """The claimed rules as small maps by country; their size is that of the dictionaries, not of the data."""

    rows: list[tuple[str, str, str, str | None]]  # country, category, source, target
    countries: list[str]

    @classmethod
    def load(cls, spark: SparkSession, path: str | None = None) -> Vocabulary:
        files = rule_files(spark, path)
        countries = sorted(r["country"].upper() for r in files.select("country").collect() if r["country"].lower() not in SHARED)
        rules = claimed_rules(parse_rules(files), countries).select("country", "category", "source", "target")
        return cls(sorted((tuple(r) for r in rules.collect()), key=repr), countries)

    def sources(self, category: str, words: str = "all") -> dict[str, list[str]]:
        """Sources of a category by country; words: all, or only those of one word."""
        out: dict[str, list[str]] = {c: [] for c in self.countries}
        for country, cat, source, _ in self.rows:
            if cat == category and (words == "all" or " " not in source):
                out[country].append(source)
        return out

    def tokens(self, category: str) -> dict[str, list[str]]:
        """All single words that stand for the category: one-word sources and targets."""
        out = {c: set() for c in self.countries}
        for country, cat, source, target in self.rows:
            if cat == category:
                out[country].update(w for w in (source, target) if w and " " not in w)
        return {c: sorted(v) for c, v in out.items()}

    def canonical(self) -> dict[str, dict[str, str]]:
        """Folded source -> target words, by country. Of sources that fold alike the least source string wins."""
        out: dict[str, dict[str, str]] = {c: {} for c in self.countries}
        for country, cat, source, target in self.rows:
            if cat in CANONICAL and target:
                key, value = " ".join(words_of(source)), " ".join(words_of(target))
                if key and key != value:
                    out[country].setdefault(key, value)
        return out

    def fragments(self) -> dict[str, list[str]]:
        """Alphabetic pieces, of up to four letters, of legal forms."""
        out = {c: set() for c in self.countries}
        for country, cat, source, target in self.rows:
            if cat == "legal_suffixes":
                out[country].update(w for s in (source, target or "") for w in words_of(s) if w.isalpha() and len(w) <= FRAGMENT_LENGTH)
        return {c: sorted(v) for c, v in out.items()}

    def geo(self) -> dict[str, list[str]]:
        """Words of a country's own names, of four letters and more."""
        out: dict[str, list[str]] = {c: [] for c in self.countries}
        for country, cat, source, target in self.rows:
            if cat == "country_names" and (target or "").upper() == country and " " not in source and len(source) >= GEO_LENGTH:
                out[country].append(source)
        return out

    def generic(self) -> dict[str, list[str]]:
        """Words that don't tell firms apart: legal forms, sectors, articles and the country's own names."""
        sets = [self.tokens("legal_suffixes"), self.tokens("business_sectors"), self.sources("articles", "one"), self.geo(), self.canonical_words()]
        return {c: sorted({w for s in sets for w in s[c]}) for c in self.countries}

    def canonical_words(self) -> dict[str, list[str]]:
        """Words of all targets, so that a rewritten sector adds no distinctive word."""
        return {c: sorted({w for t in m.values() for w in t.split()}) for c, m in self.canonical().items()}


def words_of(text: str) -> list[str]:
    return text.replace(".", " ").replace(",", " ").replace("&", " ").split()


def by_country(values: dict[str, list[str]], country: Column) -> Column:
    """The country's list as a constant of the plan; empty for other countries."""
    table = F.from_json(F.lit(json.dumps(values, ensure_ascii=False)), "map<string,array<string>>")
    return F.coalesce(table[country], F.array().cast("array<string>"))


def map_by_country(values: dict[str, dict[str, str]], country: Column) -> Column:
    table = F.from_json(F.lit(json.dumps(values, ensure_ascii=False)), "map<string,map<string,string>>")
    return F.coalesce(table[country], F.create_map().cast("map<string,string>"))


def export_rules(vocabulary: Vocabulary, path: str) -> None:
    """Write the claimed rules as one JSON file per country, in the same grammar."""
    for country in vocabulary.countries:
        body: dict[str, list[str]] = {}
        for c, category, source, target in vocabulary.rows:
            if c == country:
                body.setdefault(category, []).append(f"{source}=>{target}" if target else source)
        Path(path, f"{country.lower()}.json").write_text(json.dumps(body, ensure_ascii=False), encoding="utf-8")
