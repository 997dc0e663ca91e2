"""Probes and bulk helpers around the resolver: pair verification, the stage waterfall, exact-name masters, boosted search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masterlink.config import INTENDED, LEGACY_TYPES, Profile
from masterlink.functions import text as T
from masterlink.operators.analyse import analyse
from masterlink.operators.retired import equal_key
from masterlink.plans.durable import durable
from masterlink.sources.rules import Vocabulary

KEYS = ("class_key", "gap_signature", "core", "alpha_core", "lettered")


def verify_pairs(pairs: DataFrame, vocabulary: Vocabulary, profile: Profile = INTENDED) -> DataFrame:
    """For (country_code, probe, master) names: whether each stage would link them, as if the master's were the only one."""
    sides = pairs.select("country_code", F.explode(F.array("probe", "master")).alias("name")).distinct()
    read = analyse(sides, vocabulary, profile).select("country_code", "name", *KEYS)
    side = lambda s: read.select("country_code", F.col("name").alias(s), *(F.col(k).alias(f"{s}_{k}") for k in KEYS))
    both = pairs.join(side("probe"), ["country_code", "probe"]).join(side("master"), ["country_code", "master"])
    same = F.col("probe_class_key") == F.col("master_class_key")
    near = F.coalesce(T.slop_distance(F.col("probe_gap_signature"), F.col("master_gap_signature")) <= profile.slop, F.lit(False))
    return both.select(
        *pairs.columns,
        (same & F.col("probe_core") & (F.col("probe_gap_signature") == F.col("master_gap_signature"))).alias("canonical_exact"),
        (same & F.col("probe_alpha_core") & near).alias("phrase_slop"),
        (same & F.col("probe_lettered") & F.lit(profile.token_coverage_wins)).alias("token_coverage"),
    )


def stage_waterfall(resolved: DataFrame, profile: Profile = INTENDED) -> DataFrame:
    """(stage_order, stage_name, asked, matched, left): how many rows each stage got, linked and passed on."""
    rows = resolved.filter("match_type IS NOT NULL AND match_type <> 'EXCLUDED'")
    stages = sorted((s for s in profile.stages if s.enabled), key=lambda s: s.order)
    order = F.create_map(*(F.lit(x) for s in stages for x in (s.name, s.order)))
    counts = rows.select(F.coalesce(order[F.col("match_type")], F.lit(1 << 30)).alias("o")).groupBy("o").agg(F.count("*").alias("n"))
    one = counts.agg(F.coalesce(F.collect_list(F.struct("o", "n")), F.array().cast("array<struct<o:int,n:bigint>>")).alias("c"))  # a row per stage at most
    total = lambda test: F.aggregate(F.filter("c", test), F.lit(0).cast("bigint"), lambda a, x: a + x["n"])

    def line(s) -> Column:
        asked, matched, left = (total(t) for t in (lambda x: x["o"] >= s.order, lambda x: x["o"] == s.order, lambda x: x["o"] > s.order))
        return F.struct(F.lit(s.order).alias("stage_order"), F.lit(s.name).alias("stage_name"), asked.alias("asked"), matched.alias("matched"), left.alias("left"))

    lines = [line(s) for s in stages]
    return one.select(F.inline(F.array(*lines)))


def exact_name_masters(rows: DataFrame) -> DataFrame:
    """(country_code, key, master_id, rows): one master per lower-case trimmed name and country, the first row's."""
    key = F.lower(F.trim("name"))
    return rows.filter(key != "").groupBy("country_code", key.alias("key")).agg(F.min("id").alias("master_id"), F.count("*").alias("rows"))


def other_of_same_signature(rows: DataFrame, names: DataFrame) -> DataFrame:
    """(id, other_id): for each row the smallest other id of its country with the same hole signature and a core."""
    keyed = durable(rows.join(names.filter("core AND reason IS NULL").select("name", "country_code", "gap_signature"), ["name", "country_code"]).select("id", "country_code", "gap_signature"))
    two = keyed.groupBy("country_code", "gap_signature").agg(F.min_by("id", "id").alias("first"), F.count("*").alias("n"))
    first = two.filter("n > 1").drop("n")
    more = keyed.join(first, ["country_code", "gap_signature"])
    second = more.filter("id <> first").groupBy("country_code", "gap_signature").agg(F.min("id").alias("second"))
    return more.join(second, ["country_code", "gap_signature"]).select("id", F.when(F.col("id") == F.col("first"), F.col("second")).otherwise(F.col("first")).alias("other_id"))


def boosted_probe(rows: DataFrame, keys: list[Column], phone: str = "phone", boost: float = 5.0, tax: str | None = None, tax_boost: float = 10.0) -> DataFrame:
    """(probe_id, master_id, score): earlier rows that share any of the keys, one point for each, more for the same phone
    and, if the rows have a column for it, most for the same tax number (but for punctuation and case)."""
    rows, hits = durable(rows), None
    for key in keys:
        found = equal_key(rows, key)
        hits = found if hits is None else hits.unionByName(found)
    scored = hits.groupBy("probe_id", "master_id").agg(F.count("*").cast("double").alias("points"))
    number = F.nullif(T.tax_norm(F.col(tax)), F.lit("")) if tax else F.lit(None).cast("string")
    a = rows.select(F.col("id").alias("probe_id"), F.col(phone).alias("x"), number.alias("u"))
    b = rows.select(F.col("id").alias("master_id"), F.col(phone).alias("y"), number.alias("v"))
    scored = scored.join(a, "probe_id").join(b, "master_id")
    same = lambda x, y, points: F.when(F.col(x) == F.col(y), points).otherwise(0.0)
    return scored.select("probe_id", "master_id", (F.col("points") + same("x", "y", boost) + same("u", "v", tax_boost)).alias("score"))


def present_types(match_type: Column) -> Column:
    """Match types with labels of old tables named as today."""
    labels = F.create_map(*(F.lit(x) for kv in LEGACY_TYPES.items() for x in kv))
    return F.coalesce(labels[match_type], match_type)


def post_verified(a: Column, b: Column, strict: bool, coverage: float = 0.9, ratio: float = 0.9, loose_ratio: float = 0.7) -> Column:
    """The retired check after a match: mutual word coverage and word counts; loose stages need the same first word."""
    from masterlink.operators.retired import symmetric_coverage, word_ratio

    if strict:
        return (symmetric_coverage(a, b) >= coverage) & (word_ratio(a, b) >= ratio)
    return (word_ratio(a, b) >= loose_ratio) & (F.get(a, F.lit(0)) == F.get(b, F.lit(0)))


def legacy_update(resolved: DataFrame) -> DataFrame:
    """(id, master_code, match_score): the old three-column writer, with whole scores."""
    return resolved.filter(F.col("master_id").isNotNull()).select("id", F.col("master_id").cast("string").alias("master_code"), F.col("match_score").cast("int").alias("match_score"))
