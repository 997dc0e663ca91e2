"""Duplicate masters: groups by fingerprint, merge plans and their application."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from masterlink.operators.graph import connected_components
from masterlink.plans.durable import durable


def distinctive(fingerprint: Column, least: int = 2) -> Column:
    """Whether a word of the fingerprint has at least so many characters."""
    return F.exists(F.split(fingerprint, " "), lambda t: F.length(t) >= least)


def master_fingerprints(resolved: DataFrame, names: DataFrame) -> DataFrame:
    """(master_id, country_code, fingerprint, name) of all variations that masters hold, each once."""
    taught = resolved.filter(F.col("match_type").isin("NEW_MASTER", "DIRTY_DATA", "CANONICAL_EXACT")).select("master_id", "name", "country_code").distinct()
    return taught.join(names.select("name", "country_code", "fingerprint"), ["name", "country_code"]).select("master_id", "country_code", "fingerprint", "name")


def duplicate_groups(variations: DataFrame, cap: int | None = None, least: int = 2, countries: list[str] | None = None, masters: DataFrame | None = None) -> DataFrame:
    """(country_code, fingerprint, master_count, master_ids): fingerprints that at least two masters share.

    master_ids holds all masters, as plans need them, or for reports the `cap` smallest; master_count counts all.
    countries and masters restrict the search.
    """
    pairs = variations.filter((F.col("fingerprint") != "") & (F.coalesce(F.col("country_code"), F.lit("")) != "") & distinctive(F.col("fingerprint"), least))
    if countries:
        pairs = pairs.filter(F.col("country_code").isin(countries))
    if masters is not None:
        touched = pairs.join(masters.select("master_id").distinct(), "master_id", "left_semi").select("country_code", "fingerprint").distinct()
        pairs = pairs.join(touched, ["country_code", "fingerprint"], "left_semi")
    pairs = pairs.select("country_code", "fingerprint", "master_id").distinct()
    counts = pairs.groupBy("country_code", "fingerprint").agg(F.count("*").alias("master_count")).filter("master_count > 1")
    rank = F.row_number().over(W.partitionBy("country_code", "fingerprint").orderBy("master_id"))
    shown = pairs.withColumn("rank", rank).filter(F.col("rank") <= cap) if cap is not None else pairs
    shown = shown.groupBy("country_code", "fingerprint").agg(F.array_sort(F.collect_list("master_id")).alias("master_ids"))
    return counts.join(shown, ["country_code", "fingerprint"])


def merge_plan(groups: DataFrame) -> DataFrame:
    """(country_code, fingerprint, primary_id, secondaries): the smallest id stays."""
    ids = F.array_sort(F.array_distinct("master_ids"))
    return groups.select("country_code", "fingerprint", F.array_min(ids).alias("primary_id"), F.slice(ids, 2, F.greatest(F.lit(1), F.size(ids))).alias("secondaries")).filter(F.size("secondaries") > 0)


def merge_map(variations: DataFrame, least: int = 2) -> DataFrame:
    """(master_id, primary_id) of masters to merge: closed over all shared fingerprints, no matter how many masters."""
    pairs = variations.filter((F.col("fingerprint") != "") & distinctive(F.col("fingerprint"), least)).select("country_code", "fingerprint", "master_id").distinct()
    first = pairs.groupBy("country_code", "fingerprint").agg(F.min("master_id").alias("b"))
    edges = pairs.join(first, ["country_code", "fingerprint"]).filter("master_id <> b").select(F.col("master_id").alias("a"), "b")
    found = connected_components(edges)
    return found.filter("node <> component").select(F.col("node").alias("master_id"), F.col("component").alias("primary_id"))


def repoint(resolved: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows of merged masters point to the primary; their own anchors become AUTO_DEDUP."""
    moved = resolved.join(plan, "master_id", "left")
    kind = F.when(F.col("primary_id").isNotNull() & (F.col("match_type") == "NEW_MASTER"), "AUTO_DEDUP").otherwise(F.col("match_type"))
    return moved.withColumns({"match_type": kind, "master_id": F.coalesce("primary_id", "master_id")}).drop("primary_id").select(*resolved.columns)


def merge_documents(documents: DataFrame, plan: DataFrame) -> DataFrame:
    """Master documents with merged ones united into their primaries."""
    moved = documents.join(plan, "master_id", "left").withColumn("master_id", F.coalesce("primary_id", "master_id"))
    words = moved.select("master_id", "country_code", F.explode_outer("variations").alias("v")).distinct()
    phones = moved.select("master_id", "country_code", F.explode_outer("phone_number").alias("p")).distinct()
    left = words.groupBy("master_id", "country_code").agg(F.array_sort(F.collect_list("v")).alias("variations"))
    right = phones.groupBy("master_id", "country_code").agg(F.array_sort(F.collect_list("p")).alias("phone_number"))
    return left.join(right, ["master_id", "country_code"])


def merge_stats(groups: DataFrame, plan: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: groups, merged_masters, repointed_rows."""
    parts = [
        groups.agg(F.count("*").alias("n")).select(F.lit("groups").alias("what"), "n"),
        plan.agg(F.count("*").alias("n")).select(F.lit("merged_masters").alias("what"), "n"),
        before.select("id", "master_id").exceptAll(after.select("id", "master_id")).agg(F.count("*").alias("n")).select(F.lit("repointed_rows").alias("what"), "n"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy().agg(*(F.coalesce(F.max(F.when(F.col("what") == w, F.col("n"))), F.lit(0)).alias(w) for w in ("groups", "merged_masters", "repointed_rows")))


def potential_duplicates(variations: DataFrame, ids: int = 50, samples: int = 5, min_count: int = 2, size: int | None = None, country: str | None = None) -> DataFrame:
    """(fingerprint, country_code, master_ids, master_count, sample_names) of at least min_count masters, the most first.

    size: for reports, the number of rows at most; country: only of one.
    """
    variations = variations.filter(F.col("country_code") == country) if country else variations
    groups = duplicate_groups(variations, cap=ids, least=1)
    rank = F.row_number().over(W.partitionBy("country_code", "fingerprint").orderBy("name"))
    names = variations.select("country_code", "fingerprint", "name").distinct().withColumn("rank", rank).filter(F.col("rank") <= samples)
    names = names.groupBy("country_code", "fingerprint").agg(F.array_sort(F.collect_list("name")).alias("sample_names"))
    found = groups.filter(F.col("master_count") >= min_count).join(names, ["country_code", "fingerprint"])
    found = found.select("fingerprint", "country_code", "master_ids", "master_count", "sample_names").orderBy(F.desc("master_count"), "fingerprint", "country_code")
    return found if size is None else found.limit(size)


def review(groups: DataFrame, decisions: DataFrame) -> DataFrame:
    """The plan of the groups that reviewers accepted: decisions hold (country_code, fingerprint, decision y/n)."""
    accepted = decisions.filter(F.lower("decision") == "y").select("country_code", "fingerprint").distinct()
    return merge_plan(groups.join(accepted, ["country_code", "fingerprint"], "left_semi"))


@dataclass(frozen=True)
class MergeRun:
    """What a merge did: the counters {groups, merged_masters, repointed_rows, skipped, errors}, and the tables after it."""

    counters: dict[str, int]
    plan: DataFrame
    failed: DataFrame
    resolved: DataFrame
    documents: DataFrame


def auto_merge(resolved: DataFrame, documents: DataFrame, variations: DataFrame, least: int = 2, countries: list[str] | None = None, masters: DataFrame | None = None, limit: int | None = None, dry_run: bool = False) -> MergeRun:
    """Merges masters that share fingerprints: finds groups, checks them, repoints rows and unites documents.

    countries and masters restrict the groups; limit takes so many (the largest first) and counts the rest as skipped; a
    dry run only plans. A group fails as a whole if one of its masters has no document: its masters stay as they are, it
    counts as an error, and the other groups go on. The input tables are never changed, so a run that breaks off can be
    run again.
    """
    groups = duplicate_groups(variations, None, least, countries, masters)
    order = F.row_number().over(W.orderBy(F.desc("master_count"), "country_code", "fingerprint"))
    total = groups.count()
    if limit is not None:
        groups = groups.withColumn("rank", order).filter(F.col("rank") <= limit).drop("rank")
    members = groups.select("country_code", "fingerprint", F.explode("master_ids").alias("master_id"))
    without = members.join(documents.select("master_id").distinct(), "master_id", "left_anti")
    failed = durable(without.groupBy("country_code", "fingerprint").agg(F.array_sort(F.collect_list("master_id")).alias("missing")))
    sound = durable(members.join(failed, ["country_code", "fingerprint"], "left_anti"))
    first = sound.groupBy("country_code", "fingerprint").agg(F.min("master_id").alias("b"))
    edges = sound.join(first, ["country_code", "fingerprint"]).filter("master_id <> b").select(F.col("master_id").alias("a"), "b")
    found = connected_components(edges)
    plan = durable(found.filter("node <> component").select(F.col("node").alias("master_id"), F.col("component").alias("primary_id")))
    taken, errors = groups.count(), failed.count()
    counters = {"groups": taken - errors, "merged_masters": plan.count(), "repointed_rows": resolved.join(plan, "master_id", "left_semi").count(), "skipped": total - taken, "errors": errors}
    if dry_run:
        return MergeRun(counters | {"repointed_rows": 0}, plan, failed, resolved, documents)
    if counters["merged_masters"] and not counters["repointed_rows"]:
        warnings.warn("the merged masters had no rows", stacklevel=2)
    return MergeRun(counters, plan, failed, repoint(resolved, plan), merge_documents(documents, plan))
