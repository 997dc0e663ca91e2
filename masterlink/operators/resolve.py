"""Resolution of firms to masters in closed form.

Taken one after another by id, each row asks the stages in order, and a row that no stage wins becomes a new master.
Every possible match lies within a class, the rows of one country whose names have the same multiset of tokens, so the
outcome of the sequence can be computed class by class, over distinct names:

* the class's first row is a master;
* in a class with a distinctive token, a name's hole signature (its tokens, articles as holes) matches masters of the same
  signature (CANONICAL_EXACT) or, with an alphabetic one, masters whose signature differs by one shift (PHRASE_SLOP);
* a row with a lettered fingerprint otherwise joins the first master (TOKEN_COVERAGE);
* what is left starts a master of its own. In classes with a distinctive token these are, by signature, the first rows
  without a lettered fingerprint, accepted in order unless an accepted one is within the slop.

Rows join their name's outcome and compare their id with the few masters of the class; no class is gathered in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masterlink.config import INTENDED, SCORES, Profile
from masterlink.functions import text as T
from masterlink.operators.analyse import analyse
from masterlink.sources.rules import Vocabulary

MASTERS = "array<struct<id:bigint,gap:string>>"


def class_masters(names: DataFrame, profile: Profile = INTENDED) -> DataFrame:
    """Adds first (the class's first id) and masters (its masters by id) to analysed distinct names with first_id."""
    covered = F.col("lettered") & F.lit(profile.token_coverage_wins)
    keys = (F.col("country_code").alias("__cc"), F.col("class_key").alias("__key"))
    same = F.col("country_code").eqNullSafe(F.col("__cc")) & F.col("class_key").eqNullSafe(F.col("__key"))
    # Starts are gathered once for each class, not for each of its names; a class has one core gate.
    candidate = F.when(~covered & F.col("core"), F.struct(F.col("first_id").alias("id"), F.col("gap_signature").alias("gap")))
    classes = names.groupBy(*keys).agg(F.min("first_id").alias("first"), F.min_by("gap_signature", "first_id").alias("first_gap"), F.collect_set(candidate).alias("starts"), F.first("alpha_core").alias("alpha_core"))
    classes = classes.withColumn("starts", F.array_sort(F.filter("starts", lambda s: s["gap"] != F.col("first_gap"))))

    def accept(masters: Column, c: Column) -> Column:
        known = F.exists(masters, lambda m: (m["gap"] == c["gap"]) | (F.col("alpha_core") & F.coalesce(T.slop_distance(m["gap"], c["gap"]) <= profile.slop, F.lit(False))))
        return F.when(known, masters).otherwise(F.concat(masters, F.array(c)))

    first = F.array(F.struct(F.col("first").alias("id"), F.col("first_gap").alias("gap"))).cast(MASTERS)
    classes = classes.select("__cc", "__key", "first", F.aggregate("starts", first, accept).alias("masters"))
    return names.join(classes, same).drop("__cc", "__key")


def decide(rows: DataFrame, profile: Profile = INTENDED) -> DataFrame:
    """Adds match_type, master_id, match_score and match_details to rows joined with class_masters."""
    earlier = lambda test: F.array_min(F.filter("masters", lambda m: (m["id"] < F.col("id")) & test(m)))["id"]
    same = F.when(F.col("core"), earlier(lambda m: m["gap"] == F.col("gap_signature")))
    near = F.when(F.col("alpha_core"), earlier(lambda m: F.coalesce(T.slop_distance(m["gap"], F.col("gap_signature")) <= profile.slop, F.lit(False))))
    cover = F.when(F.col("lettered") & F.lit(profile.token_coverage_wins) & (F.col("first") < F.col("id")), F.col("first"))
    # A stage wins with its score only if that reaches the stage's threshold.
    on = {s.name: s.enabled and s.score >= s.min_score for s in profile.stages}
    scores = SCORES | {s.name: s.score for s in profile.stages}
    ids = {"CANONICAL_EXACT": same, "PHRASE_SLOP": near, "TOKEN_COVERAGE": cover}
    ids = {k: F.when(F.col("reason").isNull() & F.lit(on.get(k, False)), v) for k, v in ids.items()}
    won = None
    for name, found in ids.items():
        won = F.when(found.isNotNull(), name) if won is None else won.when(found.isNotNull(), name)
    kind = F.when(F.col("reason") == "empty", F.lit(None)).when(F.col("reason").isNotNull(), "EXCLUDED").otherwise(F.coalesce(won, F.when(F.col("dirty"), "DIRTY_DATA").otherwise("NEW_MASTER")))
    rows = rows.withColumn("match_type", kind)
    score = F.create_map(*(F.lit(x) for kv in scores.items() for x in kv))[F.col("match_type")]
    matched = F.col("match_type").isin(*ids)
    rows = rows.withColumn("master_id", F.when(F.col("match_type").isNull(), F.lit(None)).when(matched, F.coalesce(*ids.values())).otherwise(F.col("id")))
    details = (
        F.when(matched, T.details(F.col("match_type"), score))
        .when(F.col("match_type") == "EXCLUDED", F.concat(F.lit("EXCLUDED: "), F.col("reason")))
        .when(F.col("match_type") == "DIRTY_DATA", "address words only")
        .when(F.col("match_type") == "NEW_MASTER", "no relevant matches")
    )
    return rows.withColumns({"match_score": score, "match_details": details})


def distinct_names(firms: DataFrame) -> DataFrame:
    """Names by country with the first id. Partial sums leave one row per name and task before the shuffle."""
    return firms.groupBy("name", "country_code").agg(F.min("id").alias("first_id"), F.count("*").alias("rows"))


def analysed_names(firms: DataFrame, vocabulary: Vocabulary, profile: Profile = INTENDED) -> DataFrame:
    return analyse(distinct_names(firms), vocabulary, profile)


def resolve_batch(firms: DataFrame, vocabulary: Vocabulary, profile: Profile = INTENDED, names: DataFrame | None = None) -> DataFrame:
    """Every row of (id, name, country_code, ...) with match_type, master_id, match_score and match_details.

    Blank names keep nulls. `names` may pass analysed names that are at hand.
    """
    names = analysed_names(firms, vocabulary, profile) if names is None else names
    # Excluded names stand alone, so that they meet in no class.
    alone = F.when(F.col("reason").isNull(), F.col("class_key")).otherwise(F.concat(F.lit("\x00"), F.coalesce("name", F.lit(""))))
    outcome = class_masters(names.withColumn("class_key", alone), profile)
    outcome = outcome.select("name", "country_code", "gap_signature", "core", "alpha_core", "lettered", "dirty", "first", "masters", "reason")
    theirs = outcome.withColumnsRenamed({"name": "__name", "country_code": "__country"})
    rows = firms.join(theirs, firms["name"].eqNullSafe(theirs["__name"]) & firms["country_code"].eqNullSafe(theirs["__country"]))
    return decide(rows, profile).select(*firms.columns, "match_type", "master_id", "match_score", "match_details", "reason")


def stage_trace(resolved: DataFrame, profile: Profile = INTENDED) -> DataFrame:
    """Adds trace: the stages that were asked, in order, up to the one that won."""
    stages = sorted((s for s in profile.stages if s.enabled), key=lambda s: s.order)
    order = F.create_map(*(F.lit(x) for s in stages for x in (s.name, s.order)))[F.col("match_type")]
    last = F.coalesce(order, F.lit(max(s.order for s in stages)))
    entries = [F.when(F.lit(s.order) <= last, F.struct(F.lit(s.name).alias("stage_name"), F.lit(s.order).alias("stage_order"), (F.col("match_type") == s.name).alias("matched"), F.when(F.col("match_type") == s.name, F.col("match_score")).otherwise(0.0).alias("es_score"), F.when(F.col("match_type") == s.name, F.col("master_id")).alias("master_id"))) for s in stages]
    asked = F.col("match_type").isNotNull() & (F.col("match_type") != "EXCLUDED")
    none = F.array().cast("array<struct<stage_name:string,stage_order:int,matched:boolean,es_score:double,master_id:bigint>>")
    return resolved.withColumn("trace", F.when(asked, F.filter(F.array(*entries), lambda x: x.isNotNull())).otherwise(none))


def stage_log(traced: DataFrame, all_stages: bool = False) -> DataFrame:
    """One row for each stage that won or, with all_stages, was asked."""
    rows = traced.select(F.col("id").cast("string").alias("input_id"), F.col("name").alias("input_name"), "country_code", F.inline("trace"))
    return rows if all_stages else rows.filter("matched")


def audit_rows(traced: DataFrame) -> DataFrame:
    """The last word on each processed row; excluded and blank rows have none."""
    rows = traced.filter(F.col("match_type").isNotNull() & (F.col("match_type") != "EXCLUDED"))
    return rows.select(
        F.col("id").cast("string").alias("input_id"),
        F.col("name").alias("input_name"),
        "country_code",
        F.col("master_id").cast("string").alias("final_master_id"),
        F.col("match_type").alias("final_stage_name"),
        F.col("match_score").alias("final_score"),
        F.size(F.filter("trace", lambda x: x["matched"])).cast("long").alias("total_matched_stages"),
    )


def master_documents(resolved: DataFrame, profile: Profile = INTENDED) -> DataFrame:
    """(master_id, country_code, variations, phone_number): the master's own name and those that its wins taught it.

    Names and numbers are deduplicated before they are gathered; a master's distinct ones make up its document.
    """
    teaching = [s.name for s in profile.stages if s.learns] + ["NEW_MASTER", "DIRTY_DATA"]
    rows = resolved.filter(F.col("match_type").isin(*teaching)).withColumn("name", T.light_clean(F.col("name"), profile.unicode_cleaner))
    phone = F.col("phone") if "phone" in resolved.columns else F.lit(None).cast("string")
    distinct = rows.select("master_id", "country_code", "name", phone.alias("phone")).distinct()
    gathered = distinct.groupBy("master_id", "country_code").agg(F.array_sort(F.collect_set(F.when(F.col("name") != "", F.col("name")))).alias("variations"), F.array_sort(F.collect_set("phone")).alias("phone_number"))
    return gathered


def resolve_incremental(batch: DataFrame, known: DataFrame, vocabulary: Vocabulary, profile: Profile = INTENDED) -> DataFrame:
    """Resolve new rows against rows resolved before (with the columns of resolve_batch) and each other.

    Ids of the batch must be larger than all known ones. Only masters of countries in the batch matter: a known master
    stands for its class with its own name, and known rows are never changed.
    """
    masters = known.filter(F.col("match_type").isin("NEW_MASTER", "DIRTY_DATA")).select("id", "name", "country_code")
    countries = batch.select("country_code").distinct()
    masters = masters.join(countries, "country_code", "left_semi").select("id", "name", "country_code")
    fresh = batch.select("id", "name", "country_code")
    both = resolve_batch(masters.withColumn("known", F.lit(True)).unionByName(fresh.withColumn("known", F.lit(False))), vocabulary, profile)
    more = [c for c in batch.columns if c not in fresh.columns]
    out = both.filter(~F.col("known")).drop("known")
    return out.join(batch.select("id", *more), "id") if more else out
