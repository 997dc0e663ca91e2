"""Quality checks of a resolution: over-merged and split masters, pair rubrics, probes and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from masterlink.config import MATCHED_TYPES, QaSettings
from masterlink.functions import text as T
from masterlink.sources.rules import Vocabulary, by_country


def core_of(name: Column, country: Column, vocabulary: Vocabulary, drop_geo: bool = False) -> Column:
    geo = by_country(vocabulary.geo(), country) if drop_geo else None
    return T.normalize_core(name, by_country(vocabulary.fragments(), country), by_country(vocabulary.sources("legal_suffixes", "one"), country), geo)


def matched_rows(resolved: DataFrame) -> DataFrame:
    """(id, master_code, name, country, match_type) of rows with a master; no country counts as DEFAULT."""
    country = F.upper(F.trim(F.coalesce("country_code", F.lit(""))))
    return resolved.filter(F.col("master_id").isNotNull() & (F.col("match_type") != "EXCLUDED")).select("id", F.col("master_id").alias("master_code"), F.trim("name").alias("name"), F.when(country == "", "DEFAULT").otherwise(country).alias("country"), "match_type")


def over_merge(rows: DataFrame, vocabulary: Vocabulary, settings: QaSettings = QaSettings()) -> DataFrame:
    """Masters whose members' names overlap little: (master_code, member_count, mean_overlap, dominant_match_type, sample_names).

    The mean is over all pairs of members. Members with the same core are counted together, so that pairs are made of
    distinct cores only; copies of a name, however many, make none. A master of many cores is cut into pieces, each of
    which meets all its cores in a task of its own.
    """
    cored = rows.withColumn("core", F.array_sort(F.array_distinct(core_of(F.col("name"), F.col("country"), vocabulary))))
    cores = cored.groupBy("master_code", "core").agg(F.count("*").alias("n"))
    members = cores.groupBy("master_code").agg(F.sum("n").alias("member_count"), F.sum(F.when(F.size("core") > 0, F.col("n") * (F.col("n") - 1) / 2).otherwise(0.0)).alias("same"), F.count("*").alias("cores"))
    several = members.filter((F.col("member_count") > 1) & (F.col("cores") > 1)).select("master_code", F.ceil(F.col("cores") / settings.piece).cast("int").alias("pieces"))
    cores = cores.join(several, "master_code")
    a = cores.select("master_code", F.pmod(F.xxhash64("core"), F.col("pieces")).cast("int").alias("piece"), F.col("core").alias("x"), F.col("n").alias("m"))
    b = cores.select("master_code", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.col("core").alias("y"), "n")
    pairs = a.join(b, ["master_code", "piece"]).filter("x < y")
    across = pairs.groupBy("master_code").agg(F.sum(T.token_overlap(F.col("x"), F.col("y")) * F.col("m") * F.col("n")).alias("across"))
    scored = members.filter("member_count > 1").join(across, "master_code", "left")
    mean = (F.col("same") + F.coalesce("across", F.lit(0.0))) / (F.col("member_count") * (F.col("member_count") - 1) / 2)
    scored = scored.withColumn("mean_overlap", F.round(mean, 9)).filter(F.col("mean_overlap") < settings.overlap_threshold)
    types = rows.groupBy("master_code", "match_type").agg(F.count("*").alias("n"))
    types = types.groupBy("master_code").agg(F.min_by("match_type", F.struct(-F.col("n"), "match_type")).alias("dominant_match_type"))
    rank = F.row_number().over(W.partitionBy("master_code").orderBy("id"))
    flagged = rows.join(scored.select("master_code"), "master_code", "left_semi").withColumn("rank", rank).filter(F.col("rank") <= settings.samples)
    names = flagged.groupBy("master_code").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "name"))), lambda s: s["name"]).alias("sample_names"))
    return scored.join(types, "master_code").join(names, "master_code").select("master_code", "member_count", "mean_overlap", "dominant_match_type", "sample_names")


def splits(rows: DataFrame, vocabulary: Vocabulary, settings: QaSettings = QaSettings()) -> DataFrame:
    """Cores that stand under several masters of one country: (country, core_signature, master_codes, affected_rows, sample_names)."""
    cored = rows.withColumn("core_signature", F.array_join(F.array_sort(core_of(F.col("name"), F.col("country"), vocabulary)), " ")).filter("core_signature <> ''")
    counts = cored.groupBy("country", "core_signature", "master_code", "name").agg(F.count("*").alias("n"))
    groups = counts.groupBy("country", "core_signature").agg(F.array_sort(F.collect_set("master_code")).alias("master_codes"), F.sum("n").alias("affected_rows"), F.slice(F.array_sort(F.collect_set("name")), 1, settings.samples).alias("sample_names"))
    return groups.filter(F.size("master_codes") > 1)


def core_relation(a: Column, b: Column) -> Column:
    """identical, subset, partial_overlap or disjoint."""
    shared = F.size(F.array_intersect(a, b))
    x, y = F.size(F.array_distinct(a)), F.size(F.array_distinct(b))
    return F.when((shared == x) & (shared == y), "identical").when((shared > 0) & (shared == F.least(x, y)), "subset").when(shared > 0, "partial_overlap").otherwise("disjoint")


def rubric_basic(a: Column, b: Column, core_a: Column, core_b: Column, leak: Column) -> Column:
    """Leak, exact name, same core set or same first four core words; anything else is wrong."""
    same = F.array_sort(F.array_distinct(core_a)) == F.array_sort(F.array_distinct(core_b))
    first = (F.size(core_a) > 0) & (F.slice(core_a, 1, 4) == F.slice(core_b, 1, 4))
    return F.when(leak, "WRONG").when(F.lower(F.trim(a)) == F.lower(F.trim(b)), "CORRECT").when((F.size(core_a) > 0) & same, "CORRECT").when(first, "CORRECT").otherwise("WRONG")


def rubric_tokens(core_a: Column, core_b: Column, generic: Column, name_ratio: Column) -> Column:
    """The over-merge rubric: identical, subset by one generic or one-letter word, typo, and shared-word rules."""
    x, y = F.array_distinct(core_a), F.array_distinct(core_b)
    shared = F.array_intersect(x, y)
    extra = F.concat(F.array_except(x, y), F.array_except(y, x))
    light = F.forall(extra, lambda t: (F.length(t) == 1) | F.array_contains(generic, t))
    real = F.filter(shared, lambda t: ~F.array_contains(generic, t))
    return (
        F.when((F.size(x) > 0) & (F.array_sort(x) == F.array_sort(y)), "CORRECT")
        .when((F.size(x) > 0) & (core_a == core_b), "CORRECT")
        .when((F.size(extra) == 1) & (F.size(shared) > 0) & light, "CORRECT")
        .when((F.size(x) >= 2) & (F.size(y) >= 2) & (name_ratio >= 0.9), "CORRECT")
        .when(F.size(shared) == 0, "WRONG")
        .when(F.size(real) == 0, "WRONG")
        .when(F.abs(F.size(x) - F.size(y)) > 1, "WRONG")
        .when(F.size(real) >= 2, "CORRECT")
        .otherwise("UNCERTAIN")
    )


def rubric_variants(a: Column, b: Column, core_a: Column, core_b: Column, leak: Column) -> Column:
    """The rubric with spelling, abbreviation and typo variants; UNCERTAIN where no rule speaks."""
    x, y = F.array_distinct(core_a), F.array_distinct(core_b)
    shared = F.array_intersect(x, y)
    begins = F.exists(x, lambda s: F.exists(y, lambda t: (F.length(s) > 2) & (F.length(t) > 2) & (s.startswith(t) | t.startswith(s))))
    return (
        F.when(leak, "WRONG")
        .when(F.lower(F.trim(a)) == F.lower(F.trim(b)), "CORRECT")
        .when((F.size(x) == 0) | (F.size(y) == 0), "UNCERTAIN")
        .when(F.array_sort(x) == F.array_sort(y), "CORRECT")
        .when(T.spelling_key(a) == T.spelling_key(b), "CORRECT")
        .when(T.abbreviation_pair(a, b), "CORRECT")
        .when((F.size(x) == 1) & (F.size(y) == 1) & T.typo_pair(F.get(x, F.lit(0)), F.get(y, F.lit(0))), "CORRECT")
        .when((F.size(F.array_except(x, y)) == 0) | (F.size(F.array_except(y, x)) == 0), "WRONG")
        .when((F.size(shared) == 0) & ~begins, "WRONG")
        .when(F.size(shared) == 0, "UNCERTAIN")
        .otherwise("UNCERTAIN")
    )


def qa_pairs(resolved: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Each matched row with its master: ids, names, countries, cores, relation and leak flag."""
    masters = resolved.filter(F.col("id") == F.col("master_id")).select(F.col("id").alias("master_id"), F.col("name").alias("master_name"), F.col("country_code").alias("master_country"))
    variants = resolved.filter(F.col("match_type").isin(*MATCHED_TYPES)).select("master_id", F.col("id").alias("variant_id"), F.col("name").alias("variant_name"), F.col("country_code").alias("variant_country"), F.col("match_type").alias("stage"), "match_score")
    pairs = variants.join(masters, "master_id")
    pairs = pairs.withColumn("core_master", core_of(F.col("master_name"), F.col("master_country"), vocabulary)).withColumn("core_variant", core_of(F.col("variant_name"), F.col("variant_country"), vocabulary))
    return pairs.withColumn("core_rel", core_relation(F.col("core_master"), F.col("core_variant"))).withColumn("leak", F.col("master_country") != F.col("variant_country"))


def verdict_summary(verdicts: DataFrame, by: str = "stage", verdict: str = "verdict") -> DataFrame:
    """Counts of each verdict and precision, correct over correct and wrong."""
    n = lambda v: F.count_if(F.col(verdict) == v)
    out = verdicts.groupBy(by).agg(F.count("*").alias("pairs"), n("CORRECT").alias("correct"), n("WRONG").alias("wrong"), n("UNCERTAIN").alias("uncertain"))
    judged = F.col("correct") + F.col("wrong")
    return out.withColumn("precision", F.when(judged > 0, F.round(F.col("correct") / judged, 6)))


def golden_probe(resolved: DataFrame, golden: DataFrame) -> DataFrame:
    """One row: violations, found, wanted, recall, precision. golden holds (id, group): same group, same firm."""
    rows = golden.join(resolved.select("id", "master_id"), "id")
    sizes = golden.groupBy("group").agg(F.count("*").alias("size"))
    rows = rows.join(sizes, "group")
    by_master = rows.groupBy("master_id").agg(F.count("*").alias("n"), F.count_distinct("group").alias("groups"))
    wrong = by_master.agg(F.coalesce(F.sum(F.when(F.col("groups") > 1, F.col("n") - 1)), F.lit(0)).alias("violations"))
    first = rows.groupBy("group", "master_id").agg(F.count("*").alias("n")).groupBy("group").agg(F.max("n").alias("best"), F.sum("n").alias("size"))
    recall = first.agg(F.coalesce(F.sum(F.when((F.col("size") > 1) & (F.col("best") > 1), F.col("best"))), F.lit(0)).alias("found"), F.coalesce(F.sum(F.when(F.col("size") > 1, F.col("size"))), F.lit(0)).alias("wanted"))
    both = wrong.withColumn("k", F.lit(1)).join(recall.withColumn("k", F.lit(1)), "k").drop("k")
    return both.withColumns({"recall": F.when(F.col("wanted") > 0, F.round(F.col("found") / F.col("wanted"), 6)), "precision": F.when(F.col("found") + F.col("violations") > 0, F.round(F.col("found") / (F.col("found") + F.col("violations")), 6))})


def anchor_mismatches(resolved: DataFrame, limit: int = 100) -> DataFrame:
    """Rows whose name differs from their master's, the first `limit` by id."""
    a = resolved.filter("match_type = 'NEW_MASTER'").select("master_id", F.col("name").alias("anchor_name"))
    b = resolved.filter("match_type <> 'NEW_MASTER'").select("master_id", "id", "name", "match_type")
    return a.join(b, "master_id").filter("name <> anchor_name").orderBy("id").limit(limit)


def exclusion_report(rows: DataFrame, samples: int = 8) -> DataFrame:
    """(reason, n, samples): how many rows each reason excludes, with the first different names."""
    excluded = rows.filter(F.col("reason").isNotNull())
    counts = excluded.groupBy("reason").agg(F.count("*").alias("n"))
    rank = F.row_number().over(W.partitionBy("reason").orderBy("name"))
    shown = excluded.select("reason", "name").distinct().withColumn("rank", rank).filter(F.col("rank") <= samples)
    shown = shown.groupBy("reason").agg(F.array_sort(F.collect_list("name")).alias("samples"))
    return counts.join(shown, "reason")


def type_counts(resolved: DataFrame) -> DataFrame:
    """Rows by match type, and in all under TOTAL."""
    kind = F.coalesce("match_type", F.lit("SKIPPED"))
    out = resolved.select(kind.alias("match_type")).rollup("match_type").agg(F.count("*").alias("n"))
    return out.withColumn("match_type", F.coalesce("match_type", F.lit("TOTAL")))


def snapshot(resolved: DataFrame) -> DataFrame:
    """One row: total_rows, unmatched, unique_masters."""
    return resolved.agg(F.count("*").alias("total_rows"), F.count_if(F.col("master_id").isNull()).alias("unmatched"), F.count_distinct("master_id").alias("unique_masters"))


def group_sizes(resolved: DataFrame) -> DataFrame:
    """(members, masters): how many masters have how many rows."""
    sizes = resolved.filter(F.col("master_id").isNotNull() & (F.col("match_type") != "EXCLUDED")).groupBy("master_id").agg(F.count("*").alias("members"))
    return sizes.groupBy("members").agg(F.count("*").alias("masters"))


def score_spread(resolved: DataFrame) -> DataFrame:
    """(match_type, least, middle, most) of scores."""
    return resolved.filter(F.col("match_type").isNotNull()).groupBy("match_type").agg(F.min("match_score").alias("least"), F.median("match_score").alias("middle"), F.max("match_score").alias("most"))


def undermerge_clusters(resolved: DataFrame, vocabulary: Vocabulary, samples: int = 5) -> DataFrame:
    """Masters of one country with the same core and the same legal forms: (country_code, cluster_core, legal, masters, names)."""
    anchors = resolved.filter(F.col("match_type") == "NEW_MASTER")
    core = F.array_join(core_of(F.col("name"), F.col("country_code"), vocabulary), " ")
    legal = F.array_join(F.array_sort(F.array_distinct(F.array_intersect(T.tokenize(F.col("name")), by_country(vocabulary.tokens("legal_suffixes"), F.col("country_code"))))), " ")
    rows = anchors.select("country_code", core.alias("cluster_core"), legal.alias("legal"), "name").filter("cluster_core <> ''")
    return rows.groupBy("country_code", "cluster_core", "legal").agg(F.count("*").alias("masters"), F.slice(F.array_sort(F.collect_set("name")), 1, samples).alias("names")).filter("masters > 1")


def top_masters(resolved: DataFrame, k: int) -> DataFrame:
    """The k masters with the most rows, ties to the smaller id."""
    sizes = resolved.filter(F.col("match_type").isin(*MATCHED_TYPES, "NEW_MASTER", "DIRTY_DATA")).groupBy("master_id").agg(F.count("*").alias("members"))
    return sizes.orderBy(F.desc("members"), "master_id").limit(k)
