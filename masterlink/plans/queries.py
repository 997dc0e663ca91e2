"""The registered queries over the driver's tables: each callable takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masterlink.config import AS_WRITTEN, INTENDED, WIDE, ColumnMapping, Profile
from masterlink.functions import text as T
from masterlink.operators import analyse as A
from masterlink.operators import dedup, probes, qa, resolve, retired
from masterlink.operators.graph import connected_components
from masterlink.plans.durable import durable
from masterlink.sources import firms as firm_tables
from masterlink.sources.firms import firms, mentions, read_firms, update_firms
from masterlink.sources.rules import Vocabulary, by_country, claimed_rules, parse_rules, rule_collisions, rule_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_VOCABULARY: Vocabulary | None = None


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def vocabulary(spark: SparkSession) -> Vocabulary:
    """The packaged dictionaries, read once per process."""
    global _VOCABULARY
    if _VOCABULARY is None:
        _VOCABULARY = Vocabulary.load(spark)
    return _VOCABULARY


def names(spark: SparkSession, sf_dir: str, profile: Profile = INTENDED) -> DataFrame:
    return resolve.analysed_names(firms(spark, sf_dir), vocabulary(spark), profile)


def resolved(spark: SparkSession, sf_dir: str, profile: Profile = INTENDED, analysed: DataFrame | None = None) -> DataFrame:
    return resolve.resolve_batch(firms(spark, sf_dir), vocabulary(spark), profile, analysed)


def stored(spark: SparkSession, sf_dir: str, analysed: DataFrame | None = None) -> DataFrame:
    """The resolved rows as a written table, for queries that read them several times."""
    return durable(resolved(spark, sf_dir, analysed=analysed))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _per_firm(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Columns of the name analysis, for each distinct name."""
    return names(spark, sf_dir).select("name", "country_code", *columns)


# Filters and gates


@query
def filter_classify_input(spark, sf_dir):
    return _per_firm(spark, sf_dir, "reason")


@query
def filter_invalid_country(spark, sf_dir):
    rows = firms(spark, sf_dir)
    return rows.groupBy("country_code").agg(F.count("*").alias("n")).withColumn("indexable", A.indexable(F.col("country_code"), vocabulary(spark).countries))


@query
def exclusion_report(spark, sf_dir):
    voc = vocabulary(spark)
    rows = firms(spark, sf_dir)
    out = qa.exclusion_report(rows.withColumn("reason", A.exclusion_reason(F.col("name"), F.col("country_code"), voc)))
    return out.withColumn("samples", F.array_join("samples", "|"))


@query
def placeholder_semi_join(spark, sf_dir):
    voc = vocabulary(spark)
    words = spark.createDataFrame([(c, p) for c, v in voc.sources("non_firm_placeholders").items() for p in v], "country_code string, norm string")
    rows = firms(spark, sf_dir).withColumn("norm", T.input_norm(F.col("name")))
    return rows.join(F.broadcast(words), ["country_code", "norm"], "left_semi").select("id", "country_code", "norm")


@query
def generic_gate(spark, sf_dir):
    return _per_firm(spark, sf_dir, "core", "alpha_core")


@query
def fingerprint_gate(spark, sf_dir):
    return _per_firm(spark, sf_dir, "lettered")


@query
def address_dirty(spark, sf_dir):
    return _per_firm(spark, sf_dir, "dirty")


@query
def country_filter(spark, sf_dir):
    return firms(spark, sf_dir).filter(F.col("country_code") == "MX").select("id", "name")


def _table(spark, sf_dir):
    """The firms as a table with other column names, of which every third row has a master already."""
    rows = firms(spark, sf_dir)
    return rows.select(F.col("id").alias("row_no"), F.col("name").alias("title"), F.col("country_code").alias("cc"), F.when(F.col("id") % 3 == 0, "old").alias("master_code"))


TABLE_MAPPING = ColumnMapping(id="row_no", company_name="title", country_code="cc")


@query
def unprocessed_rows(spark, sf_dir):
    return read_firms(_table(spark, sf_dir), TABLE_MAPPING, country="MX").select("id", "name", "country_code")


@query
def bulk_update(spark, sf_dir):
    found = resolved(spark, sf_dir).withColumnRenamed("master_id", "master_code")
    return update_firms(_table(spark, sf_dir), found, TABLE_MAPPING).select("row_no", "title", "cc", "master_code", "match_score", "match_type")


@query
def reset_results(spark, sf_dir):
    return firm_tables.reset_results(_table(spark, sf_dir), TABLE_MAPPING, ["MX"]).select("row_no", "cc", "master_code")


# Text functions


@query
def light_clean(spark, sf_dir):
    rows = firms(spark, sf_dir).select("name").distinct()
    return rows.select("name", T.light_clean(F.col("name")).alias("cleaned"))


@query
def light_clean_documents(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.light_clean(F.col("text"), unicode=False).alias("cleaned"))


@query
def consecutive_dedup(spark, sf_dir):
    rows = firms(spark, sf_dir).select("name").distinct()
    return rows.select("name", F.array_join(T.drop_repeats(T.words(F.lower("name"))), " ").alias("deduped"))


@query
def acronym_glue(spark, sf_dir):
    rows = firms(spark, sf_dir).select("name").distinct()
    return rows.select("name", T.glue_acronyms(F.col("name")).alias("glued"))


@query
def tokenize_explode(spark, sf_dir):
    return _per_firm(spark, sf_dir, "raw").select("name", "country_code", F.posexplode("raw").alias("pos", "token"))


@query
def synonym_canonicalise(spark, sf_dir):
    return _per_firm(spark, sf_dir, F.array_join("clean", " ").alias("clean"))


@query
def article_stop(spark, sf_dir):
    return _per_firm(spark, sf_dir, F.array_join("tokens", " ").alias("tokens"), "gap_signature")


@query
def token_count(spark, sf_dir):
    return _per_firm(spark, sf_dir, "token_count")


@query
def canonical_full(spark, sf_dir):
    return _per_firm(spark, sf_dir, "canonical_full")


@query
def fingerprint(spark, sf_dir):
    return _per_firm(spark, sf_dir, "fingerprint")


@query
def normalize_core(spark, sf_dir):
    core = qa.core_of(F.col("name"), F.col("country_code"), vocabulary(spark))
    kept = qa.core_of(F.col("name"), F.col("country_code"), vocabulary(spark), drop_geo=True)
    return names(spark, sf_dir).select("name", "country_code", F.array_join(core, " ").alias("core"), F.array_join(kept, " ").alias("core_no_geo"))


@query
def variation_key(spark, sf_dir):
    rows = firms(spark, sf_dir).select("name").distinct()
    return rows.select("name", T.variation_key(F.col("name")).alias("key"))


@query
def master_variations(spark, sf_dir):
    docs = resolve.master_documents(resolved(spark, sf_dir))
    return docs.select("master_id", "country_code", F.array_join("variations", "|").alias("variations"), F.array_join("phone_number", "|").alias("phones"))


@query
def retired_scalars(spark, sf_dir):
    n = F.lower("name")
    rows = firms(spark, sf_dir).select("name").distinct()
    return rows.select(
        "name",
        T.join_spelled_letters(n, ["ltd", "inc"]).alias("spelled"),
        T.drop_brackets(F.concat("name", F.lit(" (old) [x]"))).alias("unbracketed"),
        T.before_address(F.concat("name", F.lit(" SUITE 5")), ["limited", "ltd"]).alias("anchored"),
        F.array_join(T.split_fused(F.array(F.lit("pvtltd"), F.lower("name")), {"pvtltd": "pvt ltd"}), "|").alias("unfused"),
    )


# Rules


@query
def rule_claim_precedence(spark, sf_dir):
    voc = vocabulary(spark)
    return claimed_rules(parse_rules(rule_files(spark)), voc.countries).groupBy("country", "category").agg(F.count("*").alias("sources"), F.count_distinct("target").alias("targets"))


@query
def rule_sources(spark, sf_dir):
    return claimed_rules(parse_rules(rule_files(spark)), vocabulary(spark).countries)


@query
def synonym_collisions(spark, sf_dir):
    return rule_collisions(parse_rules(rule_files(spark)), vocabulary(spark).countries).withColumn("targets", F.array_join("targets", "|"))


@query
def legal_fragments(spark, sf_dir):
    rules = claimed_rules(parse_rules(rule_files(spark)), vocabulary(spark).countries).filter("category = 'legal_suffixes'")
    pieces = rules.select("country", F.explode(F.concat(F.split("source", r"[ .,&]+"), F.split("target", r"[ .,&]+"))).alias("fragment"))
    return pieces.filter(F.col("fragment").rlike(r"^\p{L}{1,4}$")).distinct()


@query
def token_sets(spark, sf_dir):
    voc = vocabulary(spark)
    sets = {"generic": voc.generic(), "legal": voc.tokens("legal_suffixes"), "sector": voc.tokens("business_sectors"), "address": voc.tokens("address_abbreviations"), "article": voc.sources("articles", "one"), "geo": voc.geo()}
    return spark.createDataFrame([(c, k, w) for k, v in sets.items() for c, ws in v.items() for w in ws], "country string, kind string, word string").groupBy("country", "kind").agg(F.count("*").alias("words"))


# Match stages


@query
def stage_canonical_exact(spark, sf_dir):
    return resolved(spark, sf_dir).filter("match_type = 'CANONICAL_EXACT'").select("id", "master_id")


@query
def stage_phrase_slop(spark, sf_dir):
    return resolved(spark, sf_dir).filter("match_type = 'PHRASE_SLOP'").select("id", "master_id")


@query
def stage_phrase_slop_wide(spark, sf_dir):
    return resolved(spark, sf_dir, WIDE).filter("match_type = 'PHRASE_SLOP'").select("id", "master_id")


@query
def stage_token_coverage(spark, sf_dir):
    return resolved(spark, sf_dir).filter("match_type = 'TOKEN_COVERAGE'").select("id", "master_id")


@query
def resolve_master(spark, sf_dir):
    return resolved(spark, sf_dir).select("id", "match_type", "master_id", "match_score", "match_details")


@query
def resolve_as_written(spark, sf_dir):
    return resolved(spark, sf_dir, AS_WRITTEN).select("id", "match_type", "master_id")


@query
def resolve_mentions(spark, sf_dir):
    """The volume query: every mention of a firm in the order lines."""
    rows = mentions(spark, sf_dir)
    out = resolve.resolve_batch(rows, vocabulary(spark))
    return out.groupBy(F.coalesce("match_type", F.lit("SKIPPED")).alias("match_type")).agg(F.count("*").alias("n"), F.count_distinct("master_id").alias("masters"))


@query
def unmatched_anti_join(spark, sf_dir):
    rows = firms(spark, sf_dir)
    won = resolved(spark, sf_dir).filter("match_type IN ('CANONICAL_EXACT', 'PHRASE_SLOP', 'TOKEN_COVERAGE')").select("id")
    return rows.join(won, "id", "left_anti").select("id")


def _fuzzy_names(spark, sf_dir):
    rows = names(spark, sf_dir).filter("reason IS NULL")
    core = qa.core_of(F.col("name"), F.col("country_code"), vocabulary(spark))
    legal = by_country(vocabulary(spark).tokens("legal_suffixes"), F.col("country_code"))
    rows = rows.withColumn("core", core).withColumn("core_key", F.array_join("core", " "))
    return rows.withColumn("suffix", F.array_join(F.filter("raw", lambda t: F.array_contains(legal, t)), " "))


@query
def stage_tax_exact(spark, sf_dir):
    rows = firms(spark, sf_dir).withColumn("tax_number", F.concat(F.lit("tx-"), F.col("phone"), F.lit("."), F.substring("name", 1, 2)))
    return retired.tax_exact(rows)


@query
def stage_stripped_exact(spark, sf_dir):
    return retired.stripped_exact(_fuzzy_names(spark, sf_dir).withColumn("id", F.col("first_id")))


@query
def stage_strict_ordered(spark, sf_dir):
    return retired.strict_ordered(_fuzzy_names(spark, sf_dir).withColumn("id", F.col("first_id")))


@query
def stage_brand_anchor(spark, sf_dir):
    return retired.brand_anchor(_fuzzy_names(spark, sf_dir).withColumn("id", F.col("first_id")))


@query
def stage_token_subset(spark, sf_dir):
    return retired.token_subset(names(spark, sf_dir).filter("reason IS NULL"))


@query
def stage_ngram(spark, sf_dir):
    return retired.ngram_match(names(spark, sf_dir).filter("reason IS NULL"))


@query
def stage_suffix_fuzzy(spark, sf_dir):
    return retired.suffix_fuzzy(_fuzzy_names(spark, sf_dir))


# Logs, reports and counts


@query
def audit_rows(spark, sf_dir):
    return resolve.audit_rows(resolve.stage_trace(resolved(spark, sf_dir)))


@query
def stage_log(spark, sf_dir):
    return resolve.stage_log(resolve.stage_trace(resolved(spark, sf_dir)), all_stages=True)


@query
def match_type_counts(spark, sf_dir):
    return qa.type_counts(resolved(spark, sf_dir))


@query
def baseline_snapshot(spark, sf_dir):
    return qa.snapshot(resolved(spark, sf_dir))


@query
def group_size_histogram(spark, sf_dir):
    return qa.group_sizes(resolved(spark, sf_dir))


@query
def score_distribution(spark, sf_dir):
    return qa.score_spread(resolved(spark, sf_dir))


@query
def topk_masters(spark, sf_dir):
    return qa.top_masters(resolved(spark, sf_dir), 20)


@query
def anchor_self_join(spark, sf_dir):
    return qa.anchor_mismatches(stored(spark, sf_dir)).select("id", "name", "anchor_name", "match_type")


@query
def stage_waterfall(spark, sf_dir):
    return probes.stage_waterfall(resolved(spark, sf_dir))


@query
def stage_hits(spark, sf_dir):
    log = resolve.stage_log(resolve.stage_trace(resolved(spark, sf_dir)), all_stages=True)
    return log.groupBy("stage_name").agg(F.count("*").alias("asked"), F.count_if("matched").alias("won"))


@query
def legacy_writer(spark, sf_dir):
    return probes.legacy_update(resolved(spark, sf_dir))


@query
def matched_rows(spark, sf_dir):
    return qa.matched_rows(resolved(spark, sf_dir))


@query
def exact_name_masters(spark, sf_dir):
    return probes.exact_name_masters(firms(spark, sf_dir))


@query
def anti_self_probe(spark, sf_dir):
    return probes.other_of_same_signature(firms(spark, sf_dir), names(spark, sf_dir))


@query
def boosted_probe(spark, sf_dir):
    rows = firms(spark, sf_dir).join(names(spark, sf_dir).filter("reason IS NULL").select("name", "country_code", "canonical_full", "fingerprint"), ["name", "country_code"])
    return probes.boosted_probe(rows, [F.col("canonical_full"), F.col("fingerprint")])


@query
def boosted_tax_probe(spark, sf_dir):
    rows = firms(spark, sf_dir).join(names(spark, sf_dir).filter("reason IS NULL").select("name", "country_code", "canonical_full", "fingerprint"), ["name", "country_code"])
    rows = rows.withColumn("tax_number", F.concat(F.lit("t-"), F.col("phone"), F.substring("name", 1, 1)))
    return probes.boosted_probe(rows, [F.col("canonical_full"), F.col("fingerprint")], tax="tax_number")


@query
def count_remaining(spark, sf_dir):
    rows = resolved(spark, sf_dir)
    return rows.groupBy("country_code").agg(F.count_if(F.col("master_id").isNull()).alias("remaining"), F.count("*").alias("n"))


# Duplicates


def _variations(spark, sf_dir):
    """The resolved rows and their masters' fingerprints, from names that are analysed once."""
    analysed = durable(names(spark, sf_dir))
    rows = stored(spark, sf_dir, analysed)
    return rows, durable(dedup.master_fingerprints(rows, analysed))


@query
def dup_groups(spark, sf_dir):
    return dedup.duplicate_groups(_variations(spark, sf_dir)[1], cap=200).withColumn("master_ids", F.array_join("master_ids", ","))


@query
def merge_plan(spark, sf_dir):
    plan = dedup.merge_plan(dedup.duplicate_groups(_variations(spark, sf_dir)[1]))
    return plan.withColumn("secondaries", F.array_join("secondaries", ","))


@query
def repoint(spark, sf_dir):
    rows, variations = _variations(spark, sf_dir)
    plan = dedup.merge_map(variations)
    return dedup.repoint(rows, plan).select("id", "match_type", "master_id")


@query
def merge_variations(spark, sf_dir):
    rows, variations = _variations(spark, sf_dir)
    plan = dedup.merge_map(variations)
    docs = dedup.merge_documents(durable(resolve.master_documents(rows)), plan)
    return docs.select("master_id", "country_code", F.size("variations").cast("long").alias("variations"), F.size("phone_number").cast("long").alias("phones"))


@query
def potential_duplicates(spark, sf_dir):
    out = dedup.potential_duplicates(_variations(spark, sf_dir)[1])
    return out.withColumns({"master_ids": F.array_join("master_ids", ","), "sample_names": F.array_join("sample_names", "|")})


@query
def connected_components_query(spark, sf_dir):
    """Parts that share a firm name, as a graph of rows and first rows."""
    rows = firms(spark, sf_dir)
    first = rows.groupBy("name").agg(F.min("id").alias("b"))
    edges = rows.join(first, "name").select(F.col("id").alias("a"), "b")
    return connected_components(edges)


# Quality


@query
def over_merge(spark, sf_dir):
    rows = durable(qa.matched_rows(_by_name_length(spark, sf_dir)))
    out = qa.over_merge(rows, vocabulary(spark))
    return out.select("master_code", "member_count", F.round("mean_overlap", 6).alias("mean_overlap"), "dominant_match_type", F.array_join("sample_names", "|").alias("sample_names"))


def _by_name_length(spark, sf_dir):
    """A deliberately poor resolution, by country and name length, that the detectors must flag."""
    rows = stored(spark, sf_dir)
    anchor = rows.groupBy("country_code", F.length("name").alias("size")).agg(F.min("id").alias("anchor"))
    out = rows.withColumn("size", F.length("name")).join(anchor, ["country_code", "size"])
    return out.withColumn("master_id", F.col("anchor")).drop("anchor", "size")


@query
def splits(spark, sf_dir):
    out = qa.splits(qa.matched_rows(resolved(spark, sf_dir)), vocabulary(spark))
    return out.withColumns({"master_codes": F.array_join("master_codes", ","), "sample_names": F.array_join("sample_names", "|")})


@query
def undermerge_clusters(spark, sf_dir):
    return qa.undermerge_clusters(resolved(spark, sf_dir), vocabulary(spark)).withColumn("names", F.array_join("names", "|"))


def _pairs(spark, sf_dir):
    """Distinct (variant, master) names of the poor resolution, so that all verdicts occur."""
    rows = _by_name_length(spark, sf_dir).filter("match_type IS NOT NULL AND match_type <> 'EXCLUDED'")
    rows = rows.withColumn("match_type", F.when(F.col("id") == F.col("master_id"), "NEW_MASTER").otherwise("TOKEN_COVERAGE"))
    pairs = qa.qa_pairs(rows, vocabulary(spark))
    return pairs.select("master_name", "variant_name", "master_country", "variant_country", "core_master", "core_variant", "core_rel", "leak").distinct()


@query
def jaccard_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir).select("master_name", "variant_name", "master_country", F.round(T.token_overlap(F.col("core_master"), F.col("core_variant")), 6).alias("overlap"))


@query
def core_rel(spark, sf_dir):
    return _pairs(spark, sf_dir).select("master_name", "variant_name", "master_country", "core_rel")


@query
def verify_pairs(spark, sf_dir):
    """Distinct names of one country that share a first letter and a length, against each stage."""
    rows = names(spark, sf_dir).filter("reason IS NULL").select("name", "country_code", F.substring("fingerprint", 1, 6).alias("k"))
    first = rows.groupBy("country_code", "k").agg(F.min("name").alias("master"))
    pairs = rows.join(first, ["country_code", "k"]).filter("name <> master").select("country_code", F.col("name").alias("probe"), "master")
    return probes.verify_pairs(pairs, vocabulary(spark))


@query
def rubric_q1(spark, sf_dir):
    p = _pairs(spark, sf_dir)
    verdict = qa.rubric_basic(F.col("master_name"), F.col("variant_name"), F.col("core_master"), F.col("core_variant"), F.col("leak"))
    return p.select("master_name", "variant_name", "master_country", verdict.alias("verdict"))


@query
def rubric_q2(spark, sf_dir):
    from masterlink.functions.unicode import lcs_ratio

    p = _pairs(spark, sf_dir)
    generic = by_country(vocabulary(spark).generic(), F.col("master_country"))
    verdict = qa.rubric_tokens(F.col("core_master"), F.col("core_variant"), generic, lcs_ratio(F.lower("master_name"), F.lower("variant_name")))
    return p.select("master_name", "variant_name", "master_country", verdict.alias("verdict"))


@query
def rubric_q3(spark, sf_dir):
    p = _pairs(spark, sf_dir)
    verdict = qa.rubric_variants(F.col("master_name"), F.col("variant_name"), F.col("core_master"), F.col("core_variant"), F.col("leak"))
    return p.select("master_name", "variant_name", "master_country", verdict.alias("verdict"))


@query
def verdict_summary(spark, sf_dir):
    p = _pairs(spark, sf_dir)
    verdict = qa.rubric_basic(F.col("master_name"), F.col("variant_name"), F.col("core_master"), F.col("core_variant"), F.col("leak"))
    return qa.verdict_summary(p.select(F.col("master_country").alias("stage"), verdict.alias("verdict")))


@query
def golden_probe(spark, sf_dir):
    """Parts of the same name and country, as the truth of which firms are the same."""
    rows = stored(spark, sf_dir).filter("match_type IS NOT NULL AND match_type <> 'EXCLUDED'")
    golden = rows.select("id", F.concat_ws("/", "country_code", F.array_join(F.array_sort(qa.core_of(F.col("name"), F.col("country_code"), vocabulary(spark))), " ")).alias("group"))
    return qa.golden_probe(rows, golden)


@query
def array_set_ops(spark, sf_dir):
    n = names(spark, sf_dir)
    show = lambda c: F.array_join(F.array_sort(c), " ")
    return n.select("name", "country_code", show(F.array_union("raw", "tokens")).alias("either"), show(F.array_intersect("raw", "tokens")).alias("both"), show(F.array_except("raw", "tokens")).alias("only_raw"))


# Functions without SQL


@query
def unicode_norm(spark, sf_dir):
    from masterlink.functions.unicode import nfkc_casefold, segment, unicode_norm

    return documents(spark, sf_dir).select("doc_id", nfkc_casefold("text").alias("folded"), unicode_norm("text").alias("normal"), F.size(segment("text")).alias("words"))


@query
def phonetic_rescue(spark, sf_dir):
    from masterlink.functions.phonetic import double_metaphone, phonetic_rescue

    rows = firms(spark, sf_dir).select("name", "country_code").distinct()
    return rows.select("name", "country_code", phonetic_rescue(rows, vocabulary(spark).rows).alias("rescued"), double_metaphone("name").alias("code"))


@query
def stage_phonetic(spark, sf_dir):
    from masterlink.functions.phonetic import double_metaphone

    words = _fuzzy_names(spark, sf_dir).select("first_id", "country_code", F.explode("core").alias("word"))
    coded = words.withColumn("code", double_metaphone("word")).filter("code <> ''")
    codes = coded.groupBy("first_id", "country_code").agg(F.collect_set("code").alias("codes"))
    return retired.phonetic_match(codes.withColumnRenamed("first_id", "id"))


@query
def events_rollup(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.rollup("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users")).withColumn("event_type", F.coalesce("event_type", F.lit("TOTAL")))


@query
def events_windows(spark, sf_dir):
    from masterlink.streaming import windowed_counts

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return windowed_counts(events, "ts", "1 hour", "60 seconds", "event_type").withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm"))
