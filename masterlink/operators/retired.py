"""Match stages that are off by default: candidates as pairs (probe_id, master_id), each within one country.

A probe is matched with earlier rows only; of several candidates the smallest id is kept, so no probe makes many rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masterlink.functions import text as T
from masterlink.plans.durable import durable


def equal_key(rows: DataFrame, key: Column) -> DataFrame:
    """Rows whose key an earlier row of the country has, with that key's first row. One shuffle, no pairs."""
    keyed = rows.select("id", "country_code", key.alias("key")).filter(F.col("key").isNotNull() & (F.col("key") != ""))
    first = keyed.groupBy("country_code", "key").agg(F.min("id").alias("master_id"))
    return keyed.join(first, ["country_code", "key"]).filter("id > master_id").select(F.col("id").alias("probe_id"), "master_id")


def tax_exact(rows: DataFrame, tax: str = "tax_number") -> DataFrame:
    """Same tax number, but for punctuation and case. Rows without one take no part."""
    return equal_key(rows, T.tax_norm(F.col(tax)))


def stripped_exact(rows: DataFrame) -> DataFrame:
    """Same core words in the same order (rows carry core: array<string>)."""
    return equal_key(rows, F.array_join("core", " "))


def strict_ordered(rows: DataFrame, least: int = 2) -> DataFrame:
    """Same core words in order, at least `least` of them."""
    return equal_key(rows.filter(F.size("core") >= least), F.array_join("core", " "))


def brand_anchor(rows: DataFrame) -> DataFrame:
    """Same first core word."""
    return equal_key(rows, F.get("core", F.lit(0)))


def phonetic_match(rows: DataFrame, codes: str = "codes", least: int = 1) -> DataFrame:
    """Same set of phonetic codes (rows carry them as an array), if there are at least `least`."""
    return equal_key(rows.filter(F.size(codes) >= least), F.array_join(F.array_sort(F.array_distinct(codes)), " "))


def token_subset(names: DataFrame) -> DataFrame:
    """(probe, master) names, by first id: all tokens of the probe's name stand in the master's. Names must be distinct.

    A probe meets masters only under its rarest token, so frequent tokens make no candidates for names that have others.
    """
    names = durable(names.select("first_id", "country_code", "tokens"))
    words = names.select("first_id", "country_code", F.explode(F.array_distinct("tokens")).alias("token"))
    counts = words.groupBy("country_code", "token").agg(F.count("*").alias("n"))
    rarest = words.join(counts, ["country_code", "token"]).groupBy("first_id", "country_code").agg(F.min_by("token", F.struct("n", "token")).alias("token"))
    probes = rarest.join(names.select("first_id", F.array_distinct("tokens").alias("tokens")), "first_id")
    theirs = words.join(names.select(F.col("first_id"), F.array_distinct("tokens").alias("theirs")), "first_id").select(F.col("first_id").alias("other"), "country_code", "token", "theirs")
    pairs = probes.join(theirs, ["country_code", "token"]).filter((F.col("other") < F.col("first_id")) & (F.size(F.array_except("tokens", "theirs")) == 0))
    return pairs.groupBy(F.col("first_id").alias("probe_id")).agg(F.min("other").alias("master_id"))


def trigrams(text: Column) -> Column:
    def cut(t: Column) -> Column:
        every = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(t) - 2), lambda i: F.substr(t, i, F.lit(3))))
        return F.when(F.length(t) >= 3, every).otherwise(F.array().cast("array<string>"))

    return T.let(text, cut)


def ngram_match(names: DataFrame, share: float = 0.5) -> DataFrame:
    """(probe_id, master_id, overlap): names, by first id, whose trigram sets have at least that Jaccard similarity.

    By the prefix principle a pair shares one of each set's rarest trigrams, so only those make candidates.
    """
    grams = durable(names.select("first_id", "country_code", trigrams(F.array_join("tokens", " ")).alias("grams")).filter(F.size("grams") > 0))
    counts = grams.select("country_code", F.explode("grams").alias("g")).groupBy("country_code", "g").agg(F.count("*").alias("n"))
    listed = grams.select("first_id", "country_code", F.explode("grams").alias("g")).join(counts, ["country_code", "g"])
    ordered = durable(listed.groupBy("first_id", "country_code").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "g"))), lambda x: x["g"]).alias("grams")))
    prefix = F.slice("grams", 1, (F.size("grams") - F.ceil(F.size("grams") * share) + 1).cast("int"))
    index = ordered.select("first_id", "country_code", F.explode(prefix).alias("g"), F.size("grams").alias("n"))
    a, b = index.select(F.col("first_id").alias("probe_id"), "country_code", "g", F.col("n").alias("m")), index.withColumnRenamed("first_id", "master_id")
    # Sizes that rule the similarity out never meet; a pair that meets under several trigrams is compared once.
    fits = (F.col("master_id") < F.col("probe_id")) & (F.col("m") >= share * F.col("n")) & (F.col("n") >= share * F.col("m"))
    pairs = a.join(b, ["country_code", "g"]).filter(fits).select("probe_id", "master_id").distinct()
    sets = lambda who, c: ordered.select(F.col("first_id").alias(who), F.col("grams").alias(c))
    scored = pairs.join(sets("probe_id", "x"), "probe_id").join(sets("master_id", "y"), "master_id").withColumn("common", F.size(F.array_intersect("x", "y")))
    scored = scored.withColumn("overlap", F.round(F.col("common") / (F.size("x") + F.size("y") - F.col("common")), 6))
    return scored.filter(F.col("overlap") >= share).select("probe_id", "master_id", "overlap")


def suffix_fuzzy(names: DataFrame) -> DataFrame:
    """(probe_id, master_id): same core, and the rest of the words equal but for few edits: none up to three letters, one
    up to six, two beyond. Names carry core_key and suffix (both strings)."""
    rows = names.select("first_id", "country_code", "core_key", "suffix").filter("core_key <> '' AND suffix <> ''")
    # Suffixes are made of legal words: a core has few different ones, however many names have them.
    kinds = rows.groupBy("country_code", "core_key", "suffix").agg(F.min("first_id").alias("least"))
    a, b = kinds.select("country_code", "core_key", F.col("suffix").alias("x")), kinds.select("country_code", "core_key", F.col("suffix").alias("y"), "least")
    room = F.when(F.length("x") <= 3, 0).when(F.length("x") <= 6, 1).otherwise(2)
    near = a.join(b, ["country_code", "core_key"]).filter(F.levenshtein("x", "y") <= room)
    best = near.groupBy("country_code", "core_key", F.col("x").alias("suffix")).agg(F.min("least").alias("master_id"))
    return rows.join(best, ["country_code", "core_key", "suffix"]).filter("master_id < first_id").select(F.col("first_id").alias("probe_id"), "master_id")


def symmetric_coverage(a: Column, b: Column) -> Column:
    """Share of either side's words that the other has, the smaller one."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(shared / F.greatest(F.size(F.array_distinct(a)), F.size(F.array_distinct(b))))


def word_ratio(a: Column, b: Column) -> Column:
    """The shorter list's length over the longer one's."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.least(F.size(a), F.size(b)) / F.greatest(F.size(a), F.size(b)))
