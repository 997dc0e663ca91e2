"""Analysis of names: tokens, keys, gates. Names repeat, so each distinct (name, country) is analysed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masterlink.config import INTENDED, Profile
from masterlink.functions import text as T
from masterlink.sources.rules import Vocabulary, by_country, map_by_country

LETTER = r"\p{L}"


def has_core(tokens: Column, generic: Column, least: int, alphabetic: bool) -> Column:
    """Whether a token of at least `least` characters, if asked with a letter, is not generic."""
    return F.exists(tokens, lambda t: (F.length(t) >= least) & (t.rlike(LETTER) if alphabetic else F.lit(True)) & ~F.array_contains(generic, t))


def address_dirty(tokens: Column, address: Column, generic: Column, least: int) -> Column:
    """Whether there is an address word and nothing that could be a firm's."""
    distinctive = F.exists(tokens, lambda t: (F.length(t) >= least) & t.rlike(LETTER) & ~F.array_contains(address, t) & ~F.array_contains(generic, t))
    return F.exists(tokens, lambda t: F.array_contains(address, t)) & ~distinctive


def indexable(country: Column, countries: list[str]) -> Column:
    return F.coalesce(country.rlike("^[A-Z]{2}$") & country.isin(countries), F.lit(False))


def exclusion_reason(name: Column, country: Column, vocabulary: Vocabulary) -> Column:
    """invalid_country or what classify_input says; null for rows that take part. Blank names are `empty`."""
    placeholders = by_country({c: [" ".join(s.split()) for s in v] for c, v in vocabulary.sources("non_firm_placeholders").items()}, country)
    return F.when(T.blank(name), "empty").when(~indexable(country, vocabulary.countries), "invalid_country").otherwise(T.classify_input(name, placeholders))


def with_tokens(names: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Adds raw (folded tokens), clean (rewritten tokens, articles in) and tokens (articles out)."""
    cc = F.col("country_code")
    rewrites = vocabulary.canonical()
    longest = max((len(s.split()) for m in rewrites.values() for s in m), default=1)
    names = names.withColumn("raw", T.tokenize(F.col("name")))
    names = names.withColumn("clean", T.canonicalise(F.col("raw"), map_by_country(rewrites, cc), longest))
    return names.withColumn("tokens", T.drop_words(F.col("clean"), by_country(vocabulary.sources("articles", "one"), cc)))


def with_keys(names: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Adds token_count, class_key, gap_signature, canonical_full and fingerprint."""
    cc = F.col("country_code")
    articles = by_country(vocabulary.sources("articles", "one"), cc)
    core = T.drop_words(T.drop_words(F.col("raw"), by_country(vocabulary.fragments(), cc)), articles)
    return names.withColumns({
        "token_count": F.size("tokens").cast("long"),
        "class_key": F.array_join(F.array_sort("tokens"), " "),
        "gap_signature": T.holes(F.col("clean"), articles),
        "canonical_full": T.canonical_full(F.col("tokens")),
        "fingerprint": T.sorted_set(core),
    })


def with_gates(names: DataFrame, vocabulary: Vocabulary, profile: Profile = INTENDED) -> DataFrame:
    """Adds core (a distinctive token), alpha_core (an alphabetic one), lettered (fingerprint) and dirty."""
    cc, least = F.col("country_code"), profile.min_core_token
    generic = by_country(vocabulary.generic(), cc)
    address = by_country(vocabulary.tokens("address_abbreviations"), cc)
    on = F.lit(profile.core_gate)
    return names.withColumns({
        "core": ~on | has_core(F.col("tokens"), generic, least, False),
        "alpha_core": ~on | has_core(F.col("tokens"), generic, least, True),
        "lettered": F.col("fingerprint").rlike(LETTER),
        "dirty": F.lit(profile.dirty_data) & address_dirty(F.col("tokens"), address, generic, least),
    })


def analyse(names: DataFrame, vocabulary: Vocabulary, profile: Profile = INTENDED) -> DataFrame:
    """All analysis columns for rows with name and country_code, plus reason."""
    reason = exclusion_reason(F.col("name"), F.col("country_code"), vocabulary) if profile.input_filter else F.lit(None).cast("string")
    return with_gates(with_keys(with_tokens(names, vocabulary), vocabulary), vocabulary, profile).withColumn("reason", reason)
