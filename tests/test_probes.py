from __future__ import annotations

from pyspark.sql import functions as F

from masterlink.operators import probes
from masterlink.operators import resolve as R

SCHEMA = "id bigint, name string, country_code string"


def test_verify_pairs(spark, vocabulary):
    pairs = spark.createDataFrame([("MX", "KONTES DE MEXICO", "KONTES MEXICO"), ("MX", "WITTE SA DE CV", "WITTE, S.A. DE C.V."), ("MX", "APOTEX", "APOTEX PHARMA"), ("MX", "B A", "A B")], "country_code string, probe string, master string")
    out = {r["probe"]: (r["canonical_exact"], r["phrase_slop"], r["token_coverage"]) for r in probes.verify_pairs(pairs, vocabulary).collect()}
    assert out == {"KONTES DE MEXICO": (False, True, True), "WITTE SA DE CV": (True, True, True), "APOTEX": (False, False, False), "B A": (False, False, True)}


def test_waterfall_of_no_rows(spark, vocabulary):
    empty = R.resolve_batch(spark.createDataFrame([], SCHEMA), vocabulary)
    assert [(r["stage_order"], r["asked"]) for r in probes.stage_waterfall(empty).collect()] == [(1, 0), (2, 0), (3, 0)]


def test_post_verified(spark):
    rows = spark.createDataFrame([(["a", "b"], ["a", "b"]), (["a", "b"], ["a", "c"]), (["a", "b", "c"], ["a"]), ([], ["a"])], "a array<string>, b array<string>")
    a, b = F.col("a"), F.col("b")
    out = rows.select(probes.post_verified(a, b, True).alias("s"), F.coalesce(probes.post_verified(a, b, False), F.lit(False)).alias("l")).collect()
    assert [(r["s"], r["l"]) for r in out] == [(True, True), (False, True), (False, False), (False, False)]


def test_exact_names_and_boosts(spark):
    rows = spark.createDataFrame([(1, " Acme", "MX", "1", "acme"), (2, "ACME ", "MX", "1", "acme"), (3, "acme", "US", "1", "acme"), (4, " ", "MX", "2", ""), (5, "beta", "MX", "2", "acme")], "id bigint, name string, country_code string, phone string, key string")
    assert {(r["country_code"], r["key"], r["master_id"], r["rows"]) for r in probes.exact_name_masters(rows).collect()} == {("MX", "acme", 1, 2), ("US", "acme", 3, 1), ("MX", "beta", 5, 1)}
    hits = probes.boosted_probe(rows, [F.col("key"), F.lower(F.trim("name"))])
    assert {tuple(r) for r in hits.collect()} == {(2, 1, 7.0), (5, 1, 1.0)}


def test_legacy_update_truncates(spark, vocabulary):
    out = probes.legacy_update(R.resolve_batch(spark.createDataFrame([(1, "ACME", "MX"), (2, " ", "MX")], SCHEMA), vocabulary))
    assert [tuple(r) for r in out.collect()] == [(1, "1", 100)]


def test_merge_by_touched_masters_only(spark):
    from masterlink.operators import dedup

    rows = spark.createDataFrame([(1, "MX", "aa", "x"), (2, "MX", "aa", "x"), (3, "MX", "bb", "x"), (4, "MX", "bb", "x")], "master_id bigint, country_code string, fingerprint string, name string")
    touched = spark.createDataFrame([(4,), (9,)], "master_id bigint")
    assert [r["fingerprint"] for r in dedup.duplicate_groups(rows, masters=touched).collect()] == ["bb"]
