from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from masterlink.config import QaSettings
from masterlink.operators import dedup, qa, retired
from masterlink.operators.graph import connected_components

VARIATIONS = "master_id bigint, country_code string, fingerprint string, name string"


def groups(spark, rows, **more):
    return {(r["country_code"], r["fingerprint"]): (r["master_count"], r["master_ids"]) for r in dedup.duplicate_groups(spark.createDataFrame(rows, VARIATIONS), **more).collect()}


def test_duplicate_groups(spark):
    rows = [(3, "MX", "acme", "a"), (1, "MX", "acme", "b"), (2, "MX", "acme", "c"), (2, "MX", "acme", "d"), (4, "MX", "", "e"), (5, "MX", "", "f"), (6, None, "acme", "g"), (7, "US", "acme", "h"), (8, "MX", "m", "i"), (9, "MX", "m", "j"), (10, "MX", "a bc", "k"), (11, "MX", "a bc", "l")]
    assert groups(spark, rows) == {("MX", "acme"): (3, [1, 2, 3]), ("MX", "a bc"): (2, [10, 11])}
    assert ("MX", "m") in groups(spark, rows, least=1)
    assert groups(spark, rows, cap=2)["MX", "acme"] == (3, [1, 2])
    assert groups(spark, rows, countries=["US"]) == {}
    assert groups(spark, rows, masters=spark.createDataFrame([(10,)], "master_id bigint")) == {("MX", "a bc"): (2, [10, 11])}


def test_merge_plan_and_review(spark):
    found = dedup.duplicate_groups(spark.createDataFrame([(3, "MX", "acme", "a"), (1, "MX", "acme", "b"), (2, "MX", "acme", "c")], VARIATIONS))
    assert [(r["primary_id"], r["secondaries"]) for r in dedup.merge_plan(found).collect()] == [(1, [2, 3])]
    no = spark.createDataFrame([("MX", "acme", "n")], "country_code string, fingerprint string, decision string")
    assert dedup.review(found, no).count() == 0
    assert dedup.review(found, no.withColumn("decision", F.lit("Y"))).count() == 1


def test_merge_closes_over_shared_fingerprints(spark):
    variations = spark.createDataFrame([(1, "MX", "ab", "x"), (2, "MX", "ab", "x"), (2, "MX", "cd", "y"), (3, "MX", "cd", "y"), (9, "US", "cd", "z")], VARIATIONS)
    plan = dedup.merge_map(variations)
    assert {(r["master_id"], r["primary_id"]) for r in plan.collect()} == {(2, 1), (3, 1)}
    rows = spark.createDataFrame([(1, 1, "NEW_MASTER"), (3, 3, "NEW_MASTER"), (4, 3, "CANONICAL_EXACT"), (5, None, None)], "id bigint, master_id bigint, match_type string")
    out = dedup.repoint(rows, plan)
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, 1, "NEW_MASTER"), (3, 1, "AUTO_DEDUP"), (4, 1, "CANONICAL_EXACT"), (5, None, None)], key=str)
    docs = spark.createDataFrame([(1, "MX", ["a"], ["1"]), (2, "MX", ["b", "a"], []), (3, "MX", ["c"], ["2"])], "master_id bigint, country_code string, variations array<string>, phone_number array<string>")
    assert [tuple(r) for r in dedup.merge_documents(docs, plan).collect()] == [(1, "MX", ["a", "b", "c"], ["1", "2"])]
    stats = dedup.merge_stats(dedup.duplicate_groups(variations), plan, rows, out).head()
    assert stats.asDict() == {"groups": 2, "merged_masters": 2, "repointed_rows": 2}


def test_components_match_union_find(spark):
    import random

    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1060)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


MATCHED = "id bigint, master_code bigint, name string, country string, match_type string"


def test_over_merge(spark, vocabulary):
    rows = [(1, 1, "AUDI", "MX", "NEW_MASTER"), (2, 1, "KOHLER", "MX", "PHRASE_SLOP"), (3, 1, "IGSA", "MX", "PHRASE_SLOP"), (4, 4, "WITTE", "MX", "NEW_MASTER"), (5, 4, "WITTE SA", "MX", "CANONICAL_EXACT"), (6, 6, "ALONE", "MX", "NEW_MASTER")]
    found = qa.over_merge(spark.createDataFrame(rows, MATCHED), vocabulary).collect()
    assert [(r["master_code"], r["member_count"], r["mean_overlap"], r["dominant_match_type"], r["sample_names"]) for r in found] == [(1, 3, 0.0, "PHRASE_SLOP", ["AUDI", "KOHLER", "IGSA"])]
    some = qa.over_merge(spark.createDataFrame(rows, MATCHED), vocabulary, QaSettings(overlap_threshold=1.01)).collect()
    assert {r["master_code"]: r["mean_overlap"] for r in some} == {1: 0.0, 4: 1.0}


def test_splits(spark, vocabulary):
    rows = [(1, 1, "WITTE SA", "MX", "NEW_MASTER"), (2, 2, "WITTE", "MX", "NEW_MASTER"), (3, 3, "WITTE", "US", "NEW_MASTER"), (4, 2, "WITTE", "MX", "CANONICAL_EXACT")]
    found = qa.splits(spark.createDataFrame(rows, MATCHED), vocabulary).collect()
    assert [(r["country"], r["core_signature"], r["master_codes"], r["affected_rows"]) for r in found] == [("MX", "witte", [1, 2], 3)]


@pytest.mark.parametrize(("a", "b", "relation"), [(["a"], ["a"], "identical"), (["a"], ["a", "b"], "subset"), (["a", "c"], ["a", "b"], "partial_overlap"), (["a"], ["b"], "disjoint"), ([], ["b"], "disjoint")])
def test_core_relation(spark, a, b, relation):
    rows = spark.createDataFrame([(a, b)], "a array<string>, b array<string>")
    assert rows.select(qa.core_relation(F.col("a"), F.col("b")).alias("r")).head()["r"] == relation


def test_rubrics_and_summary(spark):
    rows = spark.createDataFrame(
        [("ACME SA", "acme sa", ["acme"], ["acme"], False), ("ACME", "BETA", ["acme"], ["beta"], False), ("ACME", "ACME", ["acme"], ["acme"], True), ("UNIVAR", "UNIVER", ["univar"], ["univer"], False), ("A", "B", [], ["b"], False), ("APEX ONE", "APEX TWO", ["apex", "one"], ["apex", "two"], False)],
        "a string, b string, x array<string>, y array<string>, leak boolean",
    )
    c = [F.col(n) for n in ("a", "b", "x", "y", "leak")]
    out = rows.select(qa.rubric_basic(*c).alias("q1"), qa.rubric_variants(*c).alias("q3"), qa.rubric_tokens(c[2], c[3], F.array(F.lit("sa")), F.lit(0.95)).alias("q2")).collect()
    assert [r["q1"] for r in out] == ["CORRECT", "WRONG", "WRONG", "WRONG", "WRONG", "WRONG"]
    assert [r["q3"] for r in out] == ["CORRECT", "WRONG", "WRONG", "CORRECT", "UNCERTAIN", "UNCERTAIN"]
    assert [r["q2"] for r in out] == ["CORRECT", "WRONG", "CORRECT", "WRONG", "WRONG", "CORRECT"]
    verdicts = spark.createDataFrame([("s", "CORRECT"), ("s", "CORRECT"), ("s", "WRONG"), ("s", "UNCERTAIN"), ("t", "UNCERTAIN")], "stage string, verdict string")
    summary = {r["stage"]: (r["pairs"], r["correct"], r["wrong"], r["uncertain"], r["precision"]) for r in qa.verdict_summary(verdicts).collect()}
    assert summary == {"s": (4, 2, 1, 1, pytest.approx(0.666667)), "t": (1, 0, 0, 1, None)}


def test_golden_probe(spark):
    golden = spark.createDataFrame([(1, "w"), (2, "w"), (3, "v"), (4, "a"), (5, "b")], "id bigint, group string")
    resolved = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 4), (5, 4)], "id bigint, master_id bigint")
    assert qa.golden_probe(resolved, golden).head().asDict() == {"violations": 1, "found": 2, "wanted": 2, "recall": 1.0, "precision": pytest.approx(0.666667)}


def test_retired_stages(spark):
    rows = spark.createDataFrame([(1, "MX", "AB-12"), (2, "MX", "ab12"), (3, "US", "AB12"), (4, "MX", ""), (5, "MX", None)], "id bigint, country_code string, tax_number string")
    assert [tuple(r) for r in retired.tax_exact(rows).collect()] == [(2, 1)]
    names = spark.createDataFrame([(1, "MX", ["apex", "one"]), (2, "MX", ["apex"]), (3, "MX", ["apex", "ono"]), (4, "MX", [])], "first_id bigint, country_code string, tokens array<string>")
    assert {tuple(r) for r in retired.token_subset(names).collect()} == {(2, 1)}
    assert {(r["probe_id"], r["master_id"]) for r in retired.ngram_match(names).collect()} == {(3, 1)}
    both = spark.createDataFrame([(["a", "b"], ["a"])], "a array<string>, b array<string>").select(retired.symmetric_coverage(F.col("a"), F.col("b")).alias("c"), retired.word_ratio(F.col("a"), F.col("b")).alias("w")).head()
    assert (both["c"], both["w"]) == (0.5, 0.5)
