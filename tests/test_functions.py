from __future__ import annotations

import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from masterlink.functions import phonetic as P
from masterlink.functions import unicode as U

BRANDS = "velanto korvanis plumera ostrix dantelle morvique sabreno tilvana quorine brastel lumexa harvoni".split()


@pytest.mark.parametrize(("word", "code"), [("infra", "ANFR"), ("univar", "ANFR"), ("smith", "SM0"), ("schmidt", "XMT"), ("knight", "NT"), ("thumb", "0M"), ("phone", "FN"), ("michael", "MKL"), ("school", "SKL"), ("laugh", "LF"), ("through", "0R"), ("", ""), ("ñ", "")])
def test_primary_code(word, code):
    assert P.primary_code(word) == code


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=30))
def test_primary_code_takes_any_text(text):
    code = P.primary_code(text)
    assert set(code) <= set("0AFHJKLMNPRSTX")


@pytest.mark.parametrize("brand", BRANDS)
def test_rescue_leaves_brands(vocabulary, brand):
    sources = P.phonetic_sources(vocabulary.rows)["MX"]
    assert P.rescue_word(brand, sources, guarded=True) == brand


def test_rescue_mends_rule_words(spark, vocabulary):
    rows = spark.createDataFrame([("ACME TECNOLOGYES", "MX"), ("ACME LOGISTIKS", "MX"), ("12345 abc", "MX"), (None, "MX"), ("logistikz", "ZZ")], "name string, country_code string")
    out = [r["x"] for r in rows.select(P.phonetic_rescue(rows, vocabulary.rows).alias("x")).collect()]
    assert out[0] in ("ACME technologies", "ACME TECNOLOGYES")
    assert out[1:] == ["ACME logistics", "12345 abc", None, "logistikz"]


def test_unguarded_rescue_rewrites_brands(vocabulary):
    sources = P.phonetic_sources(vocabulary.rows)["MX"]
    assert P.rescue_word("univar", sources, guarded=False) == "construction & real estate"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            row[j], last = (last + 1 if x == y else max(row[j], row[j - 1])), row[j]
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abcé", max_size=20), st.text("abcé", max_size=20))
def test_lcs_length(a, b):
    assert U.lcs_length(a, b) == lcs(a, b)


def test_unicode_udfs(spark):
    rows = spark.createDataFrame([("ＡＢＣ ﬁ ß",), ("Çağ—Œ_x",), (None,), ("三菱 Motors ﾃｽﾄ",), ("",)], "t string")
    out = rows.select(U.nfkc_casefold("t").alias("a"), U.unicode_norm("t").alias("b"), U.segment("t").alias("c")).collect()
    assert out[0]["a"] == "abc fi ss"
    assert out[1]["b"] == "cag œ x"
    assert out[2].asDict() == {"a": None, "b": None, "c": None}
    assert out[3]["c"] == ["三", "菱", "Motors", "ﾃｽﾄ"]
    assert out[4]["c"] == [] and out[4]["b"] == ""
    assert unicodedata.is_normalized("NFKC", out[0]["a"])


def test_lcs_ratio(spark):
    rows = spark.createDataFrame([("abcd", "abxd"), ("", ""), (None, "a"), ("a", "")], "a string, b string")
    assert [r["x"] for r in rows.select(U.lcs_ratio("a", "b").alias("x")).collect()] == [0.75, 1.0, None, 0.0]


def test_double_metaphone_column(spark):
    rows = spark.createDataFrame([("Infra",), (None,)], "w string")
    assert [r["c"] for r in rows.select(P.double_metaphone(F.col("w")).alias("c")).collect()] == ["ANFR", None]
