from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from masterlink.functions import text as T
from masterlink.operators.analyse import analyse
from masterlink.operators.qa import core_of


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).head()["y"]


@pytest.mark.parametrize(
    ("name", "cleaned"),
    [
        ("RICARD RICARD ARGENTINA", "ricard argentina"),
        ("  Email: ACME  &  Sons, Ltd. ", "acme and sons ltd."),
        ("ACME c/o BETA to the order of X", "acme beta x"),
        ("COMPAÑIA X", "compañia x"),
        ("a​b­c", "abc"),
        ("", ""),
        ("a              b", "a b"),
    ],
)
def test_light_clean(spark, name, cleaned):
    assert one(spark, name, T.light_clean) == cleaned


def test_light_clean_as_written_keeps_ascii_only(spark):
    assert one(spark, "COMPAÑIA X", lambda c: T.light_clean(c, unicode=False)) == "compa ia x"


def test_clean_variations_drops_empty_ones_and_repeats(spark):
    row = spark.createDataFrame([(["ACME", "acme", "", "!!", "Beta"],)], "x array<string>").select(T.clean_variations(F.col("x")).alias("y")).head()
    assert row["y"] == ["acme", "beta"]


@pytest.mark.parametrize(("name", "tokens"), [("K.W.M", ["kwm"]), ("C.M.S.A.D.C", ["cmsadc"]), ("A.Ş. ÖZ", ["as", "oz"]), ("O'Neil-Straße 3M", ["o'neil", "strasse", "3m"]), ("أحمد", ["احمد"]), ("", [])])
def test_tokenize(spark, name, tokens):
    assert one(spark, name, T.tokenize) == tokens


@pytest.mark.parametrize(
    ("name", "country", "reason"),
    [
        (None, "US", "empty"),
        ("\t \n", "MX", "empty"),
        ("?!", "US", "no_alnum"),
        ("--- ***", "TR", "no_alnum"),
        ("To the Order", "TR", "placeholder"),
        ("Not. Available!", "US", "placeholder"),
        ("unknown", "MX", "placeholder"),
        ("UNKNOWN HARBOUR WORKS", "MX", None),
        ("NaN", "TR", "na_marker"),
        ("Nil", "MX", "na_marker"),
        ("none.", "US", "na_marker"),
        ("nonesuch", "US", None),
        ("razon social no determinada", "TR", None),
        ("77", "TR", None),
        ("Q7-19/B", "MX", None),
        ("Лесопилка", "US", None),
        ("木工所", "US", None),
        ("Harbour Works", "QX", "invalid_country"),
        ("Harbour Works", "us", "invalid_country"),
        ("Harbour Works", None, "invalid_country"),
    ],
)
def test_input_classes(spark, vocabulary, name, country, reason):
    rows = spark.createDataFrame([(name, country)], "name string, country_code string")
    assert analyse(rows, vocabulary).head()["reason"] == reason


@pytest.mark.parametrize(
    ("name", "country", "geo", "core"),
    [
        ("Harbour Works, Inc.", "US", False, ["harbour", "works"]),
        ("9 LANTERN 88 LTD", "US", False, ["lantern"]),
        ("x-lantern", "TR", False, ["lantern"]),
        ("LANTERN DE MEXICO", "MX", False, ["lantern", "mexico"]),
        ("LANTERN DE MEXICO", "MX", True, ["lantern"]),
        ("Turk Lantern AS", "TR", True, ["lantern"]),
        ("Turk Lantern AS", "US", True, ["turk", "lantern", "as"]),
        ("  ", "US", False, []),
    ],
)
def test_normalize_core(spark, vocabulary, name, country, geo, core):
    rows = spark.createDataFrame([(name, country)], "n string, c string")
    assert rows.select(core_of(F.col("n"), F.col("c"), vocabulary, geo).alias("x")).head()["x"] == core


@pytest.mark.parametrize(("name", "fingerprint"), [("C.M.S.A.D.C", "cmsadc"), ("B.A.T", "bat"), ("S.A.P.I.", ""), ("M S.A.", "m"), ("S. S. DE R.L. DE C.V.", ""), ("ELEKTROKONTAKT SRL DE C.V.", "elektrokontakt"), ("VF OUTDOOR MEXICO S.A.", "mexico outdoor vf")])
def test_fingerprint(spark, vocabulary, name, fingerprint):
    rows = spark.createDataFrame([(name, "MX")], "name string, country_code string")
    assert analyse(rows, vocabulary).head()["fingerprint"] == fingerprint


@pytest.mark.parametrize(
    ("name", "country", "core", "alpha", "dirty"),
    [
        ("M", "MX", False, False, False),
        ("SIEMENS", "MX", True, True, False),
        ("3M", "MX", True, True, False),
        ("300", "MX", True, False, False),
        ("TRADING", "MX", False, False, False),
        ("INVERSIONES GROUP", "MX", False, False, False),
        ("INFRA", "MX", False, False, False),
        ("APEX TRADING", "MX", True, True, False),
        ("STREET NO", "US", True, True, True),
        ("APEX STREET", "US", True, True, False),
    ],
)
def test_gates(spark, vocabulary, name, country, core, alpha, dirty):
    rows = spark.createDataFrame([(name, country)], "name string, country_code string")
    found = analyse(rows, vocabulary).head()
    assert (found["core"], found["alpha_core"], found["dirty"]) == (core, alpha, dirty)


def test_canonicalise_takes_the_longest_source_first(spark):
    table = F.create_map(*(F.lit(x) for x in ("a b", "ab", "a", "x y", "a b c", "abc")))
    f = lambda c: F.array_join(T.canonicalise(F.split(c, " "), table, 3), " ")
    assert one(spark, "a b c a b a z", f) == "abc ab x y z"


@pytest.mark.parametrize(("a", "b", "distance"), [("kontes mexico", "kontes _ mexico", 1), ("a b c", "a _ b _ c", 2), ("a b", "b a", None), ("a b", "a b", 0), ("a b", "a b c", None)])
def test_slop_distance(spark, a, b, distance):
    assert spark.createDataFrame([(a, b)], "a string, b string").select(T.slop_distance(F.col("a"), F.col("b")).alias("d")).head()["d"] == distance


def test_holes_keeps_inner_articles_only(spark):
    f = lambda c: T.holes(F.split(c, " "), F.array(F.lit("de"), F.lit("la")))
    assert one(spark, "de kohler de la mexico la", f) == "kohler _ _ mexico"
    assert one(spark, "de la", f) == ""


def test_overlap_typo_spelling_and_abbreviation(spark):
    rows = spark.createDataFrame([(["audi", "mexico"], ["kohler", "mexico"], "univar", "univer", "A AND B, S.A.", "A & B SA", "INTL PAPER", "INTL PAP")], "a array<string>, b array<string>, c string, d string, e string, f string, g string, h string")
    row = rows.select(T.token_overlap(F.col("a"), F.col("b")).alias("o"), T.token_overlap(F.array().cast("array<string>"), F.col("b")).alias("z"), T.typo_pair(F.col("c"), F.col("d")).alias("t"), (T.spelling_key(F.col("e")) == T.spelling_key(F.col("f"))).alias("s"), T.abbreviation_pair(F.col("g"), F.col("h")).alias("p")).head()
    assert row["o"] == pytest.approx(1 / 3)
    assert (row["z"], row["t"], row["s"], row["p"]) == (0.0, True, True, True)


def test_canonical_full_is_null_when_too_long(spark):
    f = lambda c: T.canonical_full(F.split(c, " "))
    assert one(spark, " ".join(f"w{i}" for i in range(100)), f) is None
    assert one(spark, "b a b", f) == "a b"
