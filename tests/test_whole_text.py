"""Queries over documents read every line of every text, by brute force in Python."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from masterlink.functions.text import CARE_OF, LABEL, ZERO_WIDTH
from masterlink.plans.queries import QUERIES

TEXTS = ["Acme & Sons\nSecond  line, line\nthird: THIRD!", "email: a\n\nc/o B b\r\nlast", "one line", "\n\nafter blank", "", None]


def written(spark, path, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows.write.parquet(f"{path}/documents.parquet")
    return str(path)


def cleaned(text):
    t = re.sub(ZERO_WIDTH, "", re.sub(r"[ \t\n\x0b\f\r]+", " ", text).strip(" ").lower())
    for pattern in (LABEL, *CARE_OF):
        t = re.sub(pattern, "", t, flags=re.A)
    t = re.sub(r"[^\w\s.\-]", " ", re.sub(r"\s*&\s*", " and ", t, flags=re.A), flags=re.A)
    words = t.split()
    return " ".join(w for k, w in enumerate(words) if k == 0 or w != words[k - 1])


def test_light_clean_documents_reads_all_lines(spark, tmp_path):
    found = {r["doc_id"]: r["cleaned"] for r in QUERIES["light_clean_documents"](spark, written(spark, tmp_path, TEXTS)).collect()}
    assert found == {k: t if t is None else cleaned(t) for k, t in enumerate(TEXTS)}
    assert found[0] == "acme and sons second line third"


def test_light_clean_documents_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").filter(F.col("text").isNotNull()).collect()}
    found = {r["doc_id"]: r["cleaned"] for r in QUERIES["light_clean_documents"](spark, sf).collect()}
    assert {k: found[k] for k in texts} == {k: cleaned(t) for k, t in texts.items()}


def test_unicode_norm_reads_all_lines(spark, tmp_path):
    texts = ["Ａcme ﬁrm\nStraße É\n東京 x", "one", "\n\nafter blank", "", None]
    found = {r["doc_id"]: (r["folded"], r["normal"], r["words"]) for r in QUERIES["unicode_norm"](spark, written(spark, tmp_path, texts)).collect()}
    assert found[0] == ("acme firm\nstrasse é\n東京 x", "acme firm straße e 東京 x", 7)
    assert found[2] == ("\n\nafter blank", "after blank", 2)
    assert found[3] == ("", "", 0)
