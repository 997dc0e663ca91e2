from __future__ import annotations

import json

from masterlink.plans.oracle import RULES, VOCABULARY
from masterlink.sources.rules import Vocabulary, claimed_rules, export_rules, parse_rules, rule_collisions, rule_files


def test_claims_agree_with_plain_python(spark, vocabulary):
    rows = claimed_rules(parse_rules(rule_files(spark)), vocabulary.countries).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(RULES, key=repr)
    assert vocabulary.rows == VOCABULARY.rows and vocabulary.countries == VOCABULARY.countries


def test_country_beats_common_and_one_source_has_one_target(vocabulary):
    targets = {}
    for country, category, source, target in vocabulary.rows:
        if category in ("legal_suffixes", "business_sectors"):
            assert (country, source) not in targets
            targets[country, source] = target
    assert targets["TR", "limited"] == "ltdsti" and targets["MX", "limited"] == "ltd"
    assert targets["US", "inc"] == "inc"


def test_external_folder(spark, tmp_path):
    (tmp_path / "common.json").write_text(json.dumps({"legal_suffixes": ["inc,corp=>inc."], "articles": ["the"]}))
    (tmp_path / "xx.json").write_text(json.dumps({"company_types": ["corp=>corporation", "zed,zeta"], "address_terms": ["str=>street"]}))
    (tmp_path / "_note.json").write_text("{}")
    voc = Vocabulary.load(spark, str(tmp_path))
    assert voc.countries == ["XX"]
    rules = {(c, s): t for _, c, s, t in voc.rows}
    assert rules["legal_suffixes", "corp"] == "corporation" and rules["legal_suffixes", "inc"] == "inc."
    assert rules["legal_suffixes", "zeta"] == "zed"
    assert "str" in voc.tokens("address_abbreviations")["XX"]
    out = tmp_path / "out"
    out.mkdir()
    export_rules(voc, str(out))
    assert "legal_suffixes" in json.loads((out / "xx.json").read_text())


def test_collisions(spark, tmp_path):
    (tmp_path / "aa.json").write_text(json.dumps({"legal_suffixes": ["inc=>corp", "inc=>inc."]}))
    rows = rule_collisions(parse_rules(rule_files(spark, str(tmp_path))), ["AA"]).collect()
    assert [(r["country"], r["source"], r["targets"]) for r in rows] == [("AA", "inc", ["corp", "inc."])]


def test_geo_and_generic_sets(vocabulary):
    assert vocabulary.geo()["MX"] == ["mexicana", "mexico"] or set(vocabulary.geo()["MX"]) == {"mexico", "mexicana"}
    generic = vocabulary.generic()["MX"]
    assert {"trading", "sadecv", "de", "mexico", "real", "estate"} <= set(generic) and "audi" not in generic
