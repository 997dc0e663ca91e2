"""Folding, thresholds, legacy labels, stores, config files, merges and streams."""

from __future__ import annotations

import ast
import unicodedata
import warnings

import pytest
from pyspark.sql import functions as F

from masterlink.config import INTENDED, ColumnMapping, Profile, Stage
from masterlink.functions import phonetic
from masterlink.functions import text as T
from masterlink.operators import dedup, probes
from masterlink.operators.resolve import analysed_names, master_documents, resolve_batch
from masterlink.sources import firms, logs
from masterlink.streaming import pivot_stream, read_pivot, read_store, resolve_stream, split_bad_rows


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame(list(enumerate(values)), f"k int, x {kind}")
    return [r["y"] for r in rows.select("k", f(F.col("x")).alias("y")).orderBy("k").collect()]


def test_folding_meets_plain_forms_of_all_latin_letters(spark):
    letters = [chr(c) for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)) if chr(c).isalpha()]
    base = ["".join(x for x in unicodedata.normalize("NFKD", c.lower()) if not unicodedata.combining(x)) for c in letters]
    got = column(spark, letters, T.fold)
    plain = [(c, b, g) for c, b, g in zip(letters, base, got, strict=True) if len(b) == 1 and b.isascii()]
    assert len(plain) > 400 and [(c, b) for c, b, _ in plain] == [(c, g) for c, _, g in plain]
    assert column(spark, ["Șoseaua Țării", "ĄŽUOLAS Ų", "Ķekava Ģimene", "Nguyễn Đức", "Øre Ł"], T.fold) == ["soseaua tarii", "azuolas u", "kekava gimene", "nguyen duc", "ore l"]


def test_ideographs_are_words_one_by_one(spark):
    assert column(spark, ["三菱 Corp", "トヨタ", "ひかり7"], T.tokenize) == [["三", "菱", "corp"], ["トヨタ"], ["ひ", "か", "り", "7"]]


def test_nil_names_no_firm(spark, vocabulary):
    assert column(spark, ["nil", "N.I.L", "Nilo"], lambda c: T.classify_input(c, F.array().cast("array<string>"))) == ["na_marker", None, None]


def test_a_stage_needs_its_least_score(spark, vocabulary):
    rows = spark.createDataFrame([(1, "Zorvex Metals", "MX"), (2, "Zorvex Metals", "MX")], "id bigint, name string, country_code string")
    kinds = lambda p: [(r["match_type"], r["match_score"]) for r in resolve_batch(rows, vocabulary, p).orderBy("id").collect()]
    strict = Profile(stages=(Stage("CANONICAL_EXACT", 1, 40.0, 50.0), Stage("PHRASE_SLOP", 2, 45.0, 45.0), Stage("TOKEN_COVERAGE", 3, 90.0, 95.0)))
    assert kinds(INTENDED)[1] == ("CANONICAL_EXACT", 100.0)
    assert kinds(strict)[1] == ("PHRASE_SLOP", 45.0)
    none = Profile(stages=tuple(Stage(s.name, s.order, 1.0, 2.0) for s in strict.stages))
    assert kinds(none)[1][0] == "NEW_MASTER"


def test_misspelt_address_words_are_rescued(spark):
    rules = [("MX", "address_abbreviations", "avenida", "avenue"), ("MX", "articles", "avenyda", None)]
    rows = spark.createDataFrame([("Zorvex avenidda 5", "MX")], "name string, country_code string")
    assert rows.select(phonetic.phonetic_rescue(rows, rules).alias("x")).head()["x"] == "Zorvex avenue 5"


def test_old_labels_and_suffix_typos(spark):
    assert column(spark, ["EXACT_FUZZY", "ADDRESS_CLEAN_MATCH", "SUBSET_MATCH", "NEW_MASTER", None], probes.present_types) == ["CANONICAL_EXACT", "CANONICAL_EXACT", "TOKEN_COVERAGE", "NEW_MASTER", None]
    mend = lambda c: F.array_join(T.mend_suffixes(F.split(c, " "), {"lmited": "limited", "lrd": "ltd"}), " ")
    assert column(spark, ["zorvex lmited", "zorvex lttd", "zorvex ltd", "puzzle lrd"], mend) == ["zorvex limited", "zorvex ltd", "zorvex ltd", "puzzle ltd"]


@pytest.mark.parametrize("source", ["", "A = 1\n", "A = 1\nCOLUMN_MAPPING = {\n    'id': 'x',  # }\n}\nB = 2\n", "COLUMN_MAPPING: dict = {'id': '}'}\n# end"])
def test_a_config_file_gets_the_mapping(source):
    out = firms.rewrite_mapping(source, firms.derive_mapping(["row_id", "firm_name", "country", "vat"]))
    values = {}
    exec(compile(ast.parse(out), "config", "exec"), values)
    assert values["COLUMN_MAPPING"] == {"id": "row_id", "company_name": "firm_name", "country_code": "country", "tax_number": "vat"}
    assert ("B = 2" in out) == ("B = 2" in source) and ("# end" in out) == ("# end" in source) and firms.rewrite_mapping(out, firms.derive_mapping(["row_id", "firm_name", "country", "vat"])) == out


def test_reset_of_results(spark):
    table = spark.createDataFrame([(1, "a", "MX", "m", 5.0), (2, "b", "US", "m", 5.0)], "id bigint, company_name string, country_code string, master_code string, match_score double")
    some = firms.reset_results(table, ColumnMapping(), ["MX"]).orderBy("id").collect()
    assert [(r["master_code"], r["match_score"], r["match_type"]) for r in some] == [(None, None, None), ("m", 5.0, None)]
    assert firms.reset_results(table, ColumnMapping()).filter("master_code IS NOT NULL").count() == 0


def test_stores_are_rebuilt_where_asked(spark, tmp_path):
    path, kind = str(tmp_path / "store"), "master_id bigint, country_code string"
    both = lambda n: spark.createDataFrame([(n, "MX"), (n, "US"), (n, "TR")], kind)
    held = lambda: {r["country_code"]: r["master_id"] for r in spark.read.parquet(path).collect()}
    assert logs.write_store(both(1), path, ["mx"], known=["MX", "US"], force=False) == []
    with pytest.warns(UserWarning, match="QQ"):
        assert logs.write_store(both(2), path, ["MX", "us", "QQ"], known=["MX", "US"], force=False) == ["MX", "QQ"]
    assert held() == {"MX": 1, "US": 2}
    logs.write_store(both(3), path, ["MX"], known=["MX", "US"], force=True)
    assert held() == {"MX": 3, "US": 2}


def test_a_run_stops_where_acronyms_are_read_otherwise(spark, monkeypatch):
    assert logs.glue_works(spark) is True and logs.check_glue(spark) is None
    assert logs.glue_works(spark, "K W M") is False
    monkeypatch.setattr(logs, "glue_works", lambda spark: False)
    with pytest.raises(RuntimeError):
        logs.check_glue(spark)
    monkeypatch.setattr(logs, "glue_works", lambda spark: None)
    with pytest.warns(UserWarning):
        logs.check_glue(spark)


VARIATIONS = "master_id bigint, country_code string, fingerprint string, name string"


def test_potential_duplicates_come_in_order(spark):
    rows = [(m, "MX", f"fp{g}", f"n{m}") for g, n in enumerate((2, 5, 3, 1)) for m in range(10 * g, 10 * g + n)]
    df = spark.createDataFrame(rows, VARIATIONS)
    assert [(r["fingerprint"], r["master_count"]) for r in dedup.potential_duplicates(df).collect()] == [("fp1", 5), ("fp2", 3), ("fp0", 2)]
    top = dedup.potential_duplicates(df, ids=2, samples=1, min_count=3, size=1).collect()
    assert [(r["master_ids"], r["sample_names"], r["master_count"]) for r in top] == [([10, 11], ["n10"], 5)]
    assert dedup.potential_duplicates(df, country="US").count() == 0


def test_merge_runs(spark, vocabulary):
    names = [(1, "Zorvex Metals SA"), (2, "Metals Zorvex Ltd"), (3, "Quandor"), (4, "Quandor Inc"), (5, "Quandor Ltd"), (6, "Zorvex Metals SA"), (7, "Lonely")]
    rows = spark.createDataFrame([(i, n, "MX") for i, n in names], "id bigint, name string, country_code string")
    resolved = resolve_batch(rows, vocabulary).cache()
    found = dedup.master_fingerprints(resolved, analysed_names(rows, vocabulary)).cache()
    documents = master_documents(resolved).cache()
    dry = dedup.auto_merge(resolved, documents, found, dry_run=True)
    assert dry.counters["groups"] == 2 and dry.counters["repointed_rows"] == 0 and dry.resolved is resolved
    run = dedup.auto_merge(resolved, documents, found)
    assert run.counters["errors"] == run.counters["skipped"] == 0 and run.counters["merged_masters"] == dry.counters["merged_masters"] > 0
    assert {r["master_id"] for r in run.resolved.collect()} == {1, 3, 7} and {r["master_id"] for r in run.documents.collect()} == {1, 3, 7}
    one = dedup.auto_merge(resolved, documents, found, limit=1)
    assert (one.counters["groups"], one.counters["skipped"]) == (1, 1)
    lost = dedup.auto_merge(resolved, documents.filter("master_id <> 4"), found)
    assert lost.counters["errors"] == 1 and lost.counters["groups"] == 1 and [r["missing"] for r in lost.failed.collect()] == [[4]]
    assert {r["master_id"] for r in lost.resolved.filter("id IN (3, 4, 5)").collect()} == {r["master_id"] for r in resolved.filter("id IN (3, 4, 5)").collect()}
    touched = spark.createDataFrame([(3,)], "master_id bigint")
    assert dedup.auto_merge(resolved, documents, found, masters=touched).counters["groups"] == 1
    assert dedup.auto_merge(resolved, documents, found, countries=["US"]).counters["groups"] == 0


def write_batches(spark, path, batches, kind):
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(f"{path}/{k}")
    return spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def test_pivot_of_a_stream(spark, tmp_path):
    batches = [[(1, "MX", "acme", "a"), (2, "MX", "acme", "b"), (1, "MX", "solo", "s"), (9, "MX", "", "x")], [(3, "MX", "acme", "c"), (2, "MX", "solo", "t")], [(4, "US", "acme", "d")]]
    stream = write_batches(spark, tmp_path / "in", batches, VARIATIONS)
    pivot_stream(stream, str(tmp_path / "store"), str(tmp_path / "check"), ids=2, samples=2).awaitTermination()
    got = {(r["fingerprint"], r["country_code"]): (r["master_ids"], r["master_count"], r["sample_names"]) for r in read_pivot(spark, str(tmp_path / "store")).collect()}
    assert got == {("acme", "MX"): ([1, 2], 3, ["a", "b"]), ("solo", "MX"): ([1, 2], 2, ["s", "t"])}


def test_bad_rows_are_put_aside(spark, tmp_path, vocabulary):
    kind = "id bigint, name string, country_code string"
    batches = [[(1, "Zorvex", "MX"), (None, "Lost", "MX"), (2, "Quandor", "MX"), (2, "Quandor twice", "MX")], [(1, "Late", "MX"), (3, "Zorvex", "MX"), (4, "x" * 10_001, "MX")], [(5, "Zorvex", "MX"), (6, "Quandor SA", "MX")]]
    stream = write_batches(spark, tmp_path / "in", batches, kind)
    store, aside = str(tmp_path / "store"), str(tmp_path / "aside")
    resolve_stream(stream, store, str(tmp_path / "check"), vocabulary, quarantine=aside, dedup_every=3).awaitTermination()
    bad = {(r["id"], r["why_not"]) for r in spark.read.parquet(aside).collect()}
    assert bad == {(None, "no_id"), (2, "repeated_id"), (1, "not_newer"), (4, "name_too_long")}
    out = {r["id"]: r["master_id"] for r in read_store(spark, store).collect()}
    assert set(out) == {1, 2, 3, 5, 6} and out[3] == out[5] == 1
    plans = spark.read.parquet(f"{store}_merges").collect()
    assert [(r["primary_id"], r["secondaries"]) for r in plans] == [(2, [6])]
    good, none = split_bad_rows(spark.createDataFrame([], kind))
    assert good.count() == none.count() == 0


def test_no_warnings_without_reason(spark, vocabulary):
    rows = spark.createDataFrame([(1, "Lonely", "MX")], "id bigint, name string, country_code string")
    resolved = resolve_batch(rows, vocabulary)
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert dedup.auto_merge(resolved, master_documents(resolved), dedup.master_fingerprints(resolved, analysed_names(rows, vocabulary))).counters["groups"] == 0
