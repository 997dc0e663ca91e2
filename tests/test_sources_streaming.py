from __future__ import annotations

import datetime as dt

import pytest

from masterlink import streaming
from masterlink.config import ColumnMapping
from masterlink.operators import resolve as R
from masterlink.sources import firms as S
from masterlink.sources import logs


def test_mapping_validation_and_update(spark, vocabulary):
    table = spark.createDataFrame([(1, "ACME", "MX", "x"), (2, "ACME", "MX", "y"), (3, " ", "MX", "z")], "firm_id bigint, title string, country string, extra string")
    mapping = ColumnMapping(id="firm_id", company_name="title", country_code="country")
    rows = S.read_firms(table, mapping)
    assert set(rows.columns) >= {"id", "name", "country_code", "master_code"}
    results = R.resolve_batch(rows.select("id", "name", "country_code"), vocabulary).withColumnRenamed("master_id", "master_code")
    done = S.update_firms(table, results, mapping)
    assert {r["firm_id"]: (r["master_code"], r["match_type"], r["extra"]) for r in done.collect()} == {1: ("1", "NEW_MASTER", "x"), 2: ("1", "CANONICAL_EXACT", "y"), 3: (None, None, "z")}
    assert [r["id"] for r in S.read_firms(done, mapping).collect()] == [3]
    assert S.read_firms(done, mapping, country="US", unprocessed=False).count() == 0
    with pytest.raises(ValueError, match="missing columns: id"):
        S.validate_schema(table, ColumnMapping())
    assert S.derive_mapping(["ID", "Company", "cc", "VAT"]) == ColumnMapping(id="ID", company_name="Company", country_code="cc", master_code=None, match_score=None, match_type=None, match_details=None, tax_number="VAT")


def test_logs_and_files(spark, tmp_path):
    rows = spark.createDataFrame([("1", "a", ["x", "y"])], "input_id string, stage_name string, names array<string>")
    path = str(tmp_path / "log")
    logs.append_log(rows.drop("names"), path, "run1")
    logs.append_log(rows.drop("names"), path, "run2")
    assert {r["run_id"] for r in spark.read.parquet(path).collect()} == {"run1", "run2"}
    logs.reset(spark, path, "input_id string, stage_name string")
    assert spark.read.parquet(path).count() == 0
    logs.write_findings(rows, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).head()["names"] == "x | y"
    logs.write_jsonl(rows, str(tmp_path / "json"))
    assert logs.read_jsonl(spark, str(tmp_path / "json"), rows.schema).head()["names"] == ["x", "y"]


def test_country_store(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.createDataFrame([(1, "MX"), (2, "US")], "master_id bigint, country_code string")
    logs.write_store(rows, path)
    logs.write_store(spark.createDataFrame([(3, "US")], "master_id bigint, country_code string"), path, countries=["US"])
    assert {(r["master_id"], r["country_code"]) for r in spark.read.parquet(path).collect()} == {(1, "MX"), (3, "US")}


def test_self_test(spark):
    assert logs.glue_works(spark)


def test_resolve_stream_equals_batch(spark, vocabulary, tmp_path):
    schema = "id bigint, name string, country_code string"
    parts = [[(1, "WITTE SA", "MX"), (2, "KOHLER", "MX")], [(3, "Witte, S.A.", "MX"), (4, "AUDI", "US")], [(5, "audi", "US"), (6, "#N/A", "MX")]]
    source, store, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        streaming.resolve_stream(stream, store, marks, vocabulary).awaitTermination()
    got = {r["id"]: (r["match_type"], r["master_id"]) for r in streaming.read_store(spark, store).collect()}
    whole = R.resolve_batch(spark.createDataFrame([r for p in parts for r in p], schema), vocabulary)
    assert got == {r["id"]: (r["match_type"], r["master_id"]) for r in whole.collect()}


def test_duplicate_pivot_stream(spark, tmp_path):
    schema = "master_id bigint, country_code string, fingerprint string, name string, detected_at timestamp"
    now = dt.datetime(2024, 1, 1)
    rows = [(1, "MX", "acme", "a", now), (2, "MX", "acme", "b", now), (3, "MX", "solo", "c", now)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    life = streaming.Lifecycle(spark, "dups")
    stream = streaming.duplicate_pivot(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    query = life.start(stream, str(tmp_path / "marks"), every="0 seconds")
    query.processAllAvailable()
    assert life.active() is not None
    found = [(r["fingerprint"], r["master_count"]) for r in spark.sql("SELECT * FROM dups").collect()]
    life.stop()
    assert found == [("acme", 2)] and life.active() is None


def test_windowed_counts_match_on_table_and_stream(spark, tmp_path):
    schema = "ts timestamp, kind string"
    rows = [(dt.datetime(2024, 1, 1, 0, m), "a" if m % 2 else "b") for m in range(0, 59, 7)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    batch = streaming.windowed_counts(spark.read.parquet(str(tmp_path / "in")), "ts", "10 minutes", "1 minute", "kind")
    stream = streaming.windowed_counts(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "ts", "10 minutes", "1 minute", "kind")
    query = stream.writeStream.format("memory").queryName("w").outputMode("complete").start()
    query.processAllAvailable()
    assert sorted(map(tuple, spark.sql("SELECT * FROM w").collect())) == sorted(map(tuple, batch.collect()))
    query.stop()
