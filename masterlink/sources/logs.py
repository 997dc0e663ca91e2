"""Logs, findings and stores as files: append-only logs, CSV and JSON lines, one folder per country."""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from masterlink.functions.text import tokenize


def append_log(rows: DataFrame, path: str, run_id: str) -> None:
    """Append to a log, partitioned by run; writing a run again adds it twice, so runs are named once."""
    rows.withColumn("created_at", F.current_timestamp()).withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(path)


def reset(spark: SparkSession, path: str, schema: str) -> None:
    """Leave an empty table."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def write_findings(rows: DataFrame, path: str, separator: str = " | ") -> None:
    """CSV with a header; arrays are joined."""
    joined = [F.array_join(F.col(f.name).cast("array<string>"), separator).alias(f.name) if isinstance(f.dataType, ArrayType) else F.col(f.name) for f in rows.schema]
    rows.select(*joined).write.mode("overwrite").option("header", True).csv(path)


def write_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_store(rows: DataFrame, path: str, countries: list[str] | None = None, known: list[str] | None = None, force: bool = True) -> list[str]:
    """Master tables by country. With countries, only their folders are replaced; without force, only ones that are missing are written.

    Returns the codes that were left out: those that are not among the known ones (which are warned of), and those that
    are there already.
    """
    if not countries:
        rows.write.mode("overwrite").partitionBy("country_code").parquet(path)
        return []
    countries = sorted({c.strip().upper() for c in countries})
    unknown = [c for c in countries if known is not None and c not in known]
    if unknown:
        warnings.warn(f"unknown countries are left out: {', '.join(unknown)}", stacklevel=2)
    there = [] if force else stored_countries(rows.sparkSession, path)
    wanted = [c for c in countries if c not in unknown and c not in there]
    if wanted:
        rows.filter(F.col("country_code").isin(wanted)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("country_code").parquet(path)
    return [c for c in countries if c not in wanted]


def stored_countries(spark: SparkSession, path: str) -> list[str]:
    try:
        return [r["country_code"] for r in spark.read.parquet(path).select("country_code").distinct().collect()]  # a row per country
    except AnalysisException:
        return []


def glue_works(spark: SparkSession, name: str = "K.W.M", token: str = "kwm") -> bool | None:
    """Self-test before a run: `K.W.M` is one token. None if it can't be told, as where the test itself fails."""
    try:
        return spark.createDataFrame([(name,)], "n string").select(tokenize(F.col("n")).alias("t")).head()["t"] == [token]
    except PySparkException:
        return None


def check_glue(spark: SparkSession) -> None:
    """Stops a run whose names would be read in another way than the stored ones; an unknown outcome is only warned of."""
    works = glue_works(spark)
    if works is None:
        warnings.warn("the reading of acronyms could not be tested", stacklevel=2)
    elif not works:
        raise RuntimeError("acronyms are not read as one word; the stored names were")
