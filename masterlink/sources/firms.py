"""Firm rows: column mapping, schema checks and the tables that the driver provides."""

from __future__ import annotations

import ast

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masterlink.config import REQUIRED, RESULTS, ColumnMapping

#: The same text runs in Spark and DuckDB. Firm names, of all the kinds that the operators tell apart, made from parts.
FIRMS_SQL = """
SELECT p_partkey AS id,
 CASE p_partkey % 16
  WHEN 0 THEN concat(upper(p_name), ' S.A. DE C.V.')
  WHEN 1 THEN concat(upper(p_name), ', S.A. DE C.V.')
  WHEN 2 THEN concat(p_name, ' sa de cv')
  WHEN 3 THEN concat(upper(split_part(p_name, ' ', 2)), ' ', upper(split_part(p_name, ' ', 1)), ' SA DE CV')
  WHEN 4 THEN concat(upper(split_part(p_name, ' ', 1)), ' DE ', upper(split_part(p_name, ' ', 2)), ' SA DE CV')
  WHEN 5 THEN concat(upper(p_name), ' LIMITED')
  WHEN 6 THEN concat(upper(p_name), ' LTD.')
  WHEN 7 THEN concat(upper(split_part(p_name, ' ', 1)), ' ', upper(p_name))
  WHEN 8 THEN '#N/A'
  WHEN 9 THEN 'SAME AS CNEE'
  WHEN 10 THEN '...,-/'
  WHEN 11 THEN '   '
  WHEN 12 THEN 'TRADING S.A.'
  WHEN 13 THEN concat('AVENUE STREET ', CAST(p_size AS STRING))
  WHEN 14 THEN concat(upper(substr(p_name, 1, 1)), '.', upper(substr(split_part(p_name, ' ', 2), 1, 1)), '.K')
  ELSE upper(p_name) END AS name,
 CASE p_partkey % 5 WHEN 0 THEN 'MX' WHEN 1 THEN 'MX' WHEN 2 THEN 'US' WHEN 3 THEN 'TR' ELSE 'ZZ' END AS country_code,
 concat('+', CAST(p_size AS STRING)) AS phone
FROM part
"""
#: Mentions of the firms, one for each numbered order line.
MENTIONS_SQL = f"SELECT l.id, f.name, f.country_code, f.phone FROM (SELECT l_orderkey * 8 + l_linenumber AS id, min(l_partkey) AS part FROM lineitem GROUP BY ALL) l JOIN ({FIRMS_SQL}) f ON l.part = f.id"


def firms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, name, country_code, phone) made from the part table."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return spark.sql(FIRMS_SQL.replace("FROM part", "FROM {part}"), part=part)


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    lines = lines.groupBy((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("line")).agg(F.min("l_partkey").alias("part"))
    return lines.join(firms(spark, sf_dir), F.col("part") == F.col("id")).select(F.col("line").alias("id"), "name", "country_code", "phone")


def read_firms(table: DataFrame, mapping: ColumnMapping, country: str | None = None, unprocessed: bool = True) -> DataFrame:
    """The logical columns of a physical table: rows without a master, of one country if asked."""
    table = validate_schema(table, mapping)
    logical = {k: v for k, v in mapping.physical().items() if v in table.columns}
    out = table.select(*(F.col(f"`{v}`").alias("name" if k == "company_name" else k) for k, v in logical.items()))
    if unprocessed and "master_code" in out.columns:
        out = out.filter(F.col("master_code").isNull())
    return out.filter(F.col("country_code") == country) if country else out


def validate_schema(table: DataFrame, mapping: ColumnMapping) -> DataFrame:
    """The table with missing result columns added as nulls; raises if a column to read is missing."""
    names = mapping.physical()
    if missing := [names[k] for k in REQUIRED if names[k] not in table.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    absent = {names[k]: F.lit(None).cast(t) for k, t in RESULTS.items() if k in names and names[k] not in table.columns}
    return table.withColumns(absent) if absent else table


def derive_mapping(columns: list[str]) -> ColumnMapping:
    """A mapping by names: a logical column is found under its own name or a common other one."""
    others = {"company_name": ("name", "firm_name", "company"), "country_code": ("country", "cc"), "id": ("row_id",), "phone_number": ("phone", "tel"), "tax_number": ("tax", "vat"), "address": ("addr", "street")}
    low = {c.lower(): c for c in columns}
    found = {k: next((low[n] for n in (k, *others.get(k, ())) if n in low), None) for k in ColumnMapping().__dict__}
    for k in REQUIRED:
        if found[k] is None:
            raise ValueError(f"no column for {k} among {', '.join(columns)}")
    return ColumnMapping(**found)


def rewrite_mapping(source: str, mapping: ColumnMapping, name: str = "COLUMN_MAPPING") -> str:
    """A config file's text with its assignment of a mapping (a dictionary) replaced; added at the end if there is none.

    All else stays as it is. The block ends with the brace that closes it; braces in strings and comments don't count.
    """
    block = f"{name} = {{\n" + "".join(f"    {k!r}: {v!r},\n" for k, v in mapping.physical().items()) + "}\n"
    lines = source.splitlines(keepends=True)
    tree = ast.parse(source)
    for node in tree.body:
        targets = node.targets if isinstance(node, ast.Assign) else [node.target] if isinstance(node, ast.AnnAssign) else []
        if any(isinstance(t, ast.Name) and t.id == name for t in targets):
            return "".join([*lines[: node.lineno - 1], block, *lines[node.end_lineno :]])
    return source + ("" if source.endswith("\n") or not source else "\n") + block


def reset_results(table: DataFrame, mapping: ColumnMapping, countries: list[str] | None = None) -> DataFrame:
    """The table with its result columns null again, in the given countries or all."""
    names = mapping.physical()
    hit = F.col(f"`{names['country_code']}`").isin(countries) if countries else F.lit(True)
    table = validate_schema(table, mapping)
    return table.withColumns({names[k]: F.when(hit, F.lit(None)).otherwise(F.col(f"`{names[k]}`")).cast(table.schema[names[k]].dataType) for k in RESULTS if k in names})


def update_firms(table: DataFrame, results: DataFrame, mapping: ColumnMapping) -> DataFrame:
    """The table with the results' columns filled in by id; other rows keep what they have."""
    names = mapping.physical()
    fresh = results.select(F.col("id").alias("__id"), *(F.col(k).cast(t).alias(f"__{k}") for k, t in RESULTS.items() if k in results.columns))
    joined = validate_schema(table, mapping).join(fresh, F.col(f"`{names['id']}`") == F.col("__id"), "left")
    filled = {names[k]: F.coalesce(F.col(f"__{k}"), F.col(f"`{names[k]}`")) for k in RESULTS if k in names and f"__{k}" in joined.columns}
    return joined.withColumns(filled).drop("__id", *(f"__{k}" for k in RESULTS))
