"""Secret scans: an incremental ledger of blobs, with DataFrame functions only.

Every version of a text is addressed by its content (SHA-256). The ledger holds, for each pair of a blob and a rule's
version, the spans found, the empty list included; as a table, it grows by one folder per scan.
A scan compares the hashes of the given versions with the ledger, runs only the rules that a blob has not met, and returns
the new ledger rows. Findings are then joined back to all paths and versions that carry the blob. A new rule, or a new
version of one, scans only that rule.

Spans are in code points, with the end excluded. A rule finds the leftmost non-overlapping matches of its pattern and
drops those whose value is too short.

Edge cases: a null text is the empty text, which has no secrets; repeated rows each get the findings; null keys stay; very
long texts are scanned whole, one at a time; ties of spans are ordered by the rules' order; an empty table gives an empty
result; other columns pass through (those named like the new ones are replaced). Copies of one text, however many, leave one
row of spans per task before the shuffle, and the join back splits a skewed blob.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from masterlink.llm.common import durable, sized_side, small_batches


@dataclass(frozen=True)
class SecretRule:
    kind: str
    version: int
    #: Java regular expression.
    pattern: str
    #: The group of the pattern whose length counts (0: the whole match).
    value_group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


BASE_RULES = [
    SecretRule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    SecretRule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    SecretRule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
]
MORE_RULES = [
    SecretRule("github", 1, r"gh[pousr]_[A-Za-z0-9]{20,}"),
    SecretRule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("jwt", 1, r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    SecretRule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
]
RULES = BASE_RULES + MORE_RULES
SPANS = "array<struct<start:int,end:int>>"
#: Rows (of 64 bytes and the rules' keys) up to which the list of blobs with unseen pairs is sent to all tasks.
UNSEEN_ROWS = 100_000


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def find_spans(text: Column, rule: SecretRule) -> Column:
    """array<struct<start, end>> of the rule's matches in the text.

    Each match is taken together with the gap before it, from where the last match ended; sums of lengths give positions.
    """
    regex = F.lit(rf"(?s)\G(.*?)({rule.pattern})")
    pieces = F.arrays_zip(F.regexp_extract_all(text, regex, 1).alias("gap"), F.regexp_extract_all(text, regex, 2).alias("hit"), F.regexp_extract_all(text, regex, 2 + rule.value_group).alias("value"))

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["gap"])
        end = start + F.length(p["hit"])
        out = F.when(F.length(p["value"]) >= rule.least, F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(acc["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    empty = F.array().cast(SPANS)
    found = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])
    return F.when(text.rlike(rule.pattern), found).otherwise(empty)


def scan_blobs(versions: DataFrame, rules: list[SecretRule], ledger: DataFrame | None = None, text_col: str = "text") -> DataFrame:
    """New ledger rows (blob_id, rule, spans) for the unseen pairs of a blob of the versions and a rule's version.

    Texts are read where they lie: only hashes meet the ledger, and only hashes and spans are shuffled. The list of blobs
    with unseen pairs goes to all tasks if its measured size allows; else it is joined with the texts by hash.
    """
    keys = F.array(*(F.lit(r.key) for r in rules))
    rows = small_batches(versions).select(blob_id(F.col(text_col)).alias("blob_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if ledger is None:
        rows = rows.withColumn("open", keys)
    else:
        seen = ledger.select("blob_id", "rule").groupBy("blob_id").agg(F.collect_set("rule").alias("seen"))
        blobs = rows.select("blob_id").distinct().join(seen, "blob_id", "left")
        blobs = durable(blobs.select("blob_id", F.array_except(keys, F.coalesce("seen", F.array().cast("array<string>"))).alias("open")).filter(F.size("open") > 0))
        rows = rows.join(sized_side(blobs, UNSEEN_ROWS), "blob_id")
    found = F.filter(F.array(*(F.when(F.array_contains("open", r.key), F.struct(F.lit(r.key).alias("rule"), find_spans(F.col("text"), r).alias("spans"))) for r in rules)), lambda x: x.isNotNull())
    # One pass tells the texts that no rule matches, which are most.
    clean = F.transform("open", lambda key: F.struct(key.alias("rule"), F.array().cast(SPANS).alias("spans")))
    any_rule = "|".join(f"(?:{r.pattern})" for r in rules)
    scanned = rows.select("blob_id", F.when(F.col("text").rlike(any_rule), found).otherwise(clean).alias("found"))
    # Copies give equal spans; one row per blob and task goes on.
    return scanned.groupBy("blob_id").agg(F.first("found").alias("found")).select("blob_id", F.inline("found"))


def join_findings(versions: DataFrame, ledger: DataFrame, rules: list[SecretRule], text_col: str = "text") -> DataFrame:
    """The versions with blob_id and findings: array<struct<start, kind_no, end, kind>> sorted by start and kind.

    Only current versions of the rules count. findings is an empty array where there are none.
    """
    number = F.create_map(*(x for k, r in enumerate(rules) for x in (F.lit(r.key), F.lit(k))))
    kind = F.create_map(*(x for r in rules for x in (F.lit(r.key), F.lit(r.kind))))
    hits = ledger.filter((F.size("spans") > 0) & F.col("rule").isin([r.key for r in rules])).select("blob_id", F.col("rule"), F.explode("spans").alias("s"))
    entry = F.struct(F.col("s.start").alias("start"), number[F.col("rule")].alias("kind_no"), F.col("s.end").alias("end"), kind[F.col("rule")].alias("kind"))
    # A ledger may hold a pair twice after a retried append; the set keeps one of each.
    by_blob = hits.groupBy("blob_id").agg(F.array_sort(F.collect_set(entry)).alias("findings"))
    keep = [F.col(f"`{c}`") for c in versions.columns if c not in ("blob_id", "findings")]
    paths = small_batches(versions).select(*keep, blob_id(F.col(text_col)).alias("blob_id"))
    none = F.array().cast("array<struct<start:int,kind_no:int,end:int,kind:string>>")
    # Hashed, not sorted: the versions may carry whole texts.
    return paths.join(by_blob.hint("shuffle_hash"), "blob_id", "left").withColumn("findings", F.coalesce("findings", none))


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger table (blob_id, rule, spans), or None before the first scan."""
    try:
        return spark.read.schema(f"blob_id string, rule string, spans {SPANS}").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def scan_snapshot(versions: DataFrame, rules: list[SecretRule], path: str, text_col: str = "text") -> DataFrame:
    """Scans what the ledger table at the path has not seen of the versions, appends it, and gives the pairs scanned now.

    Each scan is a folder of the table; a scan that broke off leaves none, and a pair that two scans hold counts once.
    """
    spark = versions.sparkSession
    own = f"{path}/scan={uuid.uuid4().hex}"
    scan_blobs(versions, rules, read_ledger(spark, path), text_col).write.parquet(own)
    return spark.read.schema(f"blob_id string, rule string, spans {SPANS}").parquet(own)


def spans_text(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, findings: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping spans replaced by the mark."""

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        piece = F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(fresh, F.concat(acc["out"], F.array(piece))).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    body = F.aggregate(findings, start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(findings) > 0, body).otherwise(text)
