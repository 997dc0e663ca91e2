"""A training corpus from the documents table: language, near copies, leaks, secrets, mixture.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again for the next.
A stage's decisions take effect: what it rejects goes, what it redacts is redacted.

Nulls: a document without text is rejected by the first stage; null sources are a source of their own in the last; a null
key comes after all others where the second stage chooses the document of a group. Repeated rows are copies, of which the
second stage keeps one, that with the smallest key. Empty tables give empty results.
Columns beyond those of documents are dropped by the first stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masterlink.llm import decontaminate, jaccard, language, mixing, secrets
from masterlink.llm.common import durable, release_shuffles, small_batches
from masterlink.plans.durable import rewritten, shared_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, with lang set to it."""
    model = language.train_language_model(docs)
    named = language.identify_language(docs, model, keep=COLUMNS)
    return named.filter(~F.col("lang_rejected")).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents: the one with the smallest key, repeated rows and null keys included.

    A row is known by its key and a digest of all its columns, so rows of one key and different texts are told apart; rows
    that are equal in all columns are one document. Texts meet only hashes of what is kept, and are not sorted.
    """
    values = F.concat_ws(",", *(F.coalesce(F.md5(F.col(c).cast("string").cast("binary")), F.lit("-")) for c in COLUMNS))
    doc = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.unhex(F.md5(values)).alias("digest"))
    known = small_batches(docs).select(*COLUMNS).withColumn("__doc", doc)
    groups = jaccard.jaccard_components(known, id_col="__doc").filter(F.col("__doc") == F.col("component_id"))
    kept = durable(groups.groupBy(F.col("__doc.digest").alias("__kept")).agg(F.count("*").alias("n")))
    del groups
    release_shuffles(spark)
    digest = known.select(*COLUMNS, F.col("__doc.digest").alias("__digest"))
    out = lambda side: digest.join(side.hint("shuffle_hash"), F.col("__digest") == F.col("__kept"), "left_semi")
    once = out(kept.filter("n = 1")).select(*COLUMNS)
    if not kept.filter("n > 1").limit(1).count():
        return once
    return once.unionByName(out(kept.filter("n > 1")).dropDuplicates(["__digest"]).select(*COLUMNS))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item has leaked."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.flag_leaks(docs, items, keep=COLUMNS).filter(F.size("leaks") == 0).select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark and n_chars set to the new length."""
    ledger = secrets.scan_snapshot(docs, secrets.RULES, f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}")
    found = secrets.join_findings(docs, ledger, secrets.RULES)
    text = secrets.redact(F.col("text"), F.col("findings"))
    return found.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their places in the mixture of sources."""
    return mixing.mix_sources(docs.select(*COLUMNS))


STAGES = [
    ("language_id", identify_languages),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secrets", redact_secrets),
    ("mixing", mix),
]
#: The language model, Smith-Waterman and the scheduler's order over them are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = rewritten(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
