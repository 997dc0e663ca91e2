"""Streaming forms: continuous duplicate counts and micro-batch resolution."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from masterlink.config import INTENDED, Profile
from masterlink.operators.dedup import duplicate_groups, master_fingerprints, merge_plan, potential_duplicates
from masterlink.operators.resolve import analysed_names, resolve_incremental
from masterlink.sources.rules import Vocabulary


def duplicate_pivot(variations: DataFrame, delay: str = "60 seconds", time: str = "detected_at") -> DataFrame:
    """Masters per fingerprint and country over a stream of (master_id, country_code, fingerprint, detected_at).

    State is one sketch per fingerprint, so it doesn't grow with the number of masters.
    """
    seen = variations.withWatermark(time, delay).filter("fingerprint <> ''")
    counts = seen.groupBy("fingerprint", "country_code").agg(F.approx_count_distinct("master_id").alias("master_count"), F.max(time).alias("detected_at"), F.min("name").alias("sample_name"))
    return counts.filter("master_count > 1")


def windowed_counts(rows: DataFrame, time: str, width: str, delay: str, *keys: str) -> DataFrame:
    """Rows per key and tumbling window, for a stream or a table; late rows beyond the delay are dropped on streams."""
    return rows.withWatermark(time, delay).groupBy(F.window(time, width).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), *keys, "n")


class Lifecycle:
    """Start, stop and look at a named streaming query; starting anew stops one of the same name."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name

    def active(self) -> StreamingQuery | None:
        return next((q for q in self.spark.streams.active if q.name == self.name), None)

    def start(self, stream: DataFrame, path: str, mode: str = "update", every: str = "5 minutes", sink: str = "memory") -> StreamingQuery:
        self.stop()
        writer = stream.writeStream.queryName(self.name).outputMode(mode).format(sink).trigger(processingTime=every)
        return writer.option("checkpointLocation", path).start()

    def stop(self) -> None:
        if query := self.active():
            query.stop()


def pivot_stream(variations: DataFrame, store: str, checkpoint: str, ids: int = 50, samples: int = 5, min_count: int = 2) -> StreamingQuery:
    """The duplicate pivot kept exactly, over a stream of (master_id, country_code, fingerprint, name).

    Each micro-batch adds its distinct pairs to the store, by batch, and writes the pivot rows of the fingerprints that it
    touched: master ids (the `ids` smallest), their number, and sample names. `read_pivot` gives the newest row of each.
    A batch that is run again after a failure overwrites its own folders.
    """

    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        pairs = batch.filter("fingerprint <> ''").select(*PAIRS).distinct()
        pairs.write.mode("overwrite").parquet(f"{store}/pairs/batch={number}")
        every = read_batches(spark, f"{store}/pairs", PAIR_SCHEMA, before=number + 1)
        touched = every.filter(F.col("batch") == number).select("country_code", "fingerprint").distinct()
        theirs = every.join(touched, ["country_code", "fingerprint"], "left_semi")
        rows = potential_duplicates(theirs, ids, samples, min_count).withColumn("detected_at", F.current_timestamp())
        rows.write.mode("overwrite").parquet(f"{store}/pivot/batch={number}")

    return variations.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


PAIRS = ("country_code", "fingerprint", "master_id", "name")
PAIR_SCHEMA = "country_code string, fingerprint string, master_id bigint, name string, batch int"
PIVOT_SCHEMA = "fingerprint string, country_code string, master_ids array<bigint>, master_count bigint, sample_names array<string>, detected_at timestamp, batch int"


def read_pivot(spark: SparkSession, store: str) -> DataFrame:
    """The newest pivot row of each fingerprint and country."""
    rows = read_batches(spark, f"{store}/pivot", PIVOT_SCHEMA)
    last = rows.groupBy("fingerprint", "country_code").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["fingerprint", "country_code", "batch"]).drop("batch")


#: Reasons for which a row can't be resolved; the first that holds is given.
BAD_ROWS = (("no_id", "id IS NULL"), ("not_newer", "id <= {last}"), ("repeated_id", "copy > 1"), ("name_too_long", "length(name) > {longest}"))


def split_bad_rows(batch: DataFrame, last: int | None = None, longest: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """The rows to resolve, and the others with why_not; repeated ids keep their first row, by name."""
    reason = F.coalesce(*(F.when(F.expr(test.format(last="NULL" if last is None else last, longest=longest)), name) for name, test in BAD_ROWS))
    copies = F.row_number().over(W.partitionBy("id").orderBy("name", "country_code"))
    marked = batch.withColumn("copy", F.when(F.col("id").isNotNull(), copies).otherwise(1)).withColumn("why_not", reason).drop("copy")
    return marked.filter("why_not IS NULL").drop("why_not"), marked.filter("why_not IS NOT NULL")


def resolve_stream(rows: DataFrame, store: str, checkpoint: str, vocabulary: Vocabulary, profile: Profile = INTENDED, quarantine: str | None = None, dedup_every: int | None = None) -> StreamingQuery:
    """Resolve micro-batches of (id, name, country_code) into Parquet at `store`, partitioned by batch.

    A batch reads the masters of earlier batches and writes its own folder, overwriting it when it is run again after a
    failure, so each row is resolved once. Rows must come with growing ids. With a quarantine folder, rows that can't be
    resolved go there with the reason, and the others go on. With dedup_every, each so many batches the duplicate groups
    that their masters are in are written as a merge plan to `store` + "_merges".
    """

    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        known = read_store(spark, store, before=number)
        if quarantine:
            last = known.agg(F.max("id").alias("id")).head()["id"]
            batch, bad = split_bad_rows(batch, last)
            bad.write.mode("overwrite").parquet(f"{quarantine}/batch={number}")
        resolve_incremental(batch, known, vocabulary, profile).write.mode("overwrite").parquet(f"{store}/batch={number}")
        if dedup_every and (number + 1) % dedup_every == 0:
            every = read_store(spark, store, before=number + 1)
            variations = master_fingerprints(every, analysed_names(every.select("id", "name", "country_code"), vocabulary, profile))
            fresh = every.filter(F.col("batch") > number - dedup_every).select("master_id").distinct()
            merge_plan(duplicate_groups(variations, masters=fresh)).write.mode("overwrite").parquet(f"{store}_merges/batch={number}")

    return rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


SCHEMA = "id bigint, name string, country_code string, match_type string, master_id bigint, match_score double, match_details string, reason string, batch int"


def read_store(spark: SparkSession, store: str, before: int | None = None) -> DataFrame:
    """The resolved rows of all batches, or of those before one."""
    return read_batches(spark, store, SCHEMA, before)


def read_batches(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """The rows of a folder with one folder per batch; none before the first."""
    try:
        rows = spark.read.schema(schema).option("basePath", path).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return rows if before is None else rows.filter(F.col("batch") < before)
