"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions only.

Each source's rows, in an order fixed by a hash of the key, are cut into blocks. With weight c/P (whole numbers, P the
period), a source's block b (from 0) is released at slot floor(b P / c) and due by slot ceil((b + 1) P / c). In each slot
the released block with the earliest deadline goes next (ties to the first source). As the weights add up to one, every
block runs within its window, so a source's share of the first t slots never differs from t c / P by a whole block. The
schedule repeats after P slots; it is found by a fold over one period, or over the slots that the rows need if these are
fewer, in one row whose size the sources and those slots bound.

Given weights are met exactly: as decimal numbers they are whole multiples of one unit, which are the c. Weights that share
no short period, such as thirds, cost a fold over all slots in use; params.period rounds them to about 1 / period instead.
Without given weights, the targets are whole numbers too: about `units` in all, shared out by a power of the rows.

All rows are kept, once each. When a source has no block left, its slots stay empty and the others go on in theirs.

A row's number within its source comes from counts by (source, hash range): ranges of bounded size are numbered on their
own and offset by the ranges before, so a source with a third of all rows is spread over many tasks.

Edge cases: a null source is a source of its own; null keys, ties and repeated rows are numbered in an arbitrary but
complete order; texts are not read; an empty table gives an empty result; sources missing from the given weights raise an
error, as do more than max_sources sources, if that is set, and weights of more than 18 digits; other columns pass through
(those named like the new ones are replaced; names that begin with __mix_ are reserved).
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from masterlink.llm.common import durable


@dataclass(frozen=True)
class MixParams:
    block_rows: int = 8
    #: If set, given weights are rounded to about 1 / period, at least one slot each, instead of being met exactly.
    period: int | None = None
    #: Without given weights, a source's weight is its number of rows to this power, rounded to about 1 / units.
    temper: float = 0.7
    units: int = 1000
    #: Rows in a range that one task numbers, on average.
    range_rows: int = 4000
    #: Slots of a schedule up to which it is sent to all tasks.
    broadcast_slots: int = 1 << 16
    max_sources: int | None = None


NEW = ("mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_offset")


def order_key(id_col: Column) -> Column:
    return F.md5(F.concat(F.lit("mix:"), F.coalesce(id_col.cast("string"), F.lit(""))))


def divided(a: Column, b: Column) -> Column:
    """a / b as a long, cut to a whole number; exact for decimals and longs."""
    return F.call_function("div", a, b)


def release(block: Column, c: Column, p: Column) -> Column:
    return divided(wide(block) * narrow(p), narrow(c))


def deadline(block: Column, c: Column, p: Column) -> Column:
    return divided(wide(block + 1) * narrow(p) + narrow(c) - 1, narrow(c))


def wide(col: Column) -> Column:
    return col.cast("decimal(19,0)")


def narrow(col: Column) -> Column:
    return col.cast("decimal(18,0)")


def whole_units(weights: dict[str | None, float]) -> list[tuple[str | None, int]]:
    """The weights as whole multiples of one unit, exactly as their decimal digits say."""
    exact = {s: Decimal(str(w)) for s, w in weights.items()}
    digits = max((-int(w.as_tuple().exponent) for w in exact.values() if w.is_finite()), default=0)
    out = [(s, int(w.scaleb(max(0, digits))) if w.is_finite() else 0) for s, w in exact.items()]
    if sum(max(0, n) for _, n in out) >= 10**18:
        raise ValueError("the weights have more than 18 digits; round them or set params.period")
    return out


def rounded_units(shares: DataFrame, period: int) -> DataFrame:
    """From (source, weight), whole numbers (source, c) that add up to about the period."""
    # Summed in the order of the sources, so that retries round alike.
    listed = shares.agg(F.array_sort(F.collect_list(F.struct("source", F.col("weight").cast("double").alias("w")))).alias("s"))
    total = listed.select(F.aggregate("s", F.lit(0.0), lambda a, x: a + x["w"]).alias("t")).head()["t"]
    c = F.greatest(F.lit(1), F.round(F.col("weight") / F.lit(total or 1.0) * period)).cast("long")
    return shares.select("source", c.alias("c"))


def pfair_slots(units: DataFrame, steps: Column) -> DataFrame:
    """From (source, c) the schedule (source, c, p, block, slot) of the first `steps` slots, of a period at most."""
    rows = units.agg(F.array_sort(F.collect_list(F.struct("source", F.col("c").cast("long").alias("c")))).alias("s")).filter(F.size("s") > 0)
    rows = rows.withColumn("p", F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + x["c"]))
    rows = rows.withColumn("steps", F.least(steps.cast("long"), F.col("p")))
    rows = rows.withColumn("side", F.ceil(F.sqrt("steps")).cast("long"))

    def pick(done: Column, t: Column) -> Column:
        """The source whose next block is released by slot t and due first."""
        jobs = F.transform(done, lambda k, i: F.when(release(k, F.get("s", i)["c"], F.col("p")) <= t, F.struct(deadline(k, F.get("s", i)["c"], F.col("p")).alias("due"), i.alias("i"))))
        return F.array_min(jobs)["i"]

    def step(acc: Column, t: Column) -> Column:
        chosen = F.transform(
            F.array(pick(acc["done"], t)),
            lambda b: F.struct(F.transform(acc["done"], lambda k, i: F.when(i == b, k + 1).otherwise(k)).alias("done"), F.concat(acc["picks"], F.array(b)).alias("picks")),
        )
        return chosen[0]

    # Slots are folded in runs, whose arrays are short, so that the work is not quadratic in the slots.
    no_picks = F.array().cast("array<int>")

    def run(acc: Column, first: Column) -> Column:
        slots = F.sequence(first, F.least(first + F.col("side"), F.col("steps")) - 1)
        folded = F.aggregate(slots, F.struct(acc["done"].alias("done"), no_picks.alias("picks")), step)
        both = F.transform(F.array(folded), lambda x: F.struct(x["done"].alias("done"), F.concat(acc["runs"], F.array(x["picks"])).alias("runs")))
        return both[0]

    start = F.struct(F.transform("s", lambda x: F.lit(0).cast("long")).alias("done"), F.array().cast("array<array<int>>").alias("runs"))
    firsts = F.sequence(F.lit(0).cast("long"), F.col("steps") - 1, F.col("side"))
    rows = rows.withColumn("picks", F.flatten(F.aggregate(firsts, start, run, lambda acc: acc["runs"])))
    picked = rows.select("s", "p", F.posexplode("picks").alias("slot", "i"))
    picked = picked.select(F.get("s", F.col("i")).alias("x"), "p", "slot")
    block = F.row_number().over(W.partitionBy("x").orderBy("slot")) - 1
    return picked.select(F.col("x.source").alias("source"), F.col("x.c").alias("c"), "p", block.cast("long").alias("block"), F.col("slot").cast("long").alias("slot"))


def mix_sources(docs: DataFrame, weights: dict[str | None, float] | None = None, params: MixParams = MixParams(), id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """docs with mix_block, mix_release, mix_deadline, mix_slot and mix_offset (the row's place in its block).

    Reading by mix_slot, then mix_offset, gives the mixture.
    """
    spark = docs.sparkSession
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in NEW))
    named = docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("id"))
    rows = named.count()
    ranges = max(1, rows // params.range_rows)
    place = lambda key: F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * ranges / F.lit(1 << 32)).cast("int")
    # One count per source and range: the ranges grow with the rows.
    counts = durable(named.groupBy("source", place(order_key(F.col("id"))).alias("range")).agg(F.count("*").alias("n")))
    totals = counts.groupBy("source").agg(F.sum("n").alias("n"))
    if params.max_sources is not None and (n_sources := totals.count()) > params.max_sources:
        raise ValueError(f"{n_sources} sources; max_sources is {params.max_sources}")
    if weights is None:
        units = rounded_units(totals.select("source", F.pow("n", F.lit(params.temper)).alias("weight")), params.units)
    else:
        given = spark.createDataFrame([(k, float(v), n) for (k, v), (_, n) in zip(weights.items(), whole_units(weights), strict=True)], "source string, weight double, c long")
        shares = totals.join(given, totals["source"].eqNullSafe(given["source"]), "left").select(totals["source"], "weight", "c")
        if shares.filter(F.col("c").isNull() | (F.col("c") <= 0)).limit(1).count():
            raise ValueError("a source has no positive target weight")
        units = rounded_units(shares, params.period) if params.period else shares.select("source", "c")
    # The last slot in use: no schedule needs more slots than a period, or than the rows fill.
    blocks = totals.join(units.withColumnRenamed("source", "unit_of"), F.col("source").eqNullSafe(F.col("unit_of"))).select("c", F.ceil(F.col("n") / params.block_rows).cast("long").alias("blocks"))
    period = units.agg(F.sum("c").alias("p")).head()["p"] or 0
    last = blocks.agg(F.max(deadline(F.col("blocks") - 1, F.col("c"), F.lit(period))).alias("t")).head()["t"] or 0
    steps = min(last, period)
    slots = durable(pfair_slots(units, F.lit(steps)))
    before = F.sum("n").over(W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select(F.col("source").alias("__mix_s"), F.col("range").alias("__mix_r"), F.coalesce(before, F.lit(0)).alias("__mix_before"))
    own = W.partitionBy("__mix_source", "__mix_range").orderBy("__mix_key", F.col(f"`{id_col}`"))
    out = docs.withColumns({"__mix_source": F.col(f"`{source_col}`"), "__mix_key": order_key(F.col(f"`{id_col}`"))}).withColumn("__mix_range", place(F.col("__mix_key")))
    out = out.withColumn("__mix_no", F.row_number().over(own))
    out = out.join(offsets, out["__mix_source"].eqNullSafe(offsets["__mix_s"]) & (out["__mix_range"] == offsets["__mix_r"]))
    no = F.col("__mix_before") + F.col("__mix_no") - 1
    out = out.withColumns({"mix_block": F.floor(no / params.block_rows).cast("long"), "mix_offset": (no % params.block_rows).cast("long")})
    shares = slots.select(F.col("source").alias("__mix_u"), F.col("c").alias("__mix_c"), F.col("p").alias("__mix_p")).distinct()
    slots = slots.select(F.col("source").alias("__mix_t"), F.col("block").alias("__mix_b"), F.col("slot").alias("__mix_slot"))
    if steps <= params.broadcast_slots:
        shares, slots = F.broadcast(shares), F.broadcast(slots)
    out = out.join(shares, F.col("__mix_source").eqNullSafe(F.col("__mix_u")))
    b, c, p = F.col("mix_block"), F.col("__mix_c"), F.col("__mix_p")
    out = out.join(slots, F.col("__mix_source").eqNullSafe(F.col("__mix_t")) & (b % c == F.col("__mix_b")))
    out = out.withColumns({"mix_release": release(b, c, p), "mix_deadline": deadline(b, c, p), "mix_slot": divided(b, c) * p + F.col("__mix_slot")})
    return out.select(*(f"`{x}`" for x in docs.columns), *NEW)
