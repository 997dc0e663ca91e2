"""Chat formatting: conversations with common first turns share one prefix tree, emitted once depth-first.

A turn is formatted as `<|im_start|>role\\ntext<|im_end|>\\n`. In texts and roles a backslash is doubled and `<|` becomes
`<\\|`, so no control string can appear inside; a line feed in a role becomes `\\n`. Both are undone on reading.

A node of the tree stands for a sequence of first turns; its key is a hash chained over them. Conversations that share
first turns share the nodes. Different conversations sorted by their lists of keys are in depth-first order: what each
shares with the one before it is there already, and the rest, a run of nodes, is emitted next. A stack holds where the
current path's nodes stand, so every run gets its start and the intervals of its ancestors. Each node carries the position
id of its first token, which is the length of its ancestors, and the intervals that its tokens may attend to: its
ancestors', merged where they touch, and, causally, its own. Tokens are code points here; a tokenizer's lengths can take
their place.

No tree is gathered in one task: conversations are range-partitioned by path, copies counted once before. A first pass
gives each partition's ends, from which the driver, with a row per partition, finds where each one starts. Work and output
grow with the turns, however long a conversation. One conversation is put together in one task.

Edge cases: null texts and roles are empty; turns with the same number are ordered by role and text, null numbers first;
repeated rows are repeated turns; a null conversation key is a conversation of its own; empty tables give no segments;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masterlink.llm.common import durable, small_batches

START, END = "<|im_start|>", "<|im_end|>"
KEY = 32  # hex digits of a node's key


def escape(text: Column, role: bool = False) -> Column:
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))
    return F.replace(out, F.lit("\n"), F.lit("\\n")) if role else out


def unescape(text: Column, role: bool = False) -> Column:
    def piece(x: Column) -> Column:
        x = F.replace(x, F.lit("<\\|"), F.lit("<|"))
        return F.replace(x, F.lit("\\n"), F.lit("\n")) if role else x

    return F.array_join(F.transform(F.split(text, r"\\\\"), piece), "\\")


def conversation_chains(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, leaf, nodes): for each conversation its nodes from the root: key, formatted turn, size, loss interval."""
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    turn = F.struct(F.col(turn_col).alias("turn"), empty(role_col).alias("role"), empty(text_col).alias("text"))
    turns = rows.groupBy(F.col(conv_col).alias("conv")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def step(acc: Column, t: Column) -> Column:
        head = F.concat(F.lit(START), escape(t["role"], role=True), F.lit("\n"))
        body = escape(t["text"])
        formatted = F.concat(head, body, F.lit(END + "\n"))
        key = F.substring(F.sha2(F.concat(acc["key"], formatted).cast("binary"), 256), 1, KEY)
        loss = t["role"] == "assistant"
        node = F.struct(
            key.alias("key"),
            formatted.alias("text"),
            F.length(formatted).alias("size"),
            F.when(loss, F.length(head)).otherwise(0).alias("loss_start"),
            F.when(loss, F.length(head) + F.length(body)).otherwise(0).alias("loss_end"),
        )
        return F.struct(key.alias("key"), F.concat(acc["nodes"], F.array(node)).alias("nodes"))

    none = "cast(array() as array<struct<key:string,text:string,size:int,loss_start:int,loss_end:int>>)"
    start = F.struct(F.lit("").alias("key"), F.expr(none).alias("nodes"))
    return turns.select("conv", F.inline(F.array(F.aggregate("turns", start, step)))).select("conv", F.col("key").alias("leaf"), "nodes")


class PathStack:
    """Where the nodes of the current path stand: entries (first depth, end depth, start)."""

    def __init__(self, entries: list[tuple[int, int, int]], offset: int, keys: list[str]):
        self.entries, self.offset, self.keys = entries, offset, keys

    def move(self, keys: list[str], ends: list[int]) -> tuple[int, int, list[tuple[int, int]]]:
        """Go on to the next path, whose node d ends at length ends[d]: its shared depth, run start, ancestors' intervals."""
        shared = common_length(self.keys, keys)
        length = [0, *ends]
        self.entries = [(a, min(b, shared), s) for a, b, s in self.entries if a < shared]
        spans: list[tuple[int, int]] = []
        for a, b, s in self.entries:
            e = s + length[b] - length[a]
            if spans and spans[-1][1] == s:
                spans[-1] = (spans[-1][0], e)
            else:
                spans.append((s, e))
        start = self.offset
        if len(keys) > shared:
            self.entries.append((shared, len(keys), start))
        self.offset += length[-1] - length[shared]
        self.keys = keys
        return shared, start, spans


def common_length(a: list[str], b: list[str]) -> int:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def packed_segments(chains: DataFrame) -> DataFrame:
    """One row per node of the prefix trees, shared by all conversations through it.

    key, depth, position, text, loss_start, loss_end (in the segment), start, end (in the packed stream) and attends: the
    intervals of its ancestors and itself. Sorted by start, the texts make up the packed stream.
    """
    spark = small_batches(chains).sparkSession
    paths = chains.groupBy("leaf").agg(F.first("nodes").alias("nodes")).withColumn("keys", F.transform("nodes", lambda n: n["key"]))
    paths = durable(paths.select("keys", "nodes").repartitionByRange(F.col("keys")).sortWithinPartitions("keys"))
    sizes = F.transform("nodes", lambda n: n["size"])

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The partition's first and last path and its stack, with offsets counted from the first path's root."""
        from pyspark import TaskContext

        stack, first, last = None, None, None
        for b in batches:
            for keys, sizes in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                last = list(accumulate(sizes))
                stack, first = stack or PathStack([], 0, []), first or (keys, last)
                stack.move(keys, last)
        if stack:
            row = (TaskContext.get().partitionId(), *first, stack.keys, last, [list(e) for e in stack.entries], stack.offset)
            kinds = [pa.int32(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.list_(pa.int64())), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=["part", "first", "first_ends", "last", "last_ends", "entries", "size"])

    schema = "part int, first array<string>, first_ends array<bigint>, last array<string>, last_ends array<bigint>, entries array<array<bigint>>, size bigint"
    # A row per partition, as long as its first and last conversation.
    rows = sorted(paths.select("keys", sizes.alias("sizes")).mapInArrow(ends, schema).toArrow().to_pylist(), key=lambda r: r["part"])
    states: dict[int, tuple[list[tuple[int, int, int]], int, list[str]]] = {}
    known, offset, keys = [], 0, []
    for r in rows:
        states[r["part"]] = (list(known), offset, keys)
        shared = common_length(keys, r["first"])
        root = offset - [0, *r["first_ends"]][shared]  # where the first path's root would stand
        held = [(a, min(b, shared), s) for a, b, s in known if a < shared]
        length = [0, *r["last_ends"]]
        now: list[tuple[int, int, int]] = []
        for a, b, s in r["entries"]:
            if a < shared:  # of the first path: what is shared stands with the partitions before
                now += [(x, min(y, b), z) for x, y, z in held if x < b]
                if b > shared:
                    now.append((shared, b, root + length[shared]))
            else:
                now.append((a, b, root + s))
        known, offset, keys = now, root + r["size"], r["last"]
    shared_states = spark.sparkContext.broadcast(states)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        stack = None
        for b in batches:
            out = []
            for keys, sizes in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if stack is None:
                    stack = PathStack(*shared_states.value[TaskContext.get().partitionId()])
                out.append(stack.move(keys, list(accumulate(sizes))))
            spans = pa.array([[{"start": s, "end": e} for s, e in x[2]] for x in out], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int64()), spans, b.column(2)], names=["shared", "run", "above", "nodes"])

    nodes = paths.schema["nodes"].dataType.simpleString()
    placed = paths.select("keys", sizes.alias("sizes"), "nodes").mapInArrow(place, f"shared int, run bigint, above array<struct<start:bigint,end:bigint>>, nodes {nodes}")
    lengths = F.aggregate("nodes", F.array(F.lit(0).cast("bigint")), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n["size"])))
    rows_ = durable(placed.withColumn("lengths", lengths)).select("shared", "run", "above", "lengths", F.posexplode("nodes").alias("depth", "n")).filter(F.col("depth") >= F.col("shared"))
    start = F.col("run") + F.get("lengths", F.col("depth")) - F.get("lengths", F.col("shared"))
    rows_ = rows_.select("n.key", "depth", F.get("lengths", F.col("depth")).alias("position"), "n.text", "n.loss_start", "n.loss_end", start.alias("start"), (start + F.col("n.size")).alias("end"), "above", "run")
    return rows_.withColumn("attends", F.concat("above", F.array(F.struct(F.col("run").alias("start"), F.col("end").alias("end"))))).drop("above", "run")


def read_back(chains: DataFrame, segments: DataFrame) -> DataFrame:
    """(conv, formatted, turns, loss_text): each conversation put together again from the segments on its path.

    Copies of a conversation are read once; every conversation then joins its path's result.
    """
    steps = chains.groupBy("leaf").agg(F.first("nodes").alias("nodes")).select("leaf", F.posexplode(F.transform("nodes", lambda n: n["key"])).alias("depth", "key"))
    parts = steps.join(segments.select("key", "text", "loss_start", "loss_end"), "key")
    entry = F.struct("depth", "text", "loss_start", "loss_end")
    paths = parts.groupBy("leaf").agg(F.array_sort(F.collect_list(entry)).alias("parts"))
    formatted = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    loss = F.array_join(F.transform("parts", lambda p: unescape(F.substr(p["text"], p["loss_start"] + 1, p["loss_end"] - p["loss_start"]))), "")

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        role = F.substr(head, F.lit(len(START) + 1), F.length(head))
        text = F.substr(piece, F.length(head) + 2, F.length(piece))
        return F.struct(unescape(role, role=True).alias("role"), unescape(text).alias("text"))

    pieces = F.split(F.col("formatted"), r"<\|im_end\|>\n")
    turns = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)
    paths = durable(paths.select("leaf", formatted.alias("formatted"), loss.alias("loss_text")).withColumn("turns", turns))
    return chains.select("conv", "leaf").join(paths, "leaf").drop("leaf")
