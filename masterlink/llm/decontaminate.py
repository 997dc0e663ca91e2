"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

First, one pass over the corpus counts in how many documents each n-gram of the test items occurs. All that occur are
seeds, common ones too: an edit may leave a copy no other n-gram, so each copied run of n words holds a seed however
common the item is in the corpus. A second pass finds seeds in each document; around the hits, the document's words are
aligned with the item's words by Smith-Waterman. An item counts as leaked into a document if the best local alignment
reaches `threshold` of the score of a whole verbatim copy. Case and punctuation don't count. An item with fewer than n words
is one seed as a whole, so it is found where all its words stand side by side.

Each document is handled where it is read: texts are never shuffled, and no common n-gram or passage gathers rows.
The test items' n-grams are sent to all executors in blocks of bounded size; a larger benchmark takes more blocks.

Edge cases: null or empty texts and items match nothing; null keys of documents or items are reported as they are; very long
texts are read whole, one slice at a time; of alignments with equal scores, the first in the text is reported; repeated
documents or items (rows) are each reported; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masterlink.llm.common import NOT_ALNUM, Words, buffer_of, grams, slices, small_batches, string_array


@dataclass(frozen=True)
class LeakParams:
    n: int = 3
    threshold: float = 0.5
    match: float = 2.0
    mismatch: float = -1.0
    gap: float = -1.0
    #: Bytes of test items that are sent to the executors at once.
    block_bytes: int = 8 << 20


class Benchmark:
    """Word hashes of a block of test items and where each n-gram stands in them."""

    def __init__(self, items: list[tuple[int, str]], params: LeakParams):
        self.params, self.ids = params, [i for i, _ in items]
        texts = pa.array([t for _, t in items], pa.large_string())
        self.words: list[np.ndarray] = []
        data, offsets = buffer_of(texts)
        for i, j in slices(offsets):
            w = Words(data, offsets, i, j, NOT_ALNUM)
            self.words += [w.hash[w.first[d] : w.first[d + 1]] for d in range(j - i)]
        #: Lengths of seeds: an item with fewer than n words is one seed, all of it.
        self.lengths = sorted({min(params.n, len(w)) for w in self.words if len(w)})
        grams_of = [grams(w, max(1, min(params.n, len(w)))) for w in self.words]
        self.grams = np.unique(np.concatenate([np.zeros(0, np.uint64), *grams_of]))
        self.grams_of = grams_of

    def seeds(self, counts: np.ndarray) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
        """The sorted seed hashes and for each its (item, position) pairs, given each n-gram's document count."""
        places: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for item, g in enumerate(self.grams_of):
            for p in np.flatnonzero(counts[np.searchsorted(self.grams, g)] > 0).tolist():
                places[int(g[p])].append((item, p))
        keys = sorted(places)
        return np.array(keys, dtype=np.uint64), [places[k] for k in keys]


def find_in(sorted_keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the values that are among the keys, and which key each is."""
    if not len(sorted_keys) or not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # A small table of the top bits spares most values the binary search.
    top = np.zeros(1 << 16, dtype=bool)
    top[sorted_keys >> np.uint64(48)] = True
    at = np.flatnonzero(top[values >> np.uint64(48)])
    key = np.minimum(np.searchsorted(sorted_keys, values[at]), len(sorted_keys) - 1)
    same = sorted_keys[key] == values[at]
    return at[same], key[same]


def hits_of(sorted_keys: np.ndarray, words: Words, lengths: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of seeds, the words where a seed among the keys begins within a document, and which key it is."""
    for n in lengths:
        at, key = find_in(sorted_keys, grams(words.hash, n))
        inside = words.doc[at] == words.doc[at + n - 1]
        yield at[inside], key[inside]


def smith_waterman(item: np.ndarray, text: np.ndarray, params: LeakParams) -> tuple[float, int]:
    """The best local score and the text position where it ends, one row per item word, whole rows at a time."""
    ramp = np.arange(1, len(text) + 1) * -params.gap
    row = np.zeros(len(text) + 1)
    best, end = 0.0, 0
    for word in item:
        diagonal = row[:-1] + np.where(text == word, params.match, params.mismatch)
        x = np.maximum(np.maximum(diagonal, row[1:] + params.gap), 0.0)
        row[1:] = np.maximum.accumulate(x + ramp) - ramp
        k = int(row.argmax())
        if row[k] > best:
            best, end = float(row[k]), k
    return best, end


def align(text: np.ndarray, hits: list[tuple[int, int]], item: np.ndarray, params: LeakParams) -> tuple[float, int, int] | None:
    """The best alignment (share of the full score, first word, end word) near hits of (text place, item place)."""
    size, full = len(item), params.match * len(item)
    spans: list[list[int]] = []
    for at, place in sorted(hits):
        lo, hi = max(0, at - place - size // 2), min(len(text), at - place + size + size // 2 + 1)
        if spans and lo <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], hi)
        else:
            spans.append([lo, hi])
    best = None
    known = np.sort(item)
    for lo, hi in spans:
        part = text[lo:hi]
        # No alignment can score more than the item's words that occur here at all.
        if len(find_in(np.sort(part), known)[0]) * params.match < params.threshold * full:
            continue
        score, end = smith_waterman(item, part, params)
        if score >= params.threshold * full and (best is None or score > best[0]):
            _, back = smith_waterman(item[::-1], part[:end][::-1], params)
            best = score, lo + end - back, lo + end
    return None if best is None else (best[0] / full, best[1], best[2])


def flag_leaks(docs: DataFrame, items: DataFrame, params: LeakParams = LeakParams(), text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all, by default) of every row with leaks: array<struct<item, score, first_word, end_word>>.

    The word places count the text's runs of letters and digits. An existing column named leaks is replaced.
    """
    keep = [c for c in (keep if keep is not None else docs.columns) if c != "leaks"]
    named = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).filter(F.length("text") > 0)
    size = named.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size")).head()["size"]
    blocks = -(-size // params.block_bytes) or 1
    kind = f"array<struct<item:{named.schema['item'].dataType.simpleString()},score:double,first_word:bigint,end_word:bigint>>"
    rows = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(text_col).alias("__text"), F.array().cast(kind).alias("leaks"))
    for k in range(blocks):
        own = named.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        bench = Benchmark([(r["item"], r["text"]) for r in own.orderBy("item", "text").collect()], params)
        rows = _flag_block(rows, docs.select(F.col(text_col).alias("text")), bench)
    return rows.drop("__text")


def find_leaks(docs: DataFrame, items: DataFrame, params: LeakParams = LeakParams(), id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id_col, item_col, leak_score, first_word, end_word) of every item leaked into a document."""
    found = flag_leaks(docs, items, params, text_col, item_col, item_text_col, keep=[id_col]).select(id_col, F.explode("leaks").alias("l"))
    return found.select(id_col, F.col("l.item").alias(item_col), F.col("l.score").alias("leak_score"), "l.first_word", "l.end_word")


def _flag_block(rows: DataFrame, texts: DataFrame, bench: Benchmark) -> DataFrame:
    spark, params, keys, lengths = rows.sparkSession, bench.params, bench.grams, bench.lengths
    shared_keys = spark.sparkContext.broadcast(keys)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, total = shared_keys.value, None
        for b in batches:
            data, offsets = buffer_of(string_array(b.column(0)))
            for i, j in slices(offsets):
                w = Words(data, offsets, i, j, NOT_ALNUM)
                for at, key in hits_of(keys, w, lengths):
                    pairs = np.unique(w.doc[at] * len(keys) + key)
                    total = (0 if total is None else total) + np.bincount(pairs % max(1, len(keys)), minlength=len(keys))
        if total is not None and (some := np.flatnonzero(total)).size:
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["key", "n"])

    counted = np.zeros(len(keys), dtype=np.int64)
    # As many rows as the block has n-grams, at most.
    for r in small_batches(texts).mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow().to_pylist():
        counted[r["key"]] = r["n"]
    shared = spark.sparkContext.broadcast((bench.ids, bench.words, *bench.seeds(counted)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, words, seeds, places = shared.value
        for b in batches:
            leaks = b.column(b.num_columns - 1).to_pylist()
            data, offsets = buffer_of(string_array(b.column(b.num_columns - 2)))
            for i, j in slices(offsets):
                w = Words(data, offsets, i, j, NOT_ALNUM)
                hits: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
                for at, key in hits_of(seeds, w, lengths):
                    for p, k in zip(at.tolist(), key.tolist(), strict=True):
                        d = int(w.doc[p])
                        for item, place in places[k]:
                            hits[d, item].append((p - int(w.first[d]), place))
                for (d, item), near in sorted(hits.items()):
                    best = align(w.hash[w.first[d] : w.first[d + 1]], near, words[item], params)
                    if best:
                        leaks[i + d].append({"item": ids[item], "score": best[0], "first_word": best[1], "end_word": best[2]})
            last = b.schema.field(b.num_columns - 1).type
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(leaks, last)], names=b.schema.names)

    return small_batches(rows).mapInArrow(search, rows.schema)
