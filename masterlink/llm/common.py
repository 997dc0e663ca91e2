"""Shared helpers: table access, durable cuts of lineage, bounded samples and vectorised word hashing.

Word hashing works on whole Arrow string buffers: one prefix sum of a polynomial over the bytes gives the hash of
every word by a subtraction, so no Python code runs per character or per word.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from masterlink.plans.durable import durable as durable

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
#: Random 64-bit value for each byte; fixed by the seed, so hashes agree on all executors.
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: For comparisons that ignore punctuation: all ASCII bytes but letters and digits part words.
NOT_ALNUM = np.ones(256, dtype=bool)
NOT_ALNUM[128:] = NOT_ALNUM[48:58] = NOT_ALNUM[65:91] = NOT_ALNUM[97:123] = False
SLICE_BYTES = 1 << 20
_pow: np.ndarray | None = None
_ipow: np.ndarray | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame, limit: int = 8 << 20, rows: int = 128) -> DataFrame:
    """The DataFrame, after lowering the session's limits on batches of rows to those of operators over long texts.

    Long texts would otherwise fill Arrow batches of 64 MB, several times over in the JVM and in Python, and column vectors
    of 4,096 texts, which the JVM's heap holds as single objects of many MB and grows for.
    """
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", limit), ("spark.sql.parquet.columnarReaderBatchSize", rows)):
        if not (now := conf.get(key)).rstrip("b").isdigit() or int(now.rstrip("b")) > most:
            conf.set(key, str(most))
    return df


def sized_side(df: DataFrame, rows: int) -> DataFrame:
    """The DataFrame as a side of a join: broadcast if it has that many rows at most, else hashed in shuffled parts."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df.hint("shuffle_hash")


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of steps that are done, instead of when the driver's memory happens to fill.

    Files go once the driver has no reference to their plans; a large shuffle would else stay beside the next ones.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def hash_fraction(col: Column, seed: int) -> Column:
    """A number from 0 to 1 fixed by the value and the seed; null counts as a value."""
    return (F.xxhash64(F.lit(seed), col).bitwiseAND(F.lit((1 << 53) - 1))) / F.lit(float(1 << 53))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _ipow
    if _pow is None or len(_pow) < n:
        size = max(n, SLICE_BYTES + (SLICE_BYTES >> 2))
        both = []
        for base in (_BASE, _INV):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            both.append(np.multiply.accumulate(x))
        _pow, _ipow = both
    return _pow, _ipow


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that all bits depend on all input bits."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def string_array(col: pa.ChunkedArray | pa.Array) -> pa.Array:
    """One large_string array without nulls (null becomes the empty text)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col.cast(pa.large_string()).fill_null("")


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the n + 1 offsets of a large_string array."""
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of about limit bytes; a longer document stands alone."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Words:
    """Words of documents i..j: 64-bit hash, document (from 0), first and end byte in the slice's bytes.

    A-Z count as a-z; `parting` tells which bytes part words (by default white space).
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, i: int, j: int, parting: np.ndarray = _SPACE):
        lo, hi = int(offsets[i]), int(offsets[j])
        raw = _LOWER[data[lo:hi]]
        n = len(raw)
        self.bounds = offsets[i : j + 1] - lo
        pw, ipw = powers(n + 1)
        gap = np.ones(n + 2, dtype=bool)
        gap[1:-1] = parting[raw]
        first = np.zeros(n + 1, dtype=bool)
        first[self.bounds] = True
        word = ~gap[1:-1]
        begins = word & (gap[:-2] | first[:-1])
        ends = word & (gap[2:] | first[1:])
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[raw] * pw[:n], out=sums[1:])
        self.hash = mix((sums[self.end] - sums[self.start]) * ipw[self.start] + (self.end - self.start).astype(np.uint64))
        self.first = np.searchsorted(self.start, self.bounds)  # word index where each document begins
        self.doc = np.repeat(np.arange(j - i), np.diff(self.first))


_MUL = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9C6E6877736C46E3], dtype=np.uint64)


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words of one hash array (across documents as well; the caller cuts)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(m, n, dtype=np.uint64)
    for k in range(n):
        h += mix(words[k : k + m] ^ _MUL[k % 8]) * (_MUL[(k + 3) % 8] + U64(2 * k))
    return mix(h)


def shingle_sets(words: Words, n: int = 5) -> Iterator[np.ndarray]:
    """For each document the sorted distinct shingles; fewer than n words are one shingle, none are no shingle."""
    g = grams(words.hash, n)
    first = words.first
    for d in range(len(first) - 1):
        a, b = int(first[d]), int(first[d + 1])
        if b - a >= n:
            s = np.sort(g[a : b - n + 1])
            yield s[np.concatenate(([True], s[1:] != s[:-1]))]
        elif b > a:
            yield grams(words.hash[a:b], b - a) ^ U64(0x5DEECE66D)
        else:
            yield np.zeros(0, np.uint64)
