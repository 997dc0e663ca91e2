"""N-gram Jaccard join: size-banded tiles, hashed bitmaps, exact intersections.

Two texts are linked when their sets of distinct word n-grams have Jaccard similarity of at least num / den. Every link
between different sets is found:

1. A text's set gets a class id (64 bits of its size and a hash of it); equal sets are one class from here on.
2. Hash ranges of all shingles meet in one task each, as packed arrays, and find the shingles that two or more classes
   share. A class that shares less than the needed part of its set has no partner and is done; most texts end here.
   A shingle that is common within one slice of the input travels as one count for the slice, not once for each class.
3. What remains keeps its shared shingles. First tiles: classes of one size band and one leading token, the first of a set
   in the order of a hash, are compared in bounded pieces, skipping pairs that are connected already. These links connect
   most of a family of copies, but decide nothing alone.
4. All tiles: by the prefix principle, a linked pair shares a shingle among each set's first size - needed + 1 ones
   in the order of rarity. Prefix shingles held under different labels form tiles by size band, with the band below as
   guests; tiles are compared inside one task, in pieces of bounded size, and give only pairs that are not connected yet.
   A tile with more such pairs than rows, as large families of near copies make, gives no more than a tree of them: the
   classes that such trees connect meet with their sets, are compared there, and give one link for each group they join.
5. Pairs are compared by bitmaps first: each shingle flips one of 512 bits, so the bits in which two bitmaps differ are
   at most the set's symmetric difference, which bounds the overlap from above. Sorted arrays of the rest are intersected.
6. Connected components over the verified links; copies join through their class.

Edge cases: null texts and texts without words have an empty set and are linked with nothing; a text with fewer than n
words has one shingle, the whole sequence; very long texts are hashed whole; repeated rows are copies; null keys are kept
and never become a component's id unless all of the component's are null; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masterlink.llm.common import U64, Words, buffer_of, durable, mix, shingle_sets, slices, small_batches, string_array
from masterlink.operators.graph import connected_components

BITS = 512


@dataclass(frozen=True)
class JaccardParams:
    n: int = 5
    num: int = 75
    den: int = 100
    #: Shingles that one task compares in step 2, on average.
    range_shingles: int = 2_000_000
    #: Bytes of text in a slice, and classes of a slice from which a shingle is counted there instead of listed.
    slice_bytes: int = 8 << 20
    common: int = 32
    #: Bytes of text from which on slices and ranges grow with the input, and how many times at most.
    growth_bytes: float = 256e9
    most_growth: float = 4.0
    #: Leading tokens by which first tiles are formed, and rows of a tile before it is split.
    keys: int = 2
    run_rows: int = 2000
    #: Bytes of sets in a piece of a cluster of dense tiles.
    piece_bytes: int = 16 << 20


def doc_sets(texts: pa.Array, n: int, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of documents: range, all sorted sets one after another, their sizes and class ids."""
    data, offsets = buffer_of(texts)
    for i, j in slices(offsets, limit):
        sets: list[np.ndarray] = []
        for a, b in slices(offsets[i : j + 1]):
            sets += shingle_sets(Words(data, offsets, i + a, i + b), n)
        size = np.array([len(s) for s in sets], dtype=np.int64)
        flat = np.concatenate([np.zeros(0, np.uint64), *sets])
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(flat ^ U64(0x51ED270B)), dtype=np.uint64)))
        end = np.cumsum(size)
        cls = mix((sums[end] - sums[end - size]) ^ (size.astype(np.uint64) * U64(0x9E3779B97F4A7C15))).view(np.int64)
        yield i, j, flat, size, cls


def doc_classes(rows: DataFrame, params: JaccardParams) -> DataFrame:
    """(id, n_shingles, cls) of rows (id, text); cls is null for an empty set."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [(size, cls) for _, _, _, size, cls in doc_sets(string_array(b.column(1)), params.n, params.slice_bytes)]
            size = np.concatenate([np.zeros(0, np.int64), *(p[0] for p in parts)])
            cls = np.concatenate([np.zeros(0, np.int64), *(p[1] for p in parts)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size), pa.array(cls, mask=size == 0)], names=["id", "n_shingles", "cls"])

    return small_batches(rows).select("id", "text").mapInArrow(apply, f"id {rows.schema['id'].dataType.simpleString()}, n_shingles long, cls long")


PACKED = "part long, slice long, cls binary, size binary, counts binary, tokens binary, common binary, common_n binary"
_NAMES = ["part", "slice", "cls", "size", "counts", "tokens", "common", "common_n"]
_KINDS = (np.int64, np.int32, np.uint16, None, np.uint64, np.int32)


def _row(part: int, piece: int, cls=(), size=(), counts=(), tokens=b"", common=(), common_n=()) -> list:
    counts = np.asarray(counts, dtype=np.int64)
    if len(counts) and counts.max() > 0xFFFF:  # a class with more shingles stands several times
        times = np.maximum(1, -(-counts // 0xFFFF))
        whole = np.repeat(counts, times)
        at = np.arange(len(whole)) - np.repeat(np.cumsum(times) - times, times)
        cls, size = np.repeat(cls, times), np.repeat(size, times) if len(size) else size
        counts = np.minimum(0xFFFF, whole - at * 0xFFFF)
    return [part, piece, *(x if isinstance(x, bytes) else np.asarray(x).astype(k).tobytes() for x, k in zip((cls, size, counts, tokens, common, common_n), _KINDS, strict=True))]


def _batch(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64()] + [pa.binary()] * 6
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(8)], names=_NAMES)


def pack_shingles(rows: DataFrame, ranges: int, params: JaccardParams) -> DataFrame:
    """PACKED rows: for each slice and hash range, the slice's classes with their shingles in that range.

    The sizes of a slice's classes and the listing of its common shingles go past the ranges, in a row whose part is at
    least `ranges`; the ranges only get the common shingles' counts.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        piece = TaskContext.get().partitionId() << 20
        for b in batches:
            for _, _, flat, size, cls in doc_sets(string_array(b.column(0)), params.n, params.slice_bytes):
                keep = np.zeros(len(cls), dtype=bool)
                keep[np.unique(cls, return_index=True)[1]] = True  # a copy in the slice adds nothing
                keep &= size > 0
                own = np.repeat(np.arange(len(cls)), size)
                inside = keep[own]
                tokens, own = flat[inside], own[inside]
                piece += 1
                order = np.argsort(tokens, kind="stable")
                tokens, own = tokens[order], own[order]
                fresh = np.flatnonzero(np.concatenate((np.ones(min(1, len(tokens)), bool), tokens[1:] != tokens[:-1])))
                count = np.diff(np.append(fresh, len(tokens)))
                frequent = count >= params.common
                listed = np.repeat(frequent, count)
                common, common_n = tokens[fresh[frequent]], count[frequent]
                # The top bits choose the range; all bits tell shingles apart.
                part_of = lambda t: ((t >> U64(32)) * U64(ranges) >> U64(32)).astype(np.int64)
                out: list[list] = []
                t, o = tokens[listed], own[listed]
                by_doc = np.argsort(o, kind="stable")
                out.append(_row(ranges + piece % ranges, piece, cls[keep], size[keep], np.bincount(o, minlength=len(cls))[keep], t[by_doc].tobytes()))
                t, o = tokens[~listed], own[~listed]
                cuts = np.searchsorted(part_of(t), np.arange(ranges + 1))
                common_cuts = np.searchsorted(part_of(common), np.arange(ranges + 1))
                for part in range(ranges):
                    tt, oo = t[cuts[part] : cuts[part + 1]], o[cuts[part] : cuts[part + 1]]
                    c = slice(common_cuts[part], common_cuts[part + 1])
                    if len(tt) or c.start < c.stop:
                        by_doc = np.argsort(oo, kind="stable")
                        docs, n = np.unique(oo[by_doc], return_counts=True)
                        out.append(_row(part, piece, cls[docs], (), n, tt[by_doc].tobytes(), common[c], common_n[c]))
                    if len(out) >= 16:
                        yield _batch(out)
                        out = []
                if out:
                    yield _batch(out)

    return small_batches(rows).select("text").mapInArrow(apply, PACKED)


def shared_shingles(packed: DataFrame, ranges: int) -> DataFrame:
    """PACKED rows back to the slices: only shared shingles, with class counts in common_n.

    Rows with `common` give the counts of the slice's common shingles; the slice has their listing.
    """

    def apply(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        if rows[0]["part"] >= ranges:
            return group.select(_NAMES)
        cls = [np.frombuffer(r["cls"], np.int64) for r in rows]
        counts = [np.frombuffer(r["counts"], np.uint16) for r in rows]
        tokens = [np.frombuffer(r["tokens"], np.uint64) for r in rows]
        common = [np.frombuffer(r["common"], np.uint64) for r in rows]
        t = np.concatenate(tokens)
        owner = np.repeat(np.concatenate(cls), np.concatenate(counts))
        order = np.argsort(t, kind="stable")
        ts, os_ = t[order], owner[order]
        # Classes per shingle; copies of a class in several slices count once.
        begin = np.concatenate((np.ones(min(1, len(ts)), bool), ts[1:] != ts[:-1]))
        group_no = np.cumsum(begin) - 1
        many = np.bincount(group_no, minlength=1)[group_no] > 1 if len(ts) else np.zeros(0, bool)
        number = np.zeros(int(group_no[-1]) + 1 if len(ts) else 0, dtype=np.int64)
        pairs = np.lexsort((os_[many], group_no[many]))
        g, o = group_no[many][pairs], os_[many][pairs]
        distinct = np.concatenate((np.ones(min(1, len(g)), bool), (g[1:] != g[:-1]) | (o[1:] != o[:-1])))
        number += np.bincount(g[distinct], minlength=len(number))
        extra = np.concatenate([np.zeros(0, np.uint64), *common])
        extra_n = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r["common_n"], np.int32) for r in rows)])
        unique = ts[begin]
        if len(extra):
            keys, inverse = np.unique(extra, return_inverse=True)
            sums = np.bincount(inverse, weights=extra_n).astype(np.int64)
            at = np.searchsorted(unique, keys)
            known = (at < len(unique)) & (unique[np.minimum(at, max(0, len(unique) - 1))] == keys) if len(unique) else np.zeros(len(keys), bool)
            alone = np.bincount(group_no, minlength=len(number))[at[known]] if len(ts) else np.zeros(0, int)
            number[at[known]] = np.maximum(number[at[known]], np.minimum(alone, 1)) + sums[known]
            light = np.zeros(len(keys), dtype=np.int64)
            light[known] = number[at[known]] - sums[known]
            total = sums + light
        back = np.empty(len(ts), dtype=np.int64)
        back[order] = number[group_no]
        out, lo = [], 0
        for r, c, n, x in zip(rows, cls, counts, common, strict=True):
            hi = lo + int(n.sum(dtype=np.int64))
            own, tt, lo = back[lo:hi], t[lo:hi], hi
            shared = own >= 2
            kept = np.add.reduceat(np.append(shared, 0).astype(np.int64), np.concatenate(([0], np.cumsum(n, dtype=np.int64)[:-1])))[: len(n)] if len(n) else np.zeros(0, int)
            common_n = total[np.searchsorted(keys, x)] if len(x) else np.zeros(0, np.int64)
            has = kept > 0
            # Counts of the tokens, then of the common ones.
            row = _row(r["part"], r["slice"], c[has], (), kept[has], tt[shared].tobytes(), x, np.concatenate((own[shared], common_n)))
            if shared.any() or len(x):
                out.append(row)
        return pa.Table.from_batches([_batch(out)])

    return packed.groupBy("part").applyInArrow(apply, PACKED)


KEPT = "cls long, size long, tokens binary, prefix array<long>, bitmap binary, keys array<long>"


def kept_classes(shared: DataFrame, ranges: int, params: JaccardParams) -> DataFrame:
    """KEPT rows of the classes that share enough of their set; one per class and slice."""

    def apply(group: pa.Table) -> pa.Table:
        cls, token, number, listings = [], [], [], []
        known: dict[int, int] = {}
        for r in group.to_pylist():
            c, n = np.frombuffer(r["cls"], np.int64), np.frombuffer(r["counts"], np.uint16)
            t = np.frombuffer(r["tokens"], np.uint64)
            if r["part"] >= ranges:
                listings.append((c, np.frombuffer(r["size"], np.int32), n, t))
                continue
            df = np.frombuffer(r["common_n"], np.int32)
            cls.append(np.repeat(c, n))
            token.append(t)
            number.append(df[: len(t)])
            known.update(zip(np.frombuffer(r["common"], np.uint64).tolist(), df[len(t) :].tolist(), strict=True))
        keys = np.array(sorted(known), dtype=np.uint64)
        df_of = np.array([known[k] for k in keys.tolist()], dtype=np.int64)
        for c, _, n, t in listings:
            cls.append(np.repeat(c, n))
            token.append(t)
            number.append(df_of[np.searchsorted(keys, t)] if len(t) else np.zeros(0, np.int64))
        all_cls, all_size = (np.concatenate([np.zeros(0, np.int64), *x]) for x in ([x[0] for x in listings], [x[1] for x in listings]))
        sorted_cls = np.argsort(all_cls, kind="stable")
        c, t, df = (np.concatenate([np.zeros(0, k), *x]) for x, k in ((cls, np.int64), (token, np.uint64), (number, np.int64)))
        s = all_size[sorted_cls][np.searchsorted(all_cls[sorted_cls], c)] if len(c) else np.zeros(0, np.int64)
        order = np.argsort(c, kind="stable")
        c, s, t, df = c[order], s[order], t[order], df[order]
        begin = np.flatnonzero(np.concatenate((np.ones(min(1, len(c)), bool), c[1:] != c[:-1])))
        end = np.append(begin[1:], len(c))
        need = -(-params.num * s[begin].astype(np.int64) // params.den)
        out: list[tuple] = []
        for k in np.flatnonzero(end - begin >= need):
            a, b, n = int(begin[k]), int(end[k]), int(s[begin[k]])
            rare = np.lexsort((t[a:b], df[a:b]))
            unique = n - (b - a)  # shingles of no other class come first in the order and match nothing
            prefix = t[a:b][rare[: max(0, n - int(need[k]) + 1 - unique)]]
            tokens = np.sort(t[a:b])
            keys = [int(mix(tokens ^ U64(0xA5A5 + 7919 * r)).min().view(np.int64)) for r in range(params.keys)]
            out.append((int(c[a]), n, tokens.tobytes(), prefix.view(np.int64), bitmap(tokens).tobytes(), keys))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64())]
        return pa.table([pa.array([x[i] for x in out], kinds[i]) for i in range(6)], names=["cls", "size", "tokens", "prefix", "bitmap", "keys"])

    found = shared.groupBy("slice").applyInArrow(apply, KEPT)
    names = ["size", "tokens", "prefix", "bitmap", "keys"]
    return found.groupBy("cls").agg(*(F.first(c).alias(c) for c in names))


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """BITS bits as uint64; each token flips one."""
    odd = np.bincount((mix(tokens) >> U64(20)).astype(np.int64) % BITS, minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """The intersection's size of two sorted arrays of distinct values."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def enough(common, size_a, size_b, params: JaccardParams):
    """Whether so many common shingles reach the similarity."""
    return params.den * common >= params.num * (size_a + size_b - common)


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], names: tuple[str, ...]) -> Iterator[list[list]]:
    """Columns `names` of runs of rows with equal keys, over batch borders; one run is held at a time."""
    run, held = None, []
    for b in batches:
        columns = [b.column(n).to_pylist() for n in (*keys, *names)]
        for row in zip(*columns, strict=True):
            if row[: len(keys)] != run:
                if held:
                    yield [list(c) for c in zip(*held, strict=True)]
                run, held = row[: len(keys)], []
            held.append(row[len(keys) :])
    if held:
        yield [list(c) for c in zip(*held, strict=True)]


def bound_of(bits: np.ndarray, lengths: np.ndarray, k: int, others: slice) -> np.ndarray:
    """Upper bounds of the overlap of row k and the others: differing bits count differing tokens at least once."""
    return (lengths[others] + lengths[k] - np.bitwise_count(bits[others] ^ bits[k]).sum(1, dtype=np.int64)) // 2


def overlaps(a: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """The intersections' sizes of a sorted array of distinct values with others."""
    flat, length = np.concatenate(others), np.array([len(x) for x in others])
    at = np.searchsorted(a, flat)
    at[at == len(a)] = 0
    hits = np.concatenate(([0], np.cumsum(a[at] == flat)))
    end = np.cumsum(length)
    return hits[end] - hits[end - length]


def connect(root: np.ndarray, arrays: list[np.ndarray], bits: np.ndarray, sizes: np.ndarray, pieces: np.ndarray | None, params: JaccardParams) -> None:
    """Joins groups of rows in `root` (a row of each row's group) until no link between two groups is left.

    Rows are in the order of their sizes. With pieces, only rows of different ones are compared.
    """
    lengths = np.array([len(x) for x in arrays])
    for k in range(1, len(root)):
        lo = int(np.searchsorted(sizes[:k], -(-params.num * int(sizes[k]) // params.den)))
        fits = enough(bound_of(bits, lengths, k, slice(lo, k)), sizes[lo:k], sizes[k], params)
        if pieces is not None:
            fits &= pieces[lo:k] != pieces[k]
        left, step = lo + np.flatnonzero(fits), 1
        while (left := left[root[left] != root[k]]).size:
            some, left = left[:step], left[step:]
            for j in some[enough(overlaps(arrays[k], [arrays[j] for j in some]), sizes[some], sizes[k], params)]:
                if root[j] != root[k]:
                    root[root == root[k]] = root[j]
            step = min(4 * step, 256)


def leading_tiles(kept: DataFrame, params: JaccardParams) -> DataFrame:
    """Links (a, b) found in tiles of a leading token and size band: each class and the root of its group in a tile.

    A class's leading token is the first of its set in the order of a hash, one order for each key. A tile compares each
    class with those before it that are not connected to it yet. Large tiles are split at random, by another choice for
    each key, so that the pieces of one key meet in another; bands, too, begin elsewhere for each key.
    """
    rows = kept.select("cls", "size", "tokens", "bitmap", F.posexplode("keys").alias("which", "key"))
    rows = rows.withColumn("band", band(F.col("size"), params, F.col("which") / params.keys))
    large = rows.groupBy("which", "key", "band").agg(F.count("*").alias("n")).filter(F.col("n") > params.run_rows)
    rows = rows.join(large, ["which", "key", "band"], "left")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("cls", "which"), F.coalesce(F.ceil(F.col("n") / params.run_rows), F.lit(1)))).drop("n")
    rows = rows.repartition("which", "key", "band", "salt").sortWithinPartitions("which", "key", "band", "salt", "size", "cls")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cls, size, tokens, bits in sorted_runs(batches, ("which", "key", "band", "salt"), ("cls", "size", "tokens", "bitmap")):
            if len(cls) < 2:
                continue
            arrays = [np.frombuffer(t, np.uint64) for t in tokens]
            bits = np.frombuffer(b"".join(bits), np.uint64).reshape(-1, BITS // 64)
            root = np.arange(len(cls))
            connect(root, arrays, bits, np.array(size), None, params)
            moved = np.flatnonzero(root != np.arange(len(cls)))
            if len(moved):
                ids = np.array(cls)
                yield pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[root[moved]])], names=["a", "b"])

    return rows.mapInArrow(apply, "a long, b long")


def in_pieces(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows with `pieces`, dealt by keys and each pair p <= q of pieces, in the order of size."""
    rows = rows.withColumn("piece", F.pmod(F.xxhash64("cls"), F.col("pieces")).cast("int"))
    other = F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda t: F.struct(F.least("piece", t).alias("p"), F.greatest("piece", t).alias("q")))
    rows = rows.select(*keys, *columns, "piece", F.inline(other))
    return rows.repartition(*keys, "p", "q").sortWithinPartitions(*keys, "p", "q", "size", "cls")


def tile_pairs(postings: DataFrame, params: JaccardParams) -> DataFrame:
    """Pairs (a, b, dense) of classes of different groups that meet in a tile and whose bitmaps allow a link.

    A tile holds the classes of one token and size band, and, marked as guests, those of the band below. A large tile is
    cut into pieces, and pairs of pieces are compared; a task holds two pieces. Where a tile has more pairs than rows, it is
    dense: it gives only as many pairs as connect the classes of all of its pairs.
    """
    guests = postings.withColumn("band", F.col("band") + 1).withColumn("guest", F.lit(True))
    rows = postings.withColumn("guest", F.lit(False)).unionByName(guests)
    sizes = rows.groupBy("token", "band").agg(F.count("*").alias("n"), F.count_if(~F.col("guest")).alias("own"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    sizes = sizes.filter("n > 1 AND own > 0 AND lo < hi").select("token", "band", F.ceil(F.col("n") / params.run_rows).cast("int").alias("pieces"))
    rows = in_pieces(rows.join(sizes, ["token", "band"]), ["token", "band"], ["cls", "size", "label", "bitmap", "length", "guest"])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Pairs that this task has given already, and groups that its dense pairs connect; forgetting some only repeats them.
        done: set[tuple[int, int]] = set()
        parent: dict[int, int] = {}

        def group(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = x = parent.get(up, up)
            return x

        for cls, size, label, bits, length, guest, piece, p, q in sorted_runs(batches, ("token", "band", "p", "q"), ("cls", "size", "label", "bitmap", "length", "guest", "piece", "p", "q")):
            ids, sizes, labels, lengths, guests, pieces = map(np.array, (cls, size, label, length, guest, piece))
            bits = np.frombuffer(b"".join(bits), np.uint64).reshape(-1, BITS // 64)
            root = np.arange(len(ids))
            first: list[tuple[int, int]] = []  # the tile's pairs, while it is not dense
            tree: list[tuple[int, int]] = []  # those that connect all
            number = 0
            for k in range(1, len(ids)):
                fits = enough(bound_of(bits, lengths, k, slice(0, k)), sizes[:k], sizes[k], params)
                fits &= (labels[:k] != labels[k]) & ~(guests[:k] & guests[k])
                if p[0] != q[0]:
                    fits &= pieces[:k] != pieces[k]
                found = np.flatnonzero(fits)
                number += len(found)
                if number <= len(ids):
                    first += [(int(j), k) for j in found]
                for r in np.unique(root[found]):
                    if r != root[k]:
                        tree.append((int(r), k))
                        root[root == root[k]] = r
            dense = number > len(ids)
            out: list[tuple[int, int]] = []
            for j, k in tree if dense else first:
                a, b = sorted((int(ids[j]), int(ids[k])))
                if dense and (x := group(a)) != (y := group(b)):
                    parent[x] = y
                    out.append((a, b))
                elif not dense and (a, b) not in done:
                    done.add((a, b))
                    out.append((a, b))
            if len(done) > 1_000_000:
                done.clear()
            if len(parent) > 1_000_000:
                parent.clear()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([dense] * len(out))], names=["a", "b", "dense"])

    return rows.mapInArrow(apply, "a long, b long, dense boolean").distinct()


def cluster_links(clusters: DataFrame, label: DataFrame, kept: DataFrame, params: JaccardParams) -> DataFrame:
    """Links (a, b) that connect all linked classes inside each of the clusters (node, component).

    A cluster's classes meet with their sets in one task, in pieces of bounded rows and bytes of which a task holds two.
    """
    sets = kept.select("cls", "size", "tokens", "bitmap").join(label.select("cls", "label"), "cls")
    rows = clusters.select(F.col("node").alias("cls"), F.col("component").alias("cluster"))
    bytes_of = rows.join(kept.select("cls", F.length("tokens").cast("long").alias("n")), "cls").groupBy("cluster").agg(F.count("*").alias("rows"), F.sum("n").alias("bytes"))
    pieces = bytes_of.select("cluster", F.ceil(F.greatest(F.col("rows") / params.run_rows, F.col("bytes") / params.piece_bytes)).cast("int").alias("pieces"))
    rows = in_pieces(small_batches(rows).join(pieces, "cluster").join(sets, "cls"), ["cluster"], ["cls", "size", "tokens", "bitmap", "label"])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cls, size, tokens, bits, label, piece, p, q in sorted_runs(batches, ("cluster", "p", "q"), ("cls", "size", "tokens", "bitmap", "label", "piece", "p", "q")):
            ids, arrays = np.array(cls), [np.frombuffer(t, np.uint64) for t in tokens]
            bits = np.frombuffer(b"".join(bits), np.uint64).reshape(-1, BITS // 64)
            _, first, which = np.unique(np.array(label), return_index=True, return_inverse=True)
            root = first[which]
            connect(root, arrays, bits, np.array(size), np.array(piece) if p[0] != q[0] else None, params)
            moved = first[root[first] != first]
            if len(moved):
                yield pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[root[moved]])], names=["a", "b"])

    return rows.mapInArrow(apply, "a long, b long")


def verify(pairs: DataFrame, kept: DataFrame, params: JaccardParams) -> DataFrame:
    """The pairs (a, b) of classes that are linked."""
    side = lambda s: kept.select(F.col("cls").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("size", "tokens", "bitmap")))
    rows = small_batches(pairs).join(side("a"), "a").join(side("b"), "b")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = {n: b.column(n) for n in b.schema.names}
            size_a, size_b = (col[f"size_{s}"].to_numpy(zero_copy_only=False) for s in "ab")
            bits = [np.frombuffer(b"".join(col[f"bitmap_{s}"].to_pylist()), np.uint64).reshape(-1, BITS // 64) for s in "ab"]
            tokens = [[np.frombuffer(x, np.uint64) for x in col[f"tokens_{s}"].to_pylist()] for s in "ab"]
            lengths = [np.array([len(x) for x in t], dtype=np.int64) for t in tokens]
            bound = (lengths[0] + lengths[1] - np.bitwise_count(bits[0] ^ bits[1]).sum(1, dtype=np.int64)) // 2
            good = [k for k in np.flatnonzero(enough(bound, size_a, size_b, params)) if enough(overlap(tokens[0][k], tokens[1][k]), size_a[k], size_b[k], params)]
            take = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([col["a"].take(take), col["b"].take(take)], names=["a", "b"])

    return rows.mapInArrow(apply, "a long, b long")


def band(size: Column, params: JaccardParams, shift: Column | float = 0.0) -> Column:
    """Linked sets lie in the same size band or in adjacent ones."""
    return F.floor(F.log(size) / F.log(F.lit(params.den / params.num)) + shift + 1e-9).cast("int")


def class_links(rows: DataFrame, params: JaccardParams) -> DataFrame:
    """Links (a, b) between different classes of rows (id, text) that connect all linked classes."""
    size = small_batches(rows).agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).head()["n"]
    # Slices times ranges is the number of packed rows: both get larger with the input, so that rows stay large.
    grow = min(params.most_growth, max(1.0, size / params.growth_bytes))
    params = replace(params, slice_bytes=int(params.slice_bytes * grow), range_shingles=int(params.range_shingles * grow))
    ranges = max(1, round(size / 6.2 / params.range_shingles))
    kept = durable(kept_classes(shared_shingles(pack_shingles(rows, ranges, params), ranges), ranges, params))
    links = durable(leading_tiles(kept, params))
    groups = connected_components(links).withColumnRenamed("node", "cls")
    label = kept.select("cls", "size", "prefix").join(groups, "cls", "left")
    postings = label.select("cls", "size", F.coalesce("component", "cls").alias("label"), F.explode("prefix").alias("token"))
    # Tokens held under one label only are done, whatever the number of their classes.
    mixed = postings.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("token")
    postings = postings.join(mixed, "token", "left_semi").withColumn("band", band(F.col("size"), params))
    bits = kept.select("cls", "bitmap", (F.length("tokens") / 8).cast("int").alias("length"))
    postings = durable(postings.join(bits, "cls"))
    pairs = durable(tile_pairs(postings, params))
    links = links.unionByName(verify(pairs.filter("NOT dense").select("a", "b"), kept, params))
    dense = pairs.filter("dense").select("a", "b")
    if not dense.limit(1).count():
        return links
    return links.unionByName(cluster_links(connected_components(dense), label.select("cls", F.coalesce("component", "cls").alias("label")), kept, params))


def jaccard_components(docs: DataFrame, params: JaccardParams = JaccardParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_shingles, component_id) of every row: the smallest key reachable over links, its own included."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    classes = durable(doc_classes(rows, params).hint("rebalance"))
    links = durable(class_links(rows.select("text"), params))
    groups = connected_components(links)
    least = classes.filter(F.col("cls").isNotNull()).groupBy("cls").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    least = least.join(groups.select(F.col("node").alias("cls"), "component"), "cls", "left")
    in_group = least.filter(F.col("component").isNotNull()).groupBy("component").agg(F.min("least").alias("group_least"))
    named = least.join(in_group, "component", "left").filter((F.col("n") > 1) | F.col("component").isNotNull())
    named = durable(named.select("cls", F.coalesce("group_least", "least").alias("component_id")))
    out = classes.join(named, "cls", "left")
    return out.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component_id", "id").alias("component_id"))
