"""Approximate nearest neighbours by inner product: inverted lists scanned with adaptive numbers of dimensions.

Vectors get one more component that makes all norms equal, so that the largest inner product is the least distance, and
are rotated by a random orthogonal matrix. Centroids are learned on a bounded sample; every vector is filed in the list
of its nearest centroid. A query probes the lists of its nearest centroids. Within a list, the rotated vectors stand in
column blocks: block after block adds to the candidates' partial distances, and a hypothesis test abandons candidates
whose partial distance, scaled up to all dimensions, lies significantly beyond the k-th best so far. What is left is
scored in double precision on the original vectors.

The number of lists grows with the root of the table; from some thousand on, centroids are learned and vectors filed in two
levels. Small lists go together and large ones, a hot one too, are cut, so that tiles hold about equally many vectors. Each
vector is sent once, to its tile; each query is sent to the tiles whose lists it probes, and streams past a tile's vectors
in blocks. Each pair of a tile and a query gives its own k best, and a last step merges them. Tiles get larger with the
table, up to a bound, so that queries are sent to a bounded number of tiles until then.

Vectors of different lengths have no inner product: queries of one length are answered from vectors of that length.

Edge cases: vectors that are null, zero, or hold null or non-finite components take no part; ties go to the smaller key; a
query is compared with all rows of other keys, so rows that repeat its key are left out with it (the one with the least
vector asks); with fewer than k candidates, all are returned; an empty table gives an empty result; null keys take no part;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from masterlink.llm.common import durable, hash_fraction


@dataclass(frozen=True)
class NeighbourParams:
    k: int = 20
    #: Vectors of the sample on which centroids are learned: so many, or four for each list if these are more; and rounds
    #: of k-means. The number of lists is the root of that of vectors; beyond the bound, lists get longer.
    sample_rows: int = 16_000
    rounds: int = 8
    max_lists: int = 65_536
    #: Lists from which on centroids have two levels, and upper ones among whose lists a vector's is sought.
    flat_lists: int = 2048
    tried: int = 4
    #: Share of the lists that a query probes, and candidates that they hold at least. Well-clustered vectors need a
    #: few hundredths; near-random ones, as those of the registered query, need over half for a recall of 0.9.
    probed_share: float = 0.65
    least_candidates: int = 400
    #: Vectors of a tile, about: a share of the table within bounds; and queries of a block.
    tile_share: float = 1 / 32
    tile_rows: int = 256
    most_tile: int = 65_536
    query_rows: int = 2048
    #: Dimensions of a column block and strictness of the test: the larger, the fewer wrongly abandoned.
    block: int = 16
    strictness: float = 2.1
    #: Share of candidates left from which on they go on one by one instead of as a matrix.
    sparse: float = 0.2
    seed: int = 5


def k_means(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """k centroids of the rows; fewer if there are fewer rows."""
    centroids = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds if len(x) > len(centroids) else 0):
        own = closest(x, centroids)
        n = np.bincount(own, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, x)
        full = n > 0
        centroids[full] = sums[full] / n[full][:, None]
    return centroids


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared, but for the rows' own norms."""
    return (centroids**2).sum(1) - 2 * x @ centroids.T


def closest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    step = max(1, (1 << 22) // len(centroids))
    return np.concatenate([np.zeros(0, np.int64), *(distances(x[a : a + step], centroids).argmin(1) for a in range(0, len(x), step))])


class Lists:
    """Rotation, centroids, in two levels if there are many, and the sizes of lists."""

    def __init__(self, sample: np.ndarray, n_lists: int, top_norm2: float, params: NeighbourParams):
        self.params, self.top = params, top_norm2
        rng = np.random.default_rng(params.seed)
        d = sample.shape[1] + 1
        q, r = np.linalg.qr(rng.normal(size=(d, d)))
        self.rotation = q * np.sign(np.diag(r))
        x = self.lifted(sample)
        self.coarse: np.ndarray | None = None
        if n_lists <= params.flat_lists:
            self.centroids = k_means(x, n_lists, params.rounds, rng)
        else:
            self.coarse = k_means(x, round(n_lists**0.5), params.rounds, rng)
            own = closest(x, self.coarse)
            parts = []
            for c in range(len(self.coarse)):
                inside = x[own == c] if (own == c).any() else self.coarse[c : c + 1]
                parts.append(k_means(inside, max(1, round(n_lists * len(inside) / len(x))), params.rounds, rng))
            self.centroids = np.concatenate(parts)
            #: Each coarse centroid's lists are those from one of these numbers up to the next.
            self.begin = np.cumsum([0, *(len(p) for p in parts)])
        self.sizes = np.zeros(len(self.centroids), dtype=np.int64)

    def lifted(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Rotated, with the component that gives rows (not queries) the same norm."""
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(0.0, self.top - (x * x).sum(1)))
        return np.column_stack((x, more)) @ self.rotation

    def nearest(self, x: np.ndarray) -> np.ndarray:
        if self.coarse is None:
            return closest(x, self.centroids)
        out, least = np.zeros(len(x), dtype=np.int64), np.full(len(x), np.inf)
        for a in range(0, len(x), 4096):
            part = slice(a, a + 4096)
            for upper in np.argsort(distances(x[part], self.coarse), axis=1)[:, : self.params.tried].T:
                for c in np.unique(upper):
                    rows = a + np.flatnonzero(upper == c)
                    far = distances(x[rows], self.centroids[self.begin[c] : self.begin[c + 1]])
                    own = far.argmin(1)
                    far = far[np.arange(len(rows)), own]
                    closer = far < least[rows]
                    out[rows[closer]] = self.begin[c] + own[closer]
                    least[rows[closer]] = far[closer]
        return out

    def probed(self, x: np.ndarray) -> list[np.ndarray]:
        out, least = [], max(1, round(self.params.probed_share * len(self.centroids)))
        step = max(1, (1 << 22) // len(self.centroids))
        for a in range(0, len(x), step):
            for row in np.argsort(distances(x[a : a + step], self.centroids), axis=1, kind="stable"):
                held = np.cumsum(self.sizes[row])
                out.append(row[: max(least, int(np.searchsorted(held, self.params.least_candidates)) + 1)])
        return out


def firsts(group: np.ndarray, k: int) -> np.ndarray:
    """Which of the sorted group numbers are among the first k of their group."""
    begin = np.flatnonzero(np.concatenate((np.ones(min(1, len(group)), bool), group[1:] != group[:-1])))
    return np.arange(len(group)) - np.repeat(begin, np.diff(np.append(begin, len(group)))) < k


def scan_tile(queries: np.ndarray, query_ids: np.ndarray, probes: list[np.ndarray], vectors: np.ndarray, ids: np.ndarray, own: np.ndarray, lists: Lists) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best (query number, vector number, score) of each query among the vectors of the lists that it probes.

    List after list, all its queries at once: column blocks add to a matrix of partial distances, in which the test
    abandons pairs; once few are left, these go on alone. A query's limit is its k-th best over the lists so far.
    """
    p, k = lists.params, lists.params.k
    x, qs = lists.lifted(vectors), lists.lifted(queries, query=True)
    d = x.shape[1]
    blocks = [slice(a, min(d, a + p.block)) for a in range(0, d, p.block)]
    q_norm = (queries * queries).sum(1)
    asks = np.repeat(np.arange(len(probes)), [len(x) for x in probes])
    wanted = np.concatenate([np.zeros(0, np.int64), *probes])
    top_score = np.full((len(queries), k), -np.inf)
    kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def limits(i: np.ndarray) -> np.ndarray:
        """Squared distance of the k-th best so far, with room for rounding."""
        return np.maximum(0.0, q_norm[i] + lists.top - 2 * top_score[i, 0]) * (1 + 1e-9) + 1e-9

    for number in np.unique(own):
        members, all_asking = np.flatnonzero(own == number), asks[wanted == number]
        chunk = max(1, 200_000 // len(members))
        for at in range(0, len(all_asking), chunk):
            asking = all_asking[at : at + chunk]
            limit = limits(asking)
            begin = members[: 2 * k]
            if not np.isfinite(limit).all() and len(begin) >= 2 * k:
                near = ((x[begin] ** 2).sum(1) - 2 * qs[asking] @ x[begin].T + (qs[asking] ** 2).sum(1)[:, None])
                near[ids[begin] == query_ids[asking][:, None]] = np.inf
                limit = np.minimum(limit, np.partition(near, k - 1, axis=1)[:, k - 1] * (1 + 1e-9) + 1e-9)
            i = j = far = None
            for block in blocks:
                last = block.stop == d
                room = limit if last else limit * (block.stop / d) * (1 + p.strictness / np.sqrt(block.stop)) ** 2
                if i is None:
                    c, part = x[members, block], qs[asking, block]
                    step = (c * c).sum(1) - 2 * part @ c.T + (part * part).sum(1)[:, None]
                    if far is None:
                        step[ids[members] == query_ids[asking][:, None]] = np.nan
                    far = step if far is None else far + step
                    alive = far <= room[:, None]
                    if not last and alive.mean() > p.sparse:
                        far[~alive] = np.nan  # below no limit
                        continue
                    i, j = np.nonzero(alive)
                    far = far[i, j]
                else:
                    far = far + ((x[members[j], block] - qs[asking[i], block]) ** 2).sum(1)
                    keep = far <= room[i]
                    i, j, far = i[keep], j[keep], far[keep]
            i, j = asking[i], members[j]
            score = (vectors[j] * queries[i]).sum(1)
            order = np.lexsort((ids[j], -score, i))
            i, j, score = (v[order][firsts(i[order], k)] for v in (i, j, score))
            kept.append((i, j, score))
            place = np.arange(len(i)) - np.searchsorted(i, i)
            fresh = np.full((len(queries), k), -np.inf) if len(i) else None
            if fresh is not None:
                fresh[i, place] = score
                some = np.unique(i)
                top_score[some] = np.sort(np.concatenate((top_score[some], fresh[some]), axis=1), axis=1)[:, k:]
    i, j, score = (np.concatenate([np.zeros(0, t), *(v[c] for v in kept)]) for c, t in enumerate((np.int64, np.int64, np.float64)))
    order = np.lexsort((ids[j], -score, i))
    mask = firsts(i[order], k)
    return i[order][mask], j[order][mask], score[order][mask]


def matrix(col: pa.Array) -> np.ndarray:
    """Rows of equal length as doubles."""
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def nearest_neighbours(rows: DataFrame, is_query: Column, params: NeighbourParams = NeighbourParams(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id_col, score) of the k best of each row for which is_query (a condition on id_col) holds."""
    v = F.col("vector")
    element = rows.schema[vector_col].dataType.elementType.simpleString()
    kind = "float" if element == "float" else "double"
    ok = rows.select(F.col(id_col).cast("long").alias("id"), is_query.alias("asks"), F.col(vector_col).cast(f"array<{kind}>").alias("vector"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    norm2 = F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    ok = ok.filter(F.col("id").isNotNull() & v.isNotNull() & finite).withColumn("norm2", norm2).filter("norm2 > 0")
    # One row for each length of vectors: a table has one, or a few.
    sizes = ok.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"), F.max("norm2").alias("top"), F.count_if("asks").alias("asked")).filter("asked > 0").orderBy("d").collect()
    found = [_search(ok.filter(F.size("vector") == r["d"]).select("id", "asks", "vector"), r["n"], r["top"], kind, params) for r in sizes]
    if not found:
        return rows.sparkSession.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "found")
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= params.k)
    return ranked.select("query_id", "rank", F.col("found").alias(id_col), "score")


def _search(ok: DataFrame, n: int, top: float, kind: str, params: NeighbourParams) -> DataFrame:
    """(query_id, found, score): the k best of each tile for rows (id, asks, vector) of one length."""
    spark = ok.sparkSession
    n_lists = max(1, min(params.max_lists, round(n**0.5)))
    wanted = max(params.sample_rows, 4 * n_lists)
    sample = ok.filter(hash_fraction(F.struct("id", "vector"), params.seed) < min(1.0, wanted / n)).select("id", "vector").limit(2 * wanted).toArrow()
    order = np.argsort(sample["id"].to_numpy(), kind="stable")
    learn = matrix(sample["vector"].combine_chunks())[order].reshape(len(order), -1)
    if not len(learn):
        learn = matrix(ok.select("vector").limit(1).toArrow()["vector"].combine_chunks())
    lists = Lists(learn, min(n_lists, len(learn)), top, params)
    model = spark.sparkContext.broadcast(lists)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = model.value.nearest(model.value.lifted(matrix(b.column("vector"))))
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), *b.columns], names=["list", "id", "asks", "vector"])

    filed = durable(ok.mapInArrow(file, f"list int, id long, asks boolean, vector array<{kind}>"))
    for r in filed.groupBy("list").agg(F.count("*").alias("n")).collect():  # max_lists rows at most
        lists.sizes[r["list"]] = r["n"]
    # Lists go together in bundles of about a tile; a larger list is cut into tiles. Tiles are numbered one after another.
    tile = min(params.most_tile, max(params.tile_rows, int(n * params.tile_share)))
    bundle_of, rooms = [], [0]
    for size in lists.sizes.tolist():
        if rooms[-1] and rooms[-1] + size > tile:
            rooms.append(0)
        rooms[-1] += size
        bundle_of.append(len(rooms) - 1)
    n_tiles = [max(1, -(-room // tile)) for room in rooms]
    first_tile = np.cumsum([0, *n_tiles]).tolist()
    probing = spark.sparkContext.broadcast(lists)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = probing.value
        for b in batches:
            rows = []
            for probes in m.probed(m.lifted(matrix(b.column("vector")), query=True)):
                by_bundle: dict[int, list[int]] = {}
                for k in probes.tolist():
                    by_bundle.setdefault(bundle_of[k], []).append(k)
                rows.append([{"tile": t, "lists": ks} for n, ks in by_bundle.items() for t in range(first_tile[n], first_tile[n + 1])])
            out = pa.list_(pa.struct([("tile", pa.int32()), ("lists", pa.list_(pa.int32()))]))
            yield pa.RecordBatch.from_arrays([pa.array(rows, out), b.column("id"), b.column("vector")], names=["tiles", "id", "vector"])

    places = spark.createDataFrame([(k, first_tile[b], n_tiles[b]) for k, b in enumerate(bundle_of)], "list int, first int, cut int")
    held = filed.join(F.broadcast(places), "list")  # max_lists rows at most
    number = (F.col("first") + F.pmod(F.xxhash64("id"), F.col("cut"))).cast("int")
    held = held.select(number.alias("tile"), F.lit(False).alias("asks"), "id", F.array("list").alias("lists"), "vector")
    asked = filed.filter("asks").groupBy("id").agg(F.min("vector").alias("vector")).mapInArrow(probe, f"tiles array<struct<tile:int,lists:array<int>>>, id long, vector array<{kind}>")
    asked = asked.select(F.inline("tiles"), "id", "vector").select("tile", F.lit(True).alias("asks"), "id", "lists", "vector")
    both = held.unionByName(asked).repartitionById(first_tile[-1], F.col("tile")).sortWithinPartitions("tile", "asks")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A tile's vectors come before its queries, which are taken in blocks."""
        now, vectors, queries = None, [], []

        def flush() -> Iterator[pa.RecordBatch]:
            if queries and vectors:
                if len(vectors) > 1:
                    vectors[:] = [pa.concat_batches(vectors)]
                q, x = pa.concat_batches(queries), vectors[0]
                q_ids, ids = q.column("id").to_numpy(), x.column("id").to_numpy()
                probes = [np.array(p) for p in q.column("lists").to_pylist()]
                i, j, score = scan_tile(matrix(q.column("vector")), q_ids, probes, matrix(x.column("vector")), ids, x.column("lists").flatten().to_numpy(), model.value)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[i], pa.int64()), pa.array(ids[j], pa.int64()), pa.array(score, pa.float64())], names=["query_id", "found", "score"])
            queries.clear()

        for b in batches:
            tiles, asks = b.column("tile").to_numpy(), b.column("asks").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((tiles[1:] != tiles[:-1]) | (asks[1:] != asks[:-1])) + 1
            for lo, hi in pairwise([0, *cuts.tolist(), len(tiles)]):
                if lo == hi:
                    continue
                if tiles[lo] != now:
                    yield from flush()
                    now = tiles[lo]
                    vectors.clear()
                if not asks[lo]:
                    vectors.append(b.slice(lo, hi - lo))
                    continue
                queries.append(b.slice(lo, hi - lo))
                if sum(map(len, queries)) >= params.query_rows:
                    yield from flush()
        yield from flush()

    return both.mapInArrow(scan, "query_id long, found long, score double")
