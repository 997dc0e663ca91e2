"""Quality scores: a linear-chain conditional random field labels every line of a text good or bad.

Each line's bytes give shape features (share of capitals, digits, symbols, repeated words, word and line length, ...).
They are cut into bins learned on the sample; a line's score for a label adds one weight per feature bin of the line
itself, of the line before and of the line after, and the chain adds a weight per pair of labels. Forward-backward gives
each line's marginal of being good; a document's mean of these, weighted by line length, passes a logistic calibration
to become the quality score.

Training uses a bounded sample of labelled documents. A document's label is first given to all its lines; lines of bad
documents that a chain-free fit finds clearly good are then relabelled good, save the worst one of each document.

Edge cases: blank lines are left out; a text without any word (null or empty too) counts as one line without words;
repeated rows each get their own score; an empty table gives an empty result; without labelled rows, or with one label
only, every score is the share of good labels (0.5 if there is none). Lines end at line feeds; a text without any is one
line. Several labels of one document count as good if most of them are 1; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masterlink.llm.common import U64, Words, buffer_of, hash_fraction, slices, small_batches, string_array

#: Byte classes: other, lower, capital, digit, space, full stop and comma, exclamation, other punctuation, symbol, high byte.
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 3
_CLASS[[0x20, 9, 10, 11, 12, 13]] = 4
_CLASS[[ord(c) for c in ".,"]] = 5
_CLASS[ord("!")] = 6
_CLASS[[ord(c) for c in ";:'\"?()-"]] = 7
_CLASS[[ord(c) for c in "#$%&*|<>{}[]=+~^@\\/_`"]] = 8
_CLASS[128:] = 9
N_FEATURES = 11


@dataclass(frozen=True)
class QualityParams:
    #: Bound of the training sample, per label.
    rows_per_label: int = 1500
    #: Bins of a feature; even. Zero has a bin of its own, and either label's lines set half of the other bounds.
    bins: int = 12
    steps: int = 120
    rate: float = 0.15
    l2: float = 1e-3
    seed: int = 11


def line_features(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each slice of documents: its range, the features of all lines, their lengths and each document's first line."""
    data, offsets = buffer_of(texts)
    for i, j in slices(offsets):
        raw = data[int(offsets[i]) : int(offsets[j])]
        w = Words(data, offsets, i, j)
        n = len(raw)
        starts = np.unique(np.concatenate((w.bounds[:-1], np.flatnonzero(raw == 10) + 1)))
        starts = starts[starts < n] if n else starts[:0]
        ends = np.append(starts[1:], n)
        n_words = np.diff(np.searchsorted(w.start, np.append(starts, n)))
        kept = n_words > 0
        starts, ends, n_words = starts[kept], ends[kept], n_words[kept]
        lines = len(starts)
        cls = _CLASS[raw]
        size = np.maximum(1, ends - starts)
        share = np.empty((10, lines))
        for k in range(10):
            sums = np.concatenate(([0], np.cumsum(cls == k, dtype=np.int32)))
            share[k] = sums[ends] - sums[starts]
        line_of = np.repeat(np.arange(lines), n_words)
        key = np.sort((line_of.astype(np.uint64) << U64(40)) | (w.hash >> U64(24)))
        fresh = np.ones(len(key), dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        unique = np.bincount((key[fresh] >> U64(40)).astype(np.int64), minlength=lines)
        again = np.zeros(len(key), dtype=bool)
        again[1:] = (w.hash[1:] == w.hash[:-1]) & (line_of[1:] == line_of[:-1])
        adjacent = np.bincount(line_of[again], minlength=lines)
        letters = np.maximum(1, share[1] + share[2] + share[9])
        x = np.stack([share[2] / letters, share[3] / size, share[5] / n_words, share[6] / n_words, share[7] / n_words, share[8] / n_words, share[9] / size, letters / n_words, unique / n_words, adjacent / n_words, np.log1p(n_words)], axis=1) if lines else np.zeros((0, N_FEATURES))
        doc = np.searchsorted(w.bounds[1:], starts, side="right")
        first = np.searchsorted(doc, np.arange(j - i + 1))
        bare = np.flatnonzero(first[1:] == first[:-1])
        if len(bare):  # a document without words is one line without words
            at = first[bare]
            x, size = np.insert(x, at, 0.0, axis=0), np.insert(size, at, 1)
            first = first + np.searchsorted(bare, np.arange(j - i + 1))
        yield i, j, x, size.astype(float), first


class LineCrf:
    """Weights, bins and calibration; holds no row of the corpus."""

    def __init__(self, params: QualityParams):
        self.params = params
        self.edges = np.zeros((N_FEATURES, params.bins - 1))
        self.weight = np.zeros((3, N_FEATURES, params.bins + 1, 2))
        self.pair = np.zeros((2, 2))
        self.scale, self.shift = 0.0, 0.0

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(self.edges[f], x[:, f], side="right") for f in range(N_FEATURES)], axis=1) if len(x) else np.zeros((0, N_FEATURES), dtype=int)

    @staticmethod
    def neighbours(bins: np.ndarray, first: np.ndarray, none: int) -> np.ndarray:
        """Bins of the line itself, the one before and the one after; `none` beyond the document."""
        n = len(bins)
        out = np.full((3, n, N_FEATURES), none)
        out[0] = bins
        if n:
            out[1, 1:], out[2, :-1] = bins[:-1], bins[1:]
            begin = first[:-1][first[:-1] < first[1:]]
            out[1, begin] = none
            out[2, first[1:][first[1:] > first[:-1]] - 1] = none
        return out

    def emissions(self, near: np.ndarray) -> np.ndarray:
        e = np.zeros((near.shape[1], 2))
        for k in range(3):
            for f in range(N_FEATURES):
                e += self.weight[k, f][near[k, :, f]]
        return e

    def forward_backward(self, e: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Marginals of each line, expected counts of label pairs and the log partition's sum."""
        n, size = len(e), np.diff(first)
        marginal, pairs, log_z = np.zeros((n, 2)), np.zeros((2, 2)), 0.0
        order = np.argsort(-size, kind="stable")
        size, begin = size[order], first[:-1][order]
        if not n:
            return marginal, pairs, log_z
        trans = np.exp(self.pair)
        top = e.max(1, keepdims=True)
        psi = np.exp(e - top)
        alpha, scale = np.zeros((n, 2)), np.ones(n)
        live = int((size > 0).sum())
        at = begin[:live]
        a = psi[at]
        s = a.sum(1)
        alpha[at], scale[at] = a / s[:, None], s
        for t in range(1, int(size[0])):
            live = int(np.searchsorted(-size, -t, side="left"))
            at = begin[:live] + t
            a = (alpha[at - 1] @ trans) * psi[at]
            s = a.sum(1)
            alpha[at], scale[at] = a / s[:, None], s
        beta = np.ones((n, 2))
        for t in range(int(size[0]) - 1, 0, -1):
            live = int(np.searchsorted(-size, -t, side="left"))
            at = begin[:live] + t
            back = psi[at] * beta[at] / scale[at][:, None]
            beta[at - 1] = back @ trans.T
            pairs += (alpha[at - 1].T @ back) * trans
        marginal = alpha * beta
        marginal /= marginal.sum(1, keepdims=True)
        return marginal, pairs, float(np.log(scale).sum() + top.sum())

    def fit(self, texts: list[str], labels: list[int]) -> LineCrf:
        p = self.params
        good = float(np.mean(labels)) if labels else 0.5
        self.scale, self.shift = 0.0, float(np.log(max(good, 1e-6) / max(1 - good, 1e-6)))
        if not labels or good in (0.0, 1.0):
            return self
        xs, sizes, firsts, lines = [], [], [np.zeros(1, dtype=int)], 0
        for _, _, x, size, first in line_features(pa.array(texts, pa.large_string())):
            xs.append(x)
            sizes.append(size)
            firsts.append(first[1:] + lines)
            lines += len(x)
        x, size, first = np.concatenate(xs), np.concatenate(sizes), np.concatenate(firsts)
        label = np.asarray(labels)
        y = np.repeat(label, np.diff(first))
        for f in range(N_FEATURES):
            parts = [x[(y == c) & (x[:, f] > 0), f] for c in (0, 1)]
            cuts = [np.quantile(v, np.linspace(0, 1, p.bins // 2 + 1)[1:-1]) if len(v) else np.full(p.bins // 2 - 1, np.inf) for v in parts]
            self.edges[f] = np.sort(np.concatenate(([1e-9], *cuts)))
        near = self.neighbours(self.binned(x), first, p.bins)
        per_doc = np.repeat(1.0 / np.diff(first), np.diff(first)) * len(x) / len(label)
        per_doc *= np.where(y == 1, 0.5 / good, 0.5 / (1 - good))
        moments: list[np.ndarray] | None = None

        def ascend(steps: int, chain: bool) -> None:
            """Adam on the mean log likelihood, of single lines (weighted by document) or of chains."""
            nonlocal moments
            params = [self.weight, self.pair]
            moments = [np.zeros_like(v) for v in params for _ in (0, 1)]
            truth = np.stack([y == 0, y == 1], axis=1).astype(float)
            inner = np.ones(len(y), dtype=bool)
            inner[first[:-1]] = False
            seen = np.zeros((2, 2))
            np.add.at(seen, (y[:-1][inner[1:]], y[1:][inner[1:]]), 1.0)
            for t in range(1, steps + 1):
                e = self.emissions(near)
                if chain:
                    q, pairs, _ = self.forward_backward(e, first)
                    g_pair = (seen - pairs) / len(y)
                    g = (truth - q) * per_doc[:, None] / len(y)
                else:
                    q = np.exp(e - e.max(1, keepdims=True))
                    q /= q.sum(1, keepdims=True)
                    g = (truth - q) * per_doc[:, None] / len(y)
                    g_pair = np.zeros((2, 2))
                g_weight = np.zeros_like(self.weight)
                for k in range(3):
                    for f in range(N_FEATURES):
                        for c in (0, 1):
                            g_weight[k, f, :, c] = np.bincount(near[k, :, f], weights=g[:, c], minlength=p.bins + 1)
                for v, grad, (m, s) in zip(params, (g_weight - p.l2 * self.weight, g_pair - p.l2 * self.pair), (moments[:2], moments[2:]), strict=True):
                    m[:] = 0.9 * m + 0.1 * grad
                    s[:] = 0.99 * s + 0.01 * grad**2
                    v += p.rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)

        ascend(p.steps // 2, chain=False)
        e = self.emissions(near)
        margin = e[:, 1] - e[:, 0]
        worst = np.minimum.reduceat(margin, first[:-1])
        mixed = np.repeat(worst < -1.5, np.diff(first))  # a document that looks good all over keeps its label
        y = np.where((y == 0) & (margin > 1.5) & mixed, 1, y)
        ascend(p.steps, chain=True)
        marginal, _, _ = self.forward_backward(self.emissions(near), first)
        mean = np.add.reduceat(marginal[:, 1] * size, first[:-1]) / np.add.reduceat(size, first[:-1])
        self.scale, self.shift = logistic(mean, label)
        return self

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = np.empty(len(texts))
        for i, j, x, size, first in line_features(texts):
            marginal, _, _ = self.forward_backward(self.emissions(self.neighbours(self.binned(x), first, self.params.bins)), first)
            weighted, total = (np.concatenate(([0.0], np.cumsum(v))) for v in (marginal[:, 1] * size, size))
            mean = (weighted[first[1:]] - weighted[first[:-1]]) / np.maximum(1e-12, total[first[1:]] - total[first[:-1]])
            out[i:j] = 1 / (1 + np.exp(-np.clip(self.scale * mean + self.shift, -500, 500)))
        return out


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton's method with a small ridge; the labels weigh the same in all."""
    w = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    a, beta = np.stack([x, np.ones_like(x)], axis=1), np.zeros(2)
    ridge = np.diag([1e-3, 1e-6]) * len(y)
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        step = np.linalg.solve((a * (w * q * (1 - q))[:, None]).T @ a + ridge, a.T @ (w * (y - q)) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def train_quality_model(docs: DataFrame, labels: DataFrame, eligible: Column, params: QualityParams = QualityParams(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> LineCrf:
    """Fit on at most about rows_per_label documents of each label among the eligible ones (a condition on id_col).

    The choice is by a hash of the key; counts come from the whole label table. Only the chosen labels, a bounded
    number, are broadcast to find their texts.
    """
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).filter(eligible)
    known = known.groupBy(F.col(id_col).alias("id")).agg((F.avg(F.col(label_col).cast("double")) > 0.5).cast("int").alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for y, n in counts.items():
        share = F.when(F.col("y") == y, F.lit(min(1.0, params.rows_per_label / n))).otherwise(share)
    chosen = known.filter(hash_fraction(F.col("id"), params.seed) < share)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").limit(4 * params.rows_per_label).collect()
    rows.sort(key=lambda r: (zlib.crc32(repr(r["id"]).encode()), r["id"], r["text"] or ""))
    return LineCrf(params).fit([r["text"] or "" for r in rows], [r["y"] for r in rows])


def score_quality(docs: DataFrame, model: LineCrf, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all, by default) with quality_score; an existing column of that name is replaced."""
    keep = [c for c in (keep if keep is not None else docs.columns) if c != "quality_score"]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(text_col).alias("__text"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = shared.value.scores(string_array(b.column(b.num_columns - 1)))
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(b.num_columns - 1)] + [pa.array(scores, pa.float64())], names=[*keep, "quality_score"])

    return small_batches(rows).mapInArrow(apply, rows.drop("__text").withColumn("quality_score", F.lit(0.0)).schema)
