"""Language identification: averaged hashed subword embeddings with a linear softmax.

A word's runs of 3 to 5 bytes (with boundary marks) and the word itself are hashed into a fixed number of rows of an
embedding matrix. A text is the mean of its subwords' embeddings; a linear softmax over that mean gives the language.
Both matrices are trained by stochastic gradient descent in numpy on a bounded sample. As mean and layer are linear, a
word's share of the logits is one vector, so prediction adds cached vectors of words instead of embeddings of subwords.

Calibration: on rows of the sample kept out of training, a temperature is fitted to the logits by log loss, and texts
whose calibrated probability falls below a low quantile seen on right predictions there (at most `max_threshold`) are
rejected, as are texts without a letter.

Edge cases: null or empty texts, and texts without a letter, get `und`, score 0 and rejected = true; null keys and very
long texts are read like others; ties go to the first language; repeated rows each get their own result; an empty table gives an empty result; without any training row every text is `und`; columns other
than the key and the text are ignored.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masterlink.llm.common import _BYTE, U64, hash_fraction, mix, powers, small_batches

WORD = re.compile(r"[^\W\d_]+")
UND = "und"


def has_letter(text: str) -> bool:
    """Whether any character is a letter; signs such as a superscript two or a half are none, though words may hold them."""
    return any(any(map(str.isalpha, m[0])) for m in WORD.finditer(text))


@dataclass(frozen=True)
class LanguageParams:
    #: Bound of the training sample, per language; its texts are used whole.
    rows_per_language: int = 800
    buckets: int = 1 << 15
    dim: int = 16
    epochs: int = 2
    rate: float = 0.5
    #: Share of the sample that is kept for calibration.
    calibration: float = 0.25
    #: Share of right calibration texts that may be rejected at most.
    reject_quantile: float = 0.0005
    max_threshold: float = 0.5
    #: Words of the longest runs that training texts are cut into, and runs of a step of gradient descent.
    words_per_step: int = 60
    runs_per_step: int = 4
    seed: int = 7
    cached_words: int = 200_000


def subwords(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all words' subwords (runs of 3 to 5 bytes of `<word>`, and all of it) and each word's first one."""
    data = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-8", "surrogatepass"), dtype=np.uint8)
    begin = np.flatnonzero(data == ord("<"))
    end = np.append(begin[1:], len(data))
    value = _BYTE[data]
    owner = np.repeat(np.arange(len(words)), end - begin)
    room = end[owner] - np.arange(len(data))
    pw, ipw = powers(len(data) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value * pw[: len(data)], dtype=np.uint64)))
    ids, owners = [mix((sums[end] - sums[begin]) * ipw[begin] + U64(99))], [np.arange(len(words))]
    for n in (3, 4, 5):
        at = np.flatnonzero(room >= n)
        ids.append(mix((sums[at + n] - sums[at]) * ipw[at] + U64(n)))
        owners.append(owner[at])
    by_word = np.argsort(np.concatenate(owners), kind="stable")
    first = np.searchsorted(np.concatenate(owners)[by_word], np.arange(len(words) + 1))
    return (np.concatenate(ids)[by_word] % U64(buckets)).astype(np.int32), first


class LanguageModel:
    """Learned matrices, temperature and rejection threshold; holds no row of the corpus."""

    def __init__(self, langs: list[str], params: LanguageParams):
        self.langs, self.params = langs, params
        rng = np.random.default_rng(params.seed)
        self.emb = rng.normal(0, 0.1, (params.buckets, params.dim))
        self.out = np.zeros((params.dim, max(1, len(langs))))
        self.bias = np.zeros(max(1, len(langs)))
        self.temperature, self.threshold = 1.0, 0.0
        self._table: np.ndarray | None = None
        self._index: dict[str, int] = {}
        self._rows: np.ndarray | None = None
        self._used = 0

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_table": None, "_index": {}, "_rows": None, "_used": 0, "emb": self.emb.astype(np.float32)}

    def fit(self, texts: list[str], labels: list[str]) -> LanguageModel:
        p, rng = self.params, np.random.default_rng(self.params.seed)
        if len(self.langs) < 2 or not texts:
            return self
        cut = rng.random(len(texts)) < p.calibration
        steps: list[tuple[np.ndarray, int]] = []
        for text, label, held in zip(texts, labels, cut, strict=True):
            words = WORD.findall(text.lower())
            if held or not words:
                continue
            ids, first = subwords(words, p.buckets)
            # Runs of several lengths, short ones too: the model must also read short texts.
            at, k, y = 0, 0, self.langs.index(label)
            while at < len(words):
                to = min(len(words), at + (p.words_per_step, 4, 15)[k % 3])
                steps.append((ids[first[at] : first[to]], y))
                at, k = to, k + 1
        counts = np.bincount([y for _, y in steps], minlength=len(self.langs))
        weight = np.minimum(len(steps) / np.maximum(counts, 1) / len(self.langs), 3.0)
        total, done = p.epochs * len(steps), 0
        for _ in range(p.epochs):
            order = rng.permutation(len(steps))
            for a in range(0, len(steps), p.runs_per_step):
                runs = [steps[s] for s in order[a : a + p.runs_per_step]]
                ids, y = np.concatenate([r[0] for r in runs]), np.array([r[1] for r in runs])
                n = np.array([len(r[0]) for r in runs])
                rate = p.rate * (1 - done / total)
                done += len(runs)
                mean = np.add.reduceat(self.emb[ids], np.cumsum(n) - n, axis=0) / n[:, None]
                q = np.exp(log_softmax(mean @ self.out + self.bias))
                q[np.arange(len(y)), y] -= 1
                q *= weight[y][:, None]
                back = q @ self.out.T / n[:, None]
                self.out -= rate * (mean.T @ q)
                self.bias -= 0.1 * rate * q.sum(0)
                np.subtract.at(self.emb, ids, rate * np.repeat(back, n, axis=0))
        self._table = None
        kept = [i for i in np.flatnonzero(cut) if has_letter(texts[i])]
        held_labels = np.array([self.langs.index(labels[i]) for i in kept])
        if len(kept) >= 20:
            z = self.logits([WORD.findall(texts[i].lower()) for i in kept])
            grid = np.exp(np.linspace(np.log(0.2), np.log(20), 60))
            self.temperature = float(min(grid, key=lambda t: -log_softmax(z / t)[np.arange(len(z)), held_labels].mean()))
            prob = np.exp(log_softmax(z / self.temperature))
            right = prob.argmax(1) == held_labels
            if right.any():
                self.threshold = float(min(p.max_threshold, np.quantile(prob.max(1)[right], p.reject_quantile)))
        return self

    def _learn(self, words: list[str]) -> None:
        """Cache the words' shares of the logits."""
        if self._table is None:
            self._table = np.hstack((self.emb.astype(np.float64) @ self.out, np.ones((len(self.emb), 1))))
        if self._rows is None or self._used + len(words) > len(self._rows):
            self._rows = np.empty((max(self.params.cached_words, len(words)), self._table.shape[1]))
            self._used, self._index = 0, {}
        if words:
            ids, first = subwords(words, self.params.buckets)
            self._rows[self._used : self._used + len(words)] = np.add.reduceat(self._table[ids], first[:-1], axis=0)
            self._index.update(zip(words, range(self._used, self._used + len(words)), strict=True))
            self._used += len(words)

    def logits(self, texts: list[list[str]]) -> np.ndarray:
        """Of the lists of words of whole texts, in parts that bound the memory."""
        out = np.empty((len(texts), len(self.bias)))
        for d, words in enumerate(texts):
            total = 0.0
            for a in range(0, len(words), 50_000):
                part = words[a : a + 50_000]
                index = self._index
                if new := [w for w in dict.fromkeys(part) if w not in index]:
                    used = self._used
                    self._learn(new)
                    if self._used < used + len(new):  # the cache began anew
                        self._learn([w for w in dict.fromkeys(part) if w not in self._index])
                    index = self._index
                total = total + self._rows[[index[w] for w in part]].sum(0)
            out[d] = total[:-1] / total[-1] + self.bias
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """Language, calibrated probability, rejected."""
        out: list[tuple[str, float, bool]] = [(UND, 0.0, True)] * len(texts)
        readable = [i for i, t in enumerate(texts) if t and self.langs and has_letter(t)]
        while readable:
            part, size = [], 0
            while readable and size < 4_000_000 and len(part) < 1000:
                size += len(texts[readable[-1]])
                part.append(readable.pop())
            words = [WORD.findall(texts[i].lower()) for i in part]
            if size < 8_000_000:
                self._learn(list(set().union(*words).difference(self._index)))
            p = np.exp(log_softmax(self.logits(words) / self.temperature))
            for i, row in zip(part, p, strict=True):
                k = int(row.argmax())
                out[i] = self.langs[k], float(row[k]), bool(row[k] < self.threshold)
        return out


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def train_language_model(docs: DataFrame, eligible: Column | None = None, params: LanguageParams = LanguageParams(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Fit on at most rows_per_language rows of each language, chosen by a hash of the key among the eligible rows.

    The row counts per language come from the whole table; the sample's size doesn't grow with it. The sample's texts meet
    in a task, not in the driver.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), (eligible if eligible is not None else F.lit(True)).alias("ok"))
    rows = rows.filter(F.col("ok") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return LanguageModel([], params)
    share = F.lit(0.0)
    for lang in langs:
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, 1.1 * params.rows_per_language / counts[lang]))).otherwise(share)
    sample = rows.filter(hash_fraction(F.struct("id", "text"), params.seed) < share).limit(2 * params.rows_per_language * len(langs)).select("id", "text", "lang")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [row for b in batches for row in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True)]
        found.sort(key=lambda r: (zlib.crc32(repr(r[0]).encode()), repr(r[0]), r[1]))
        model = LanguageModel(langs, params).fit([r[1] for r in found], [r[2] for r in found])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    # The limit leaves one partition, so one task fits; the driver gets the model, whose size the parameters fix.
    fitted = small_batches(sample).mapInArrow(fit, "model binary").collect()
    return pickle.loads(bytes(fitted[0]["model"])) if fitted else LanguageModel(langs, params)


def identify_language(docs: DataFrame, model: LanguageModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all, by default) with lang_pred, lang_score and lang_rejected of every whole text.

    Existing columns with these three names are replaced.
    """
    new = ("lang_pred", "lang_score", "lang_rejected")
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in new]
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # of the size that the parameters fix
    rows = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(text_col).alias("__text"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            out = m.predict(b.column(b.num_columns - 1).to_pylist())
            cols = [b.column(i) for i in range(b.num_columns - 1)]
            more = [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64()), pa.array([x[2] for x in out], pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols + more, names=[*keep, *new])

    schema = rows.drop("__text").withColumns({new[0]: F.lit(""), new[1]: F.lit(0.0), new[2]: F.lit(False)}).schema
    return small_batches(rows).mapInArrow(apply, schema)
