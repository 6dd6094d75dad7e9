"""Quality scores: random-indexing word vectors, pooled by document, and a small network.

Every word (hashed into ``bins``) has a fixed sparse random index vector. One pass over
the whole corpus adds to each word's vector the index vectors of its neighbours. A
document pools its words' vectors: mean, spread, likeness of neighbours, share of
distinct words, length. A two-layer network learns the label from a bounded sample of
labelled rows, and a temperature fitted on rows kept apart calibrates its probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.kernels import Words, map_arrow, mix, pieces
from loomwork.llm.sums import dense_sum

BINS, DIM, NONZERO, REACH = 1 << 14, 64, 2, 2
#: Words taken at once.
_RUN = 1 << 16


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzeros of every bin's index vector."""
    h = mix(np.arange(BINS * NONZERO, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(11)).reshape(BINS, NONZERO)
    return (h % np.uint64(DIM)).astype(np.int64), np.where((h >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)


def _tokens(col: pa.Array) -> tuple[Words, np.ndarray]:
    words = Words(col, lower=False, split="class")
    return words, (words.hash >> np.uint64(8)).astype(np.int64) % BINS


def word_vectors(docs: DataFrame) -> np.ndarray:
    """A unit vector for each bin, from all neighbours of all its words in the corpus."""
    places, signs = _index_vectors()

    def add(total: np.ndarray, batch: pa.RecordBatch) -> None:
        for sub in pieces(batch, "text"):
            words, t = _tokens(sub.column(0))
            row = words.row
            for at in range(0, len(t), _RUN):  # pairs whose left word is in the run
                near, sign = [], []
                for step in range(1, REACH + 1):
                    left, right = slice(at, min(at + _RUN, len(t) - step)), slice(at + step, min(at + _RUN, len(t) - step) + step)
                    same = row[left] == row[right]
                    x, y = t[left][same], t[right][same]
                    for a, b in ((x, y), (y, x)):
                        for j in range(NONZERO):
                            near.append(a * DIM + places[b, j])
                            sign.append(signs[b, j])
                total += np.bincount(np.concatenate(near), np.concatenate(sign), minlength=BINS * DIM).reshape(BINS, DIM).astype(np.float32)

    vectors = dense_sum(docs.select(F.coalesce("text", F.lit("")).alias("text")), add, (BINS, DIM))
    return vectors / np.maximum(1e-6, np.sqrt((vectors**2).sum(axis=1, keepdims=True)))


def pooled(col: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """One row of features for each text; without words all are zero. Words are taken in runs, so memory doesn't follow the longest text."""
    words, t = _tokens(col)
    n, row = len(col), words.row
    size = np.diff(words.first)
    total, square, near = np.zeros((n, DIM)), np.zeros((n, DIM)), np.zeros(n)
    for at in range(0, len(t), _RUN // 8):
        to = min(len(t), at + _RUN // 8)
        v = vectors[t[max(0, at - 1) : to]]  # with the word before
        like = np.einsum("ij,ij->i", v[1:], v[:-1])
        follows = np.flatnonzero(row[max(1, at) : to] == row[max(1, at) - 1 : to - 1])
        near += np.bincount(row[max(1, at) : to][follows], like[follows], minlength=n)
        v = v[len(v) - (to - at) :]
        begin = np.flatnonzero(np.append(True, row[at + 1 : to] != row[at : to - 1]))
        total[row[at:to][begin]] += np.add.reduceat(v, begin, axis=0)
        square[row[at:to][begin]] += np.add.reduceat(v * v, begin, axis=0)
    out = np.zeros((n, 2 * DIM + 4), dtype=np.float32)
    full = np.flatnonzero(size)
    count = size[full]
    mean = total[full] / count[:, None]
    out[full, :DIM] = mean
    out[full, DIM : 2 * DIM] = np.sqrt(np.maximum(0, square[full] / count[:, None] - mean * mean))
    out[full, 2 * DIM] = near[full] / count
    out[full, 2 * DIM + 1] = np.bincount(np.unique(row * BINS + t) // BINS, minlength=n)[full] / count
    out[full, 2 * DIM + 2] = np.log1p(count) / 10
    out[full, 2 * DIM + 3] = np.bincount(row, words.punct, minlength=n)[full] / count
    return out


class Network:
    """Two layers in NumPy, trained with Adam, calibrated with one temperature."""

    def __init__(self, hidden: int = 48, epochs: int = 40, batch: int = 256, rate: float = 3e-3, decay: float = 1e-4, seed: int = 3):
        self.hidden, self.epochs, self.batch, self.rate, self.decay, self.seed = hidden, epochs, batch, rate, decay, seed

    def fit(self, x: np.ndarray, y: np.ndarray) -> Network:
        rng = np.random.default_rng(self.seed)
        self.prior = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
        self.shift, self.scale = (x.mean(axis=0), x.std(axis=0) + 1e-4) if len(x) else (0.0, 1.0)
        self.weights, self.temperature = None, 1.0
        if len(set(y.tolist())) < 2:
            return self
        z = (x - self.shift) / self.scale
        order = rng.permutation(len(z))
        held, used = order[: len(z) // 6], order[len(z) // 6 :]
        w = [rng.standard_normal((x.shape[1], self.hidden)) * np.sqrt(2 / x.shape[1]), np.zeros(self.hidden), rng.standard_normal(self.hidden) / np.sqrt(self.hidden), np.zeros(1)]
        m, s, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
        for _ in range(self.epochs):
            rng.shuffle(used)
            for at in range(0, len(used), self.batch):
                b = used[at : at + self.batch]
                inner = np.maximum(0, z[b] @ w[0] + w[1])
                error = (1 / (1 + np.exp(-np.clip(inner @ w[2] + w[3], -40, 40))) - y[b]) / len(b)
                back = np.outer(error, w[2]) * (inner > 0)
                step += 1
                for i, g in enumerate((z[b].T @ back + self.decay * w[0], back.sum(axis=0), inner.T @ error + self.decay * w[2], error.sum(keepdims=True))):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    s[i] = 0.999 * s[i] + 0.001 * g * g
                    w[i] -= self.rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(s[i] / (1 - 0.999**step)) + 1e-8)
        self.weights = w
        if len(held):
            logit = self._logit(x[held])
            loss = lambda t: np.logaddexp(0, np.where(y[held] > 0, -1, 1) * logit / t).mean()
            self.temperature = min(np.geomspace(0.25, 8, 60).tolist(), key=loss)
        return self

    def _logit(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.maximum(0, (x - self.shift) / self.scale @ w[0] + w[1]) @ w[2] + w[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self._logit(x) / self.temperature, -40, 40)))


def held_out(col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(col).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, max_train: int = 20_000) -> Network:
    """Fits on at most ``max_train`` labelled rows, the first by a hash of doc_id, none of them held out.

    Rows of ``labels`` without doc_id or quality are ignored; of repeats the least label counts,
    of documents that share a doc_id the least text. Ties of the hash go to the smaller doc_id.
    """
    known = labels.where("doc_id is not null and quality is not null").where(~held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sub in pieces(batch, "text"):
                x = pooled(sub.column(1), vectors)
                yield pa.RecordBatch.from_arrays([sub.column(0), pa.array([r.tobytes() for r in x], pa.binary())], names=["label", "x"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    sample = texts.join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.min("label").alias("label"), F.min("text").alias("text"))
    rows = map_arrow(sample.select("label", "text"), run, "label int, x binary").toArrow()
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), dtype=np.float32).reshape(-1, 2 * DIM + 4)
    y = rows.column("label").to_numpy()
    order = np.lexsort((*x.T[:3], y))  # arrival order must not matter
    return Network().fit(x[order].astype(np.float64), y[order].astype(np.float64))


def quality(docs: DataFrame, labels: DataFrame, max_train: int = 20_000) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Null and empty texts are scored as texts without words. Without labels of both kinds
    every score is the share of label 1 among them (0.5: no labels). Rows that repeat are
    returned as often as they occur; an empty table gives no rows; other columns are ignored.
    The longest text costs a small multiple of its bytes, as its words are pooled run by run.
    """
    vectors = word_vectors(docs)
    net = train(docs, labels, vectors, max_train)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sub in pieces(batch, "text"):
                yield pa.RecordBatch.from_arrays([sub.column(0), pa.array(net.score(pooled(sub.column(1), vectors).astype(np.float64)))], names=["doc_id", "score"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    scored = map_arrow(slim, run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
