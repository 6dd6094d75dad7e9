"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

Features are hashed words and word beginnings; which of them the model looks at is
chosen by how often they occur in labelled toxic and in other documents. The labels are
binary, so grades above 0 rank the labelled-toxic documents: 1 to 3 by the tertile of how
many markers (features far likelier in toxic documents) they hold. The labelled rows are
dealt to two halves, and a document's markers are those that the other half shows: no
document helps to grade itself, and the model is not taught its own choice of features.
There is no outside measure of severity in the labels; a grade is a rank of evidence. One
weight vector is shared by all thresholds: P(grade > j) = sigmoid(w.x - theta_j), theta ascending. The
severity is the expected grade; a document is rejected if P(grade > 0) reaches one half.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.kernels import Words, map_arrow, pieces
from loomwork.llm.sums import dense_sum

BINS = 1 << 19
PREFIXES = (4, 5, 6)
#: Words taken at once.
_RUN = 1 << 16
GRADES = 3


def _features(col: pa.Array, slot: np.ndarray | None = None) -> np.ndarray:
    """Distinct ``row * BINS + bin`` of every word and word beginning; with ``slot`` of those bins alone that have one.

    Words are taken in runs, so a long text costs what its distinct features take.
    """
    words, found = Words(col, lower=True, split="alnum"), []
    row = words.row
    for at in range(0, max(1, len(row)), _RUN):
        some = slice(at, at + _RUN)
        keys = [(row[some], words.hash[some])]
        for size in PREFIXES:
            long, h = words.prefix(size, some)
            keys.append((row[some][long], h ^ np.uint64(size * 0x1F3D5B79)))
        for r, h in keys:
            bins = (h >> np.uint64(7)).astype(np.int64) % BINS
            if slot is not None:
                m = np.flatnonzero(slot[bins] >= 0)
                r, bins = r[m], bins[m]
            found.append(np.unique(r * BINS + bins))
    return np.unique(np.concatenate(found))


class OrdinalModel:
    """Proportional odds with a weight for each chosen feature; ``slot`` maps bins to features."""

    def __init__(self, bins: np.ndarray):
        self.slot = np.full(BINS, -1, dtype=np.int32)
        self.slot[bins] = np.arange(len(bins))
        self.weights = np.zeros(len(bins))
        self.theta = np.full(GRADES, 20.0)

    def present(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, feature) pairs of a column of texts."""
        pair = _features(col, self.slot)
        return pair // BINS, self.slot[pair % BINS]

    def fit(self, row: np.ndarray, feature: np.ndarray, grade: np.ndarray, rounds: int = 400, rate: float = 0.05, decay: float = 2e-4) -> OrdinalModel:
        """Full-batch Adam on the mean log-likelihood of all thresholds' binary outcomes."""
        n = len(grade)
        above = grade[:, None] > np.arange(GRADES)
        share = np.clip(above.mean(axis=0), 1e-4, 1 - 1e-4)
        start = np.log((1 - share) / share)
        gap = np.log(np.maximum(0.05, np.diff(start)))
        params = [np.zeros(len(self.weights)), start[:1].copy(), gap]
        m, s = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for step in range(1, rounds + 1):
            theta = params[1] + np.concatenate([[0], np.cumsum(np.exp(params[2]))])
            score = np.bincount(row, params[0][feature], minlength=n)
            error = 1 / (1 + np.exp(-np.clip(score[:, None] - theta, -40, 40))) - above
            total = error.sum(axis=1) / n
            to_theta = -error.mean(axis=0)
            tail = np.cumsum(to_theta[::-1])[::-1]
            grads = [np.bincount(feature, total[row], minlength=len(params[0])) + decay * params[0], tail[:1], tail[1:] * np.exp(params[2])]
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                s[i] = 0.999 * s[i] + 0.001 * g * g
                params[i] = params[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(s[i] / (1 - 0.999**step)) + 1e-8)
        self.weights = params[0]
        self.theta = params[1] + np.concatenate([[0], np.cumsum(np.exp(params[2]))])
        return self

    def predict(self, col: pa.Array) -> np.ndarray:
        """P(grade > j) for every text and j."""
        row, feature = self.present(col)
        score = np.bincount(row, self.weights[feature], minlength=len(col)) if len(self.weights) else np.zeros(len(col))
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.theta, -40, 40)))


def _log_odds(counts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """How much likelier a feature is in toxic documents: columns other, toxic."""
    size = np.maximum(1, size)
    return np.log((counts[:, 1] + 0.3) / (size[1] + 0.6)) - np.log((counts[:, 0] + 0.3) / (size[0] + 0.6))


def train(docs: DataFrame, labels: DataFrame, max_train: int = 30_000, max_features: int = 8_192) -> OrdinalModel:
    """Fits on at most ``max_train`` labelled rows, the first by a hash of doc_id, with the ``max_features`` strongest features.

    Rows of ``labels`` without doc_id or label are ignored; of repeats the greatest label counts,
    of documents that share a doc_id the least text. Ties of the hash go to the smaller doc_id,
    of the features' strength to the smaller bin.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).cast("int")
    sample = texts.join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.max("label").alias("label"), F.min("text").alias("text")).select((F.col("label") + 2 * half).alias("label"), "text")

    def count(total: np.ndarray, batch: pa.RecordBatch) -> None:
        for sub in pieces(batch, "text"):
            label = sub.column(0).to_numpy()
            pair = _features(sub.column(1))
            np.add.at(total, (pair % BINS, label[pair // BINS]), 1)
            total[0, 4:] += np.bincount(label, minlength=4)

    counts = dense_sum(sample, count, (BINS, 8))  # by label and half, and (first row) how many rows of each
    counts, size = counts[:, :4], counts[0, 4:]
    whole, rows_of = counts[:, :2] + counts[:, 2:], size[:2] + size[2:]
    odds = _log_odds(whole, rows_of)
    seen = np.flatnonzero((whole.sum(axis=1) >= 3) & (whole[:, 1] > 0) & (odds > 0.7))
    strength = odds[seen] * np.sqrt(whole[seen, 1])
    bins = np.sort(seen[np.argsort(-strength, kind="stable")[:max_features]])
    model = OrdinalModel(bins)
    marker = np.stack([_log_odds(counts[bins, at : at + 2], size[at : at + 2]) > 2.5 for at in (2, 0)]).astype(np.int64)  # of the other half

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sub in pieces(batch, "text"):
                row, feature = model.present(sub.column(1))
                cuts = np.searchsorted(row, np.arange(sub.num_rows + 1))
                lists = [feature[a:b].astype(np.int32).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([sub.column(0), pa.array(lists, pa.binary())], names=["label", "features"])

    rows = map_arrow(sample, run, "label int, features binary").toArrow()
    label = rows.column("label").to_numpy()
    lists = [np.frombuffer(x, dtype=np.int32) for x in rows.column("features").to_pylist()]
    if not len(bins) or len(set((label % 2).tolist())) < 2:
        return model
    order = sorted(range(len(lists)), key=lambda i: (label[i], lists[i].tobytes()))  # arrival order must not matter
    label, lists = label[order], [lists[i] for i in order]
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    feature = np.concatenate(lists).astype(np.int64)
    held = np.bincount(row, marker[label[row] // 2, feature], minlength=len(lists))
    tertiles = np.quantile(held[label % 2 == 1], [1 / 3, 2 / 3])
    grade = np.where(label % 2 == 1, 1 + (held[:, None] > tertiles).sum(axis=1), 0)
    return model.fit(row, feature, grade)


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``doc_id, severity, grade, p_toxic, toxic`` of every row of ``docs``.

    severity: the expected grade, 0 to 3; grade: the likeliest; toxic: 1 if p_toxic >= 0.5.
    Null and empty texts hold no features. Without labels of both kinds nothing is toxic.
    Rows that repeat are returned as often as they occur; an empty table gives no rows;
    other columns are ignored. The longest text costs a small multiple of its bytes.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_arrow(slim, _scorer(train(docs, labels, **options)), "doc_id long, severity double, grade int, p_toxic double, toxic int")


def _scorer(model: OrdinalModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sub in pieces(batch, "text"):
                p = model.predict(sub.column(1))
                each = -np.diff(np.column_stack([np.ones(len(p)), p, np.zeros(len(p))]), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [sub.column(0), pa.array(np.round(p.sum(axis=1), 6)), pa.array(each.argmax(axis=1).astype(np.int32)), pa.array(np.round(p[:, 0], 6)), pa.array((p[:, 0] >= 0.5).astype(np.int32))],
                    names=["doc_id", "severity", "grade", "p_toxic", "toxic"],
                )

    return run


def keep_clean(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not toxic, with the same columns; each row is judged by its own text."""
    model = train(docs, labels, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sub in pieces(batch, "text"):
                yield sub.filter(pa.array(model.predict(sub.column(sub.schema.get_field_index("text")))[:, 0] < 0.5))

    return map_arrow(docs, run, docs.schema)
