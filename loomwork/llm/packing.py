"""Best-fit packing of documents into sequences under several capacities at once.

Documents are tokenised and cut into pieces of at most one sequence. A full piece is a
sequence of its own. The others are dealt by hash into shards of about ``shard_rows``
pieces, and each shard is packed by vector best-fit decreasing: of all open sequences
with room in every capacity (tokens, documents, attention cost = sum of squared lengths)
a piece goes to the one that scores best. A shard leaves about one sequence part empty,
so the loss against one global packing is about one sequence in ``shard_rows`` pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.kernels import map_arrow, pieces
from loomwork.llm.tokens import encoder
from loomwork.session import cut

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """One row for each piece of each document; a null text counts as empty (the end id alone)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for sub in pieces(batch, "text", 4 << 20):
                ids, n = enc.batch(sub.column(1))
                full = np.insert(ids, np.cumsum(n), np.uint32(end_id))
                n = n + 1
                begin = np.cumsum(n) - n
                parts = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), parts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
                start = piece * capacity
                length = np.minimum(capacity, n[doc] - start)
                raw = memoryview(full.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * (a + k)]) for a, k in zip((begin[doc] + start).tolist(), length.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [sub.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_arrow(slim, run, PIECES)


def best_fit(lengths: np.ndarray, capacity: int, max_docs: int, max_cost: int, rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """The bin and offset of each piece; ``lengths`` in descending order, each fits an empty bin.

    ``rule``: "dot" takes the open bin with the largest capacity-weighted dot product of the
    piece's needs and the bin's residuals, "norm" the one whose weighted residual vector is
    shortest once the piece is in. Ties go to the oldest bin.
    """
    n = len(lengths)
    whole = np.array([capacity, max_docs, max_cost], dtype=np.float64)
    left = np.zeros((n, 3))
    bins, offsets = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    active, made = np.zeros(0, dtype=np.int64), 0
    for i, size in enumerate(lengths.tolist()):
        need = np.array([size, 1, float(size) * size])
        room = left[active]
        fits = np.flatnonzero((room >= need).all(axis=1))
        if len(fits):
            share = room[fits] / whole
            score = -(share @ (need / whole)) if rule == "dot" else (np.square(share - need / whole)).sum(axis=1)
            b = active[fits[np.argmin(score)]]
        else:
            b, made = made, made + 1
            left[b] = whole
            active = np.append(active, b)
        bins[i], offsets[i] = b, capacity - int(left[b, 0])
        left[b] -= need
        if (left[b] < 1).any():
            active = active[active != b]
    return bins, offsets


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    max_docs: int | None = None,
    max_cost: int | None = None,
    end_id: int = 1,
    rule: str = "norm",
    shard_rows: int = 12_000,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    ``max_docs`` (pieces a sequence) and ``max_cost`` (sum of squared lengths) bind only if
    given; where ``max_cost`` doesn't allow a piece of ``capacity`` tokens, documents are cut
    into pieces of as many as it does, and a ``max_cost`` under 1 is an error. Pieces of one
    length are packed by doc_id, then piece. A long text is encoded piece by piece. Null and
    empty texts are packed as their end id; a null doc_id is kept; rows that repeat are
    packed as often as they occur; an empty table gives no rows; other columns are ignored.
    """
    max_docs, max_cost = max_docs or capacity, max_cost or capacity * capacity
    if max_cost < 1:
        raise ValueError("max_cost must allow a piece of one token")
    most = min(capacity, isqrt(max_cost))
    made = cut(token_pieces(docs, tokenizer, most, end_id))
    rest = made.where(F.col("length") < capacity)
    shards = max(1, round(rest.count() / shard_rows))

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True])
        bins, offsets = best_fit(pdf["length"].to_numpy(), capacity, max_docs, max_cost, rule)
        return pdf.assign(sequence_id=pdf["shard"].to_numpy() * (1 << 32) + bins, offset=offsets).drop(columns="shard")

    out = f"{PIECES}, sequence_id long, offset long"
    packed = rest.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "length"), F.lit(shards))).groupBy("shard").applyInPandas(fill, out)
    alone = made.where(F.col("length") >= capacity).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    return packed.unionByName(alone)
