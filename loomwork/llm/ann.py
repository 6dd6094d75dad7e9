"""Nearest neighbours by largest inner product, with collision-counting hashing.

Vectors are dealt into index blocks of bounded size, and every block meets every chunk of
queries once. In a block each of ``projections`` random directions gives one sorted array
of projected values, cut into pages. A query opens a window around its own value in every
array and widens all windows together, level by level (virtual rehashing, the radius
growing by ``ratio``); a vector that lies in enough windows is verified with its true
inner product. A level with radius R and half-width ``width * R`` misses a vector at
distance R with a small known probability, so a query stops once its k-th best verified
vector is within the level's radius. The last level verifies whatever is left: no
candidate is capped. Counting is a comparison of page numbers, a byte each, so a level
costs a fraction of the exact products of a block of long vectors and never sorts again.

The first radius is a little under that of the best of ``sample`` vectors of the block, so
a query doesn't walk through levels in which nothing lies; vectors nearer than that lie
in more windows still.

Inner products become distances by one more coordinate that gives all vectors of a block
the same norm; scores are always taken on the original vectors in double precision.
"""

from __future__ import annotations

from math import erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomwork.session import cut

#: Pages of a sorted array, and the share of the sample's best distance at which a query begins.
_PAGES, _FIRST = 256, 0.9


def threshold(projections: int, width: float, miss: float = 1.9) -> int:
    """Collisions that a vector at the level's radius reaches but for ``miss`` deviations."""
    p = erf(width / sqrt(2))
    return max(1, int(projections * p - miss * sqrt(projections * p * (1 - p))))


def exact_scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products added up in one fixed order, so that equal vectors get equal scores."""
    out = np.zeros(len(vectors))
    for j in range(vectors.shape[1]):
        out += vectors[:, j] * query[j]
    return out


class Block:
    """Sorted projections of one block's vectors, and how many vectors queries had to verify."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, projections: int = 160, width: float = 1.5, miss: float = 0.8, ratio: float = 1.06, sample: int = 256, seed: int = 7):
        n, d = x.shape
        self.ids, self.x, self.width, self.ratio, self.need, self.verified = ids, x, width, ratio, threshold(projections, width, miss), 0
        norm = np.sqrt((x * x).sum(axis=1))
        self.top = norm.max()
        self.axes = np.random.default_rng(seed).standard_normal((d + 1, projections))
        values = np.ascontiguousarray((np.column_stack([x, np.sqrt(np.maximum(0, self.top * self.top - norm * norm))]) / self.top @ self.axes).T)
        order = np.argsort(values, axis=1, kind="stable")
        pages = min(_PAGES, n)
        of = (np.arange(n) * pages // n).astype(np.uint8)
        self.page = np.empty(values.shape, dtype=np.uint8)
        np.put_along_axis(self.page, order, np.broadcast_to(of, values.shape), axis=1)
        begin = np.searchsorted(of, np.arange(pages))
        self.least = np.take_along_axis(values, order[:, begin], axis=1)  # the least value of each page
        self.sample = x[:: max(1, n // sample)]
        self.bytes = np.empty(values.shape, dtype=np.uint8), np.empty(values.shape, dtype=bool)

    def hits(self, aim: np.ndarray, reach: float) -> np.ndarray:
        """In how many windows each vector lies: whole pages, from the one that holds ``aim - reach`` to that of ``aim + reach``."""
        below = lambda v: np.maximum((self.least <= v[:, None]).sum(axis=1) - 1, 0)
        lo, hi = below(aim - reach).astype(np.uint8), below(aim + reach).astype(np.uint8)
        place, inside = self.bytes
        np.subtract(self.page, lo[:, None], out=place)  # wraps round below the window
        np.less_equal(place, (hi - lo)[:, None], out=inside)
        return np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8)

    def search(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best found vectors, but the query's own id."""
        size = float(np.sqrt((q * q).sum()))
        unit = size * self.top
        aim = np.append(q / size, 0.0) @ self.axes
        seen = self.ids == query_id
        rough = np.full(len(self.ids), -np.inf)
        k = min(k, len(seen) - int(seen.sum()))
        rank = max(1, k * len(self.sample) // len(seen))
        guess = np.partition(self.sample @ q, len(self.sample) - rank)[len(self.sample) - rank] / unit
        radius = max(0.1, _FIRST * float(np.sqrt(max(0.0, 2 - 2 * guess))))
        while k:
            found = np.flatnonzero(~seen & (self.hits(aim, self.width * radius) >= self.need) if radius < 2 else ~seen)
            seen[found] = True
            rough[found] = self.x[found] @ q
            self.verified += len(found)
            done = np.flatnonzero(rough > -np.inf)
            if len(done) >= k and (radius >= 2 or np.partition(rough[done], len(done) - k)[len(done) - k] >= unit * (1 - radius * radius / 2)):
                break
            radius *= self.ratio
        done = np.flatnonzero(rough > -np.inf)
        if len(done) > k > 0:
            edge = np.partition(rough[done], len(done) - k)[len(done) - k]
            done = done[rough[done] >= edge - 1e-9 * max(unit, 1e-300)]
        score = exact_scores(self.x[done], q)
        best = np.lexsort((self.ids[done], -score))[:k]
        return self.ids[done][best], score[best]


def usable(col: str) -> Column:
    """Whether a vector takes part: not null or empty, not zero, all components finite."""
    x = F.col(col)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) != float("inf")))
    return x.isNotNull() & (F.size(x) > 0) & finite & F.exists(x, lambda v: v != 0)


def nearest(rows: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", block_rows: int = 16_384, query_rows: int = 8_192, **options) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found vectors of every query.

    Ties go to the smaller id. Rows with a null id, or a vector that is null, empty, zero or
    holds null or non-finite components, take no part. Rows that share an id count once, with
    the least of their vectors; vectors meet only vectors of their own length. Fewer than
    ``k`` others: all of them. No usable rows: no result. Other columns are ignored.
    """
    vec = F.transform(F.col(vec_col), lambda v: v.cast("double"))
    good = rows.where(F.col(id_col).isNotNull() & usable(vec_col)).select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    good = cut(good.groupBy("id").agg(F.min("vec").alias("vec"), F.bool_or("asks").alias("asks")).withColumn("dim", F.size("vec")))
    n, asks = good.agg(F.count("*"), F.count_if("asks")).first()
    blocks, chunks = max(1, -(-n // block_rows)), max(1, -(-asks // query_rows))
    deal = lambda parts, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    index = good.select("dim", "id", "vec", deal(blocks, 1).alias("block"), every(chunks).alias("chunk"))
    wanted = good.where("asks").select("dim", "id", "vec", deal(chunks, 2).alias("chunk"), every(blocks).alias("block"))

    def table(t: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray]:
        vecs = t.column("vec").combine_chunks()
        return t.column("id").to_numpy(), np.asarray(vecs.flatten()).reshape(-1, dim)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.list_(pa.int64())), "score": pa.array([], pa.list_(pa.float64()))})
        if not left.num_rows or not right.num_rows:
            return empty
        dim = left.column("dim")[0].as_py()
        ids, x = table(left, dim)
        query_ids, q = table(right, dim)
        block = Block(ids, x, **options)
        found = [block.search(i, v, k) for i, v in zip(query_ids.tolist(), q, strict=True)]
        return pa.table({"query_id": pa.array(query_ids), "vec_id": pa.array([a.tolist() for a, _ in found], pa.list_(pa.int64())), "score": pa.array([s.tolist() for _, s in found], pa.list_(pa.float64()))})

    keys = ["dim", "block", "chunk"]
    found = index.groupBy(*keys).cogroup(wanted.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id array<long>, score array<double>")
    each = found.select("query_id", F.inline(F.arrays_zip("vec_id", "score")))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
