"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint takes the majority of every bit over the XXH64 values of its word
shingles. To link fingerprints that differ in at most ``radius`` bits, the 64 bits are cut
into ``segments``; two such fingerprints differ in at most ``radius // segments`` bits of
some segment. Each fingerprint is entered once in every segment's table and asks each
table for the small Hamming ball around its own segment; what it fetches is kept if the
whole fingerprints are close enough.

Equal fingerprints are one row throughout. Large groups of near copies would fetch each
other pair by pair, so stars are linked first: within each table entry every member is
compared with the entry's least and greatest member, and the components of these links
are labelled. The full search then keeps only pairs whose labels differ. It still
compares everything, but what it emits does not grow with the square of a group.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from loomwork.llm.kernels import map_arrow, pieces
from loomwork.operators.graph import components
from loomwork.session import cut

#: Bytes of a text taken at once.
_SEGMENT = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_FP = "_fp"
#: Keys of more than this share of all rows are hot; there are fewer than that many.
_HOT = 1024


def fingerprint(text: str | None, words: int = 4) -> int:
    """The 64-bit fingerprint of one text; 0 if it has no words."""
    raw, last = (text or "").encode().lower(), []
    votes, n, at = np.zeros(64, dtype=np.int64), 0, 0
    while at < len(raw):  # a long text segment by segment, each with the words that the next one's shingles need
        cut = _SPACE.search(raw, at + _SEGMENT)
        to = cut.start() if cut else len(raw)
        parts = last + raw[at:to].split()
        at, end = to, to == len(raw)
        if not parts or (len(parts) < words and not end):
            last = parts
            continue
        more, count = _votes(parts, min(words, len(parts)) if n == 0 else words)
        votes, n, last = votes + more, n + count, parts[len(parts) - words + 1 :] if len(parts) >= words else parts
    if not n and last:
        votes, n = _votes(last, len(last))
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big") if n else 0


def _votes(parts: list[bytes], k: int) -> tuple[np.ndarray, int]:
    """How many of the shingles of ``k`` words have each bit, and how many there are."""
    n = len(parts) - k + 1
    if n <= 0:
        return np.zeros(64, dtype=np.int64), 0
    flat = b" ".join(parts)
    size = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    end = np.cumsum(size + 1) - 1
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(flat[s:e], 42) for s, e in zip((end - size)[:n].tolist(), end[k - 1 :].tolist(), strict=True)], dtype=">u8")
    return np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64), n


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """``doc_id, fp``: the fingerprint of every whole text as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sub in pieces(batch, "text"):
                fp = np.array([fingerprint(t, words) for t in sub.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([sub.column(0), pa.array(fp)], names=["doc_id", "fp"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_arrow(slim, run, "doc_id long, fp long")


def _with_fingerprint(docs: DataFrame, words: int) -> DataFrame:
    """``docs`` with the fingerprint of every row's text in one more column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sub in pieces(batch, "text"):
                text = sub.column(sub.schema.get_field_index("text"))
                fp = np.array([fingerprint(t, words) for t in text.to_pylist()], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([*sub.columns, pa.array(fp)], names=[*sub.schema.names, _FP])

    return map_arrow(docs, run, StructType([*docs.schema.fields, StructField(_FP, LongType())]))


def _bounds(segments: int) -> list[tuple[int, int]]:
    cuts = [64 * i // segments for i in range(segments + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:], strict=False)]


def tune_segments(n: int, radius: int = 4) -> int:
    """Two or three segments, whichever has ``n`` fingerprints ask and fetch less.

    Three ask a tenth of what two do, but their shorter tables hold ever longer entries;
    from some 30 million fingerprints on two are cheaper. More segments would pay for small
    tables only, where the probes cost little anyway.
    """
    cost = lambda s: sum(sum(comb(width, k) for k in range(radius // s + 1)) * (1 + n / 2.0**width) for _, width in _bounds(s))
    return min((3, 2), key=cost)


def _segment(fp, lo: int, width: int):
    return F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _ball(width: int, radius: int) -> list[int]:
    ball = {0}
    for _ in range(radius):
        ball |= {x ^ (1 << b) for x in ball for b in range(width)}
    return sorted(ball)


def _far(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(fps: DataFrame, radius: int = 4, segments: int | None = None) -> DataFrame:
    """Pairs ``src, dst`` of distinct fingerprints that differ in at most ``radius`` bits.

    ``fps``: one column ``fp`` of distinct longs. Not every close pair comes back, but
    whatever is joined by a chain of close pairs is joined by a chain of returned ones.
    """
    segments = segments or tune_segments(fps.count(), radius)
    bounds = _bounds(segments)
    entry = F.explode(F.array(*[F.struct(F.lit(i).alias("seg"), _segment(F.col("fp"), lo, width).alias("val")) for i, (lo, width) in enumerate(bounds)]))
    table = cut(fps.select("fp", entry.alias("e")).select("fp", "e.seg", "e.val"))
    ends = table.groupBy("seg", "val").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi")
    star = table.join(ends, ["seg", "val"]).select("fp", F.explode(F.array("lo", "hi")).alias("other")).where((F.col("fp") != F.col("other")) & (_far("fp", "other") <= radius))
    star = cut(star.select(F.col("fp").alias("src"), F.col("other").alias("dst")).distinct())
    label = components(star).withColumnRenamed("node", "fp")
    left = cut(fps.join(label, "fp", "left").select("fp", F.coalesce("component", "fp").alias("label")))

    def probes(i: int, lo: int, width: int) -> DataFrame:
        ball = F.array(*[F.lit(x).cast("long") for x in _ball(width, radius // segments)])
        return left.select("fp", "label", F.lit(i).alias("seg"), _segment(F.col("fp"), lo, width).alias("own"), F.explode(ball).alias("flip")).select(
            F.col("fp").alias("src"), F.col("label").alias("src_label"), "seg", F.col("own").bitwiseXOR(F.col("flip")).alias("val")
        )

    asked = probes(0, *bounds[0])
    for i, b in enumerate(bounds[1:], 1):
        asked = asked.unionByName(probes(i, *b))
    held = left.select("fp", "label", entry.alias("e")).select(F.col("fp").alias("dst"), F.col("label").alias("dst_label"), "e.seg", "e.val")
    on = (asked.seg == held.seg) & (asked.val == held.val) & (asked.src < held.dst) & (asked.src_label != held.dst_label) & (F.bit_count(asked.src.bitwiseXOR(held.dst)) <= radius)
    return star.union(asked.join(held, on).select("src", "dst").distinct())


def _matched(rows: DataFrame, table: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` joined with ``table``, which has every key once and in ``_n`` its number of rows, ``total`` in all.

    Keys of over a ``_HOT``-th of all rows, fewer than ``_HOT`` by that very count, are
    broadcast; the rows of the others are dealt by key. No task gets the rows of a hot key.
    """
    hot = F.col("_n") * _HOT > total
    few = F.broadcast(table.where(hot).drop("_n"))
    rest = rows.join(few.select(key), key, "left_anti").join(table.where(~hot).drop("_n"), key)
    return rows.join(few, key).unionByName(rest)


def _groups(rows: DataFrame, radius: int, segments: int | None) -> DataFrame:
    """``fp, component, component_id, _n`` of every distinct fingerprint of ``rows``."""
    fps = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")))
    group = components(links(fps.select("fp"), radius, segments)).withColumnRenamed("node", "fp")
    named = cut(fps.join(group, "fp", "left").withColumn("component", F.coalesce("component", "fp")))
    least = cut(named.groupBy("component").agg(F.min("first").alias("component_id"), F.count("*").alias("_n")))
    return cut(_matched(named, least, "component", named.count()).select("fp", "component", "component_id", F.col("rows").alias("_n")))


def simhash(docs: DataFrame, words: int = 4, radius: int = 4, segments: int | None = None) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row.

    Texts without words (null, empty, blank) have fingerprint zero and are linked like any
    other. component_id: the smallest doc_id joined to the row by links, itself included;
    null if only null doc_ids are. Rows that repeat are returned as often as they occur; an
    empty table gives no rows; other columns are ignored. A long text is read segment by
    segment. ``segments``: by default as many as the number of fingerprints makes cheapest.
    """
    rows = cut(fingerprints(docs, words))
    named = _groups(rows, radius, segments).drop("component")
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return _matched(rows, named, "fp", rows.count()).select("doc_id", text.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 4, radius: int = 4, segments: int | None = None) -> DataFrame:
    """The rows of ``docs`` that stay: one of each near-duplicate group, the smallest doc_id.

    Each row is judged by its own text: of rows that repeat that doc_id within the group
    one stays, and a row without a doc_id stays only where its whole group has none. The
    columns are those of ``docs``, whatever their names; an empty table stays empty.
    """
    slim = cut(fingerprints(docs, words))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "fp")  # nulls last
    best = _matched(slim, _groups(slim, radius, segments).drop("component_id"), "fp", slim.count()).groupBy("component").agg(F.min(order).alias("best"))
    named = StructType([StructField(c if c == "text" else f"_{i}", t.dataType) for i, (c, t) in enumerate(zip(docs.columns, docs.schema, strict=True))])
    at = docs.columns.index("doc_id")
    rows = _with_fingerprint(docs.toDF(*named.names), words)  # names of our own can't clash
    best = best.select(F.col("best.doc_id").alias("keep_id"), F.col("best.fp").alias("keep_fp"))
    out = rows.join(best, (rows[_FP] == best["keep_fp"]) & rows[f"_{at}"].cast("long").eqNullSafe(best["keep_id"]))
    return out.dropDuplicates(["keep_fp"]).select(*named.names).toDF(*docs.columns)
