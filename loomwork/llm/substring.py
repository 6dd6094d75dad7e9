"""Substring dedup: MinHash banding of paragraphs, exact verification, removal by components.

Two kinds of paragraph are cut from every text:

* lines of at least ``min_words`` words, compared by the Jaccard similarity of their
  5-word shingles: bands of MinHash values propose pairs, the full shingle sets decide;
* blocks of ``BLOCK`` words that begin at content-defined anchors (the least 3-word hash
  of every ``SPAN`` consecutive ones), which also catch a passage in the middle of other
  text: any shared run of ``SPAN + BLOCK + 2`` words or more holds a common block. They
  are compared for equality, the band of all their shingles.

Equal contents are one row before anything is compared. Members of a band are compared
with the band's least and greatest member first; the pairwise search then decides only
pairs that are not yet in one component and whose one-bit MinHash sketches are near
enough for the similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.llm.kernels import Words, map_arrow, mix, pieces, shingles, sliding_min
from loomwork.operators.graph import components
from loomwork.session import cut, new_path

SPAN, BLOCK, SHINGLE, BITS = 24, 25, 5, 128
PART = 1024
UNITS = "h long, doc_id long, at int, size int, line boolean, bands array<long>, sketch array<long>"


def tune_bands(similarity: float = 0.8, recall: float = 0.99, most: int = 24) -> tuple[int, int]:
    """Bands and rows: the longest rows with which few enough hashes still reach the recall."""
    best = (1, 1)
    for rows in range(1, most + 1):
        for bands in range(1, most // rows + 1):
            if 1 - (1 - similarity**rows) ** bands >= recall:
                best = (bands, rows)
                break
    return best


def _lines(words: Words) -> np.ndarray:
    """Where lines begin, as word numbers, and the number of words as the last entry."""
    new = np.zeros(len(words.hash), dtype=bool)
    new[words.first[:-1][np.diff(words.first) > 0]] = True
    breaks = np.flatnonzero(words.raw == 10)
    after = np.searchsorted(words.start, breaks)
    new[after[after < len(new)]] = True
    return np.append(np.flatnonzero(new), len(new))


def _minhashes(s: np.ndarray, begin: np.ndarray, end: np.ndarray, count: int) -> np.ndarray:
    """``count`` MinHash values of every range of shingles."""
    out = np.empty((len(begin), count), dtype=np.uint64)
    edges = np.column_stack([begin, end]).ravel()
    if len(edges) and edges[-1] == len(s):
        s = np.append(s, np.uint64(0xFFFFFFFFFFFFFFFF))
    for j in range(count):
        out[:, j] = np.minimum.reduceat(mix(s + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)), edges)[::2]
    return out


def _content(words: Words, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the word sequence of every range."""
    weight = mix(np.arange(1, int((end - begin).max(initial=0)) + 1, dtype=np.uint64))
    flat = np.repeat(begin - np.cumsum(end - begin) + (end - begin), end - begin) + np.arange(int((end - begin).sum()))
    place = np.arange(len(flat)) - np.repeat(np.cumsum(end - begin) - (end - begin), end - begin)
    value = words.hash[flat] * weight[place]
    return mix(np.add.reduceat(value, np.cumsum(end - begin) - (end - begin)) if len(begin) else np.zeros(0, np.uint64))


def _line_ranges(words: Words, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    lines = _lines(words)
    keep = np.diff(lines) >= min_words
    return lines[:-1][keep], lines[1:][keep]


def _block_starts(words: Words) -> np.ndarray:
    """Words at which a block begins: anchors with ``BLOCK`` words left in their text."""
    tri = shingles(words.hash, 3)
    if len(tri) < SPAN:
        return np.zeros(0, dtype=np.int64)
    least = sliding_min(tri, SPAN)
    window = np.flatnonzero(words.row[: len(least)] == words.row[SPAN + 1 : SPAN + 1 + len(least)])
    # the first place in its window that holds the window's least value
    match = np.zeros(len(tri), dtype=bool)
    for step in range(SPAN):
        hit = tri[window + step] == least[window]
        match[window[hit] + step] = True
        window = window[~hit]
    at = np.flatnonzero(match)
    row = words.row[at]
    return at[at + BLOCK <= words.first[1:][row]]


def units(docs: DataFrame, min_words: int, bands: int, rows: int) -> DataFrame:
    """Every paragraph of every text: content hash, place, size, and the bands of a line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sub in pieces(batch, "text"):
                words = Words(sub.column(1))
                if not len(words.hash):
                    continue
                row = words.row
                begin, end = _line_ranges(words, min_words)
                s = shingles(words.hash, SHINGLE)
                most = max(bands * rows, BITS)
                sig = _minhashes(s, begin, end - SHINGLE + 1, most) if len(begin) else np.zeros((0, most), np.uint64)
                odd = np.packbits((sig[:, :BITS] >> np.uint64(17)).astype(np.uint8) & 1, axis=1).view(np.int64)
                band = np.zeros((len(begin), bands), dtype=np.uint64)
                for b in range(bands):
                    band[:, b] = np.uint64(b)
                    for r in range(rows):
                        band[:, b] = mix(band[:, b] * np.uint64(0x2545F4914F6CDD1D) + sig[:, b * rows + r])
                block = _block_starts(words)
                at, size = np.concatenate([begin, block]), np.concatenate([end - begin, np.full(len(block), BLOCK)])
                h = _content(words, at, at + size)
                h[len(begin) :] = mix(h[len(begin) :] + np.uint64(77))
                offsets = np.concatenate([np.arange(len(begin) + 1) * bands, np.full(len(block), len(begin) * bands)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h.view(np.int64)), sub.column(0).take(pa.array(row[at])), pa.array((at - words.first[:-1][row[at]]).astype(np.int32)), pa.array(size.astype(np.int32)),
                        pa.array(np.arange(len(at)) < len(begin)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(band.ravel().view(np.int64))),
                        pa.ListArray.from_arrays(pa.array(offsets // bands * (BITS // 64)), pa.array(np.ascontiguousarray(odd).ravel())),
                    ],
                    names=["h", "doc_id", "at", "size", "line", "bands", "sketch"],
                )

    return map_arrow(docs, run, UNITS)


def _shingle_sets(docs: DataFrame, min_words: int) -> DataFrame:
    """``h, set``: the distinct shingle hashes of every line, by its content hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sub in pieces(batch, "text"):
                words = Words(sub.column(1))
                begin, end = _line_ranges(words, min_words)
                if not len(begin):
                    continue
                s = shingles(words.hash, SHINGLE).view(np.int64)
                sets = [np.unique(s[a : b - SHINGLE + 1]) for a, b in zip(begin, end, strict=True)]
                offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_content(words, begin, end).view(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))], names=["h", "set"]
                )

    return map_arrow(docs, run, "h long, set array<long>")


def _near(a: str, b: str, similarity: float) -> Column:
    """Whether one-bit MinHash sketches differ in few enough bits for the similarity, with three deviations to spare."""
    p = (1 - similarity) / 2
    most = int(BITS * p + 3 * (BITS * p * (1 - p)) ** 0.5)
    return sum(F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(BITS // 64)) <= most


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose exact Jaccard similarity reaches the threshold."""
    both = pairs.join(sets.select(F.col("h").alias("src"), F.col("set").alias("a")), "src").join(sets.select(F.col("h").alias("dst"), F.col("set").alias("b")), "dst")
    sizes = (F.least(F.size("a"), F.size("b")) >= similarity * F.greatest(F.size("a"), F.size("b"))).alias("ok")
    common = F.size(F.array_intersect("a", "b"))
    return both.where(sizes).where(common >= similarity * (F.size("a") + F.size("b") - common) - 1e-9).select("src", "dst")


def _open_members(shared: DataFrame, links: DataFrame) -> DataFrame:
    """``key, n, h, label`` of the bands that still hold several components of ``links``."""
    label = components(links).withColumnRenamed("node", "h")
    members = cut(shared.select("key", "n", "h").join(label, "h", "left").select("key", "n", "h", F.coalesce("component", "h").alias("label")))
    mixed = members.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("key")
    return cut(members.join(mixed, "key"))


def _meet(a: DataFrame, b: DataFrame, on: list[str], facts: DataFrame, bands: int, similarity: float) -> DataFrame:
    """Links between rows of different components that meet on ``on``.

    Pairs are decided where they meet, so only links are rows: components, then whether
    ``key`` is the first band the two share (each pair is decided once), then sketches, sizes, and
    the exact similarity of ``facts``: h, bands, sketch, set.
    """
    names = ["label", "bands", "sketch", "set"]
    left = a.join(facts, "h").select(*on, F.col("h").alias("src"), *[F.col(c).alias(f"{c}_a") for c in names])
    right = b.join(facts, "h").select(*on, F.col("h").alias("dst"), *[F.col(c).alias(f"{c}_b") for c in names])
    first = F.coalesce(*[F.when(F.col("bands_a")[i] == F.col("bands_b")[i], F.col("bands_a")[i]) for i in range(bands)]) == F.col("key")
    m, n = F.size("set_a"), F.size("set_b")
    same = F.size(F.array_intersect("set_a", "set_b")) * (1 + similarity) >= similarity * (m + n) - 1e-9
    near = (F.col("src") < F.col("dst")) & (F.col("label_a") != F.col("label_b")) & first & _near("sketch_a", "sketch_b", similarity) & (F.least(m, n) >= similarity * F.greatest(m, n)) & same
    return left.join(right, on).where(near).select("src", "dst")


def near_lines(distinct: DataFrame, docs: DataFrame, min_words: int, similarity: float) -> DataFrame:
    """Links ``src, dst`` between contents of lines; ``distinct``: h, first (doc_id, at), bands, sketch.

    First every member of a band against its least and greatest, then all pairs of a band
    that are in different components of these links. The second search splits a band into
    parts of about ``PART`` rows, so that no task holds a large band; a band of n lines that
    nothing links takes n * n comparisons.
    """
    bands = distinct.select(F.size("bands").alias("n")).first()
    if bands is None:
        return distinct.select(F.col("h").alias("src"), F.col("h").alias("dst"))
    table = distinct.select("h", F.explode("bands").alias("key"))
    ends = table.groupBy("key").agg(F.min("h").alias("lo"), F.max("h").alias("hi"), F.count("*").alias("n")).where("lo <> hi")
    shared = cut(table.join(ends, "key"))
    some = shared.select("h").distinct().join(distinct.select("h", F.col("first.doc_id").alias("doc_id")), "h").select("doc_id").distinct()
    texts = docs.join(some, "doc_id", "left_semi")
    sets = cut(_shingle_sets(texts, min_words).join(shared.select("h").distinct(), "h", "left_semi").dropDuplicates(["h"]))
    star = shared.select(F.col("h").alias("src"), F.explode(F.array("lo", "hi")).alias("dst")).where("src <> dst").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()
    links = cut(_verified(star, sets, similarity))
    facts = distinct.select("h", "bands", "sketch").join(sets, "h")
    members = _open_members(shared, links)
    parts = F.ceil(F.col("n") / PART)
    whole = members.withColumn("part", F.pmod(F.xxhash64("h"), parts)), members.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    return links.union(_meet(*whole, ["key", "part"], facts, bands["n"], similarity))


def _written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder: lineage is cut and later reads take only their columns."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def repeats(docs: DataFrame, min_words: int = 20, similarity: float = 0.8, recall: float = 0.99) -> DataFrame:
    """``doc_id, class_id, n_repeats, n_removed, removed_words, spans`` of every document with a repeated paragraph.

    class_id: the smallest doc_id that holds one of its repeated paragraphs first;
    n_repeats: its paragraphs that occur in other documents too; n_removed: those of which an earlier
    place (by doc_id, then word) is kept; spans: the word ranges "start:end" to remove,
    merged. Null and empty texts have no paragraphs; rows without doc_id are left out; rows
    that share a doc_id are one document, and equal texts among them repeat nothing; an empty table
    gives no rows; other columns are ignored. Ties cannot occur: places differ.

    What is found: every run of ``SPAN + BLOCK + 2`` (51) equal words that two documents
    share, wherever it stands, and with the recall of the bands every pair of lines of
    ``min_words`` words or more whose similarity reaches the threshold. What is not: lines
    that are shorter, near copies of passages inside longer, otherwise different lines
    (only their equal runs), and repeats within one document. A long text costs a small
    multiple of its bytes, one of its lines a set of its shingles.
    """
    bands, rows = tune_bands(similarity, recall)
    slim = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    place = F.struct("doc_id", "at")
    found = _written(units(slim, min_words, bands, rows), "paragraphs")
    seen = found.select("h", "doc_id", "at", "size")
    distinct = _written(found.where("line").groupBy("h").agg(F.min(place).alias("first"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "lines")
    links = cut(near_lines(distinct, slim, min_words, similarity))
    contents = seen.groupBy("h").agg(F.min(place).alias("first"), F.max("doc_id").alias("last"))
    if links.take(1):
        label = components(links).withColumnRenamed("node", "h")
        contents = contents.join(label, "h", "left").where("component is not null or first.doc_id <> last").select("h", F.coalesce("component", "h").alias("c"), "first", "last")
    else:
        contents = contents.where("first.doc_id <> last").select("h", F.col("h").alias("c"), "first", "last")
    contents = cut(contents)
    classes = contents.groupBy("c").agg(F.min("first").alias("kept"), F.max("last").alias("last")).where("kept.doc_id <> last").select("c", "kept")
    hit = seen.join(contents.select("h", "c").join(classes, "c").select("h", "kept"), "h").select("doc_id", "at", "size", F.col("kept.doc_id").alias("class_id"), (place != F.col("kept")).alias("gone"))
    hit = hit.repartition("doc_id").distinct()  # the one shuffle serves the sums by document too
    spans = F.array_sort(F.collect_set(F.when(F.col("gone"), F.struct(F.col("at").alias("s"), (F.col("at") + F.col("size")).alias("e")))))
    per = hit.groupBy("doc_id").agg(F.min("class_id").alias("class_id"), F.count("*").alias("n_repeats"), F.count_if("gone").alias("n_removed"), spans.alias("spans"))
    merged = F.expr(
        """aggregate(spans, cast(array() as array<struct<s:int,e:int>>), (acc, x) ->
             case when size(acc) > 0 and element_at(acc, -1).e >= x.s
                  then array_append(slice(acc, 1, size(acc) - 1), struct(element_at(acc, -1).s as s, greatest(element_at(acc, -1).e, x.e) as e))
                  else array_append(acc, x) end)"""
    )
    out = per.withColumn("spans", merged)
    return out.select(
        "doc_id", "class_id", "n_repeats", "n_removed",
        F.expr("aggregate(spans, 0L, (n, x) -> n + x.e - x.s)").alias("removed_words"),
        F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["s"].cast("string"), x["e"].cast("string"))), ",").alias("spans"),
    )
