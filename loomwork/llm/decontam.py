"""Benchmark decontamination by latent semantic retrieval and subsequence checks.

1. Distributed randomised SVD of the corpus' TF-IDF passages (runs of ``PASSAGE`` words),
   in two passes over all texts. The first counts the documents of each hashed word and
   adds every passage to a random column, with a random sign, of a words x ``SKETCH``
   matrix; scaled by inverse document frequency and made orthonormal it spans the range
   (Q). The second projects every passage onto it and sums the products B B', B = Q'A,
   whose eigenvectors turn Q into the left singular vectors. The first ``COMMON`` (what
   all passages of a language share) are left out, the next ``RANK`` scaled alike.
2. A word's latent vector is its row of that basis times its weight, a run of words is
   the sum of its words. Windows of each benchmark item's length begin at every
   ``STEP``-th word of a text; those whose cosine with an item reaches ``cosine`` are
   candidates. Only windows near an anchor are looked at, and candidates that can't pass
   step 3 are dropped by counting words: neither loses a match. Anchors are an item's
   rarest words, so many that a text with none of them can't match.
3. A candidate is confirmed where a longest common subsequence holds at least ``copy`` of
   the item's words, or at least ``paraphrase`` of them and its answer, the last ``ANSWER``
   words of the item, all but one of them in order.

Windows are laid in every text for itself, so a result depends on nothing but the text,
the items and the corpus statistics. Words are taken in runs of bounded length, so the
longest text costs a small multiple of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.kernels import Words, map_arrow, mix, pieces
from loomwork.llm.sums import dense_sum
from loomwork.session import new_path

BINS, SKETCH, RANK, COMMON, PASSAGE, STEP, ANSWER = 1 << 12, 96, 32, 24, 64, 4, 5
#: Columns of the first pass beside the sketch that count words in finer bins, for the choice of anchors.
FINE = 64
_RUN, _PAIRS = 1 << 16, 1 << 17


def _words(col: pa.Array) -> tuple[Words, np.ndarray]:
    words = Words(col, lower=True, split="alnum")
    return words, (words.hash >> np.uint64(9)).astype(np.int64) % BINS


def _fine(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(21)).astype(np.int64) % (BINS * FINE)


def _places(a: list[int]) -> dict[int, int]:
    """For each word of ``a`` the bits of its places."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | (1 << i)
    return masks


def _common(masks: dict[int, int], size: int, b: list[int]) -> int:
    full = (1 << size) - 1
    v = full
    for x in b:
        if x in masks:
            u = v & masks[x]
            v = ((v + u) | (v - u)) & full
    return size - v.bit_count()


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    return _common(_places(a), len(a), b)


def _ranges(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which range each number belongs to, and the numbers, of ranges laid one after another."""
    of = np.repeat(np.arange(len(begin)), size)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size) + begin[of]


def _passages(words: Words) -> np.ndarray:
    """The number of each word's passage within its text."""
    return (np.arange(len(words.hash)) - words.first[:-1][words.row]) // PASSAGE


def _sketch_pass(texts: DataFrame) -> np.ndarray:
    """BINS x (SKETCH + 2 + FINE): the range sketch, documents by bin, texts (first row), words by finer bin."""

    def add(total: np.ndarray, batch: pa.RecordBatch) -> None:
        for sub in pieces(batch, "text"):
            words, f = _words(sub.column(0))
            total[0, SKETCH + 1] += sub.num_rows
            if not len(f):
                continue
            row, passage = words.row, _passages(words)
            total[:, SKETCH] += np.bincount(np.unique(row * BINS + f) % BINS, minlength=BINS)
            head = words.hash[words.first[:-1][row] + passage * PASSAGE]
            h = mix(head + passage.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            column, sign = (h % np.uint64(SKETCH)).astype(np.int64), np.where((h >> np.uint64(50)) & np.uint64(1), 1.0, -1.0)
            for at in range(0, len(f), _RUN * 4):
                some = slice(at, at + _RUN * 4)
                total[:, :SKETCH] += np.bincount(f[some] * SKETCH + column[some], sign[some], minlength=BINS * SKETCH).reshape(BINS, SKETCH)
                total[:, SKETCH + 2 :] += np.bincount(_fine(words.hash[some]), minlength=BINS * FINE).reshape(BINS, FINE)

    return dense_sum(texts, add, (BINS, SKETCH + 2 + FINE))


def _gram_pass(texts: DataFrame, weighted: np.ndarray) -> np.ndarray:
    """B B' over all passages; ``weighted``: Q, its rows times their weights."""
    padded = np.concatenate([weighted, np.zeros((1, SKETCH), weighted.dtype)])

    def add(total: np.ndarray, batch: pa.RecordBatch) -> None:
        for sub in pieces(batch, "text"):
            words, f = _words(sub.column(0))
            if not len(f):
                continue
            at = np.arange(len(f)) - words.first[:-1][words.row]
            begin = np.append(np.flatnonzero(at % PASSAGE == 0), len(f))
            f = np.append(f, np.full(PASSAGE, BINS))
            for lo in range(0, len(begin) - 1, 64):
                edge = begin[lo : lo + 65, None]
                word = edge[:-1] + np.arange(PASSAGE)
                b = padded[np.where(word < edge[1:], f[word], BINS)].sum(axis=1)
                total += b.T @ b

    return dense_sum(texts, add, (SKETCH, SKETCH))


def latent_space(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Latent vectors of all word bins (BINS x RANK), and how often words of each finer bin occur."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    total = _sketch_pass(texts)
    df, n = total[:, SKETCH], max(1.0, float(total[0, SKETCH + 1]))
    idf = np.maximum(0.0, np.log((n + 1) / (df + 1)))[:, None]
    q, _ = np.linalg.qr(idf * total[:, :SKETCH].astype(np.float64))
    values, turn = np.linalg.eigh(_gram_pass(texts, (idf * q).astype(np.float32)).astype(np.float64))
    lead = np.argsort(-values)[COMMON : COMMON + RANK]
    scale = np.sqrt(max(values.max(), 1e-9) / np.maximum(values[lead], 1e-9 * max(values.max(), 1e-9)))
    return (idf * (q @ turn[:, lead]) * scale).astype(np.float32), total[:, SKETCH + 2 :].ravel()


class Finder:
    """Looks for a block of benchmark items in texts."""

    def __init__(self, items: list[tuple[int, str]], latent: np.ndarray, often: np.ndarray, cosine: float, copy: float, paraphrase: float):
        self.axes, self.cosine, self.copy, self.paraphrase = np.ascontiguousarray(latent.T), cosine, copy, paraphrase
        self.item_ids = [i for i, _ in items]
        words, f = _words(pa.array([t for _, t in items], pa.string()))
        self.known, name = np.unique(words.hash, return_inverse=True)
        self.name, self.first = name.astype(np.int32), words.first
        self.size = np.diff(words.first)
        self.need = np.ceil(np.outer((copy, paraphrase), self.size) - 1e-9).astype(np.int64)
        vec = np.zeros((len(items), latent.shape[1]), dtype=np.float32)
        np.add.at(vec, words.row, latent[f])
        self.vec = vec / np.maximum(1e-9, np.sqrt((vec * vec).sum(axis=1, keepdims=True)))
        self.slack = np.maximum(STEP * 2, self.size // 4)
        self._anchor(often[_fine(words.hash)])
        #: A table that holds (item, word) pairs by hash: says no only where an item lacks a word.
        self.bits = max(16, int(np.ceil(np.log2(len(name) + 1))) + 6)
        self.has = np.zeros(1 << self.bits, dtype=bool)
        self.has[self._pair(words.row, self.name)] = True
        self.answer = np.minimum(ANSWER, self.size)
        self.low = np.zeros(1 << 16, dtype=bool)
        self.low[(self.known & np.uint64(0xFFFF)).astype(np.int64)] = True
        self._masks: dict[int, dict[int, int]] = {}

    def _pair(self, item: np.ndarray, name: np.ndarray) -> np.ndarray:
        return (mix(item.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + name.astype(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _anchor(self, often: np.ndarray) -> None:
        """Items by anchor word. A copy shares ``need`` of n words, so one of the n - need + 1 rarest; a paraphrase
        all but one word of the answer, so one of its two rarest, and of the rarest of all words besides."""
        pairs = []
        for i, (n, at) in enumerate(zip(self.size.tolist(), self.first.tolist(), strict=False)):
            if not n:
                continue
            rare = np.argsort(often[at : at + n], kind="stable")
            answer = rare[rare >= n - ANSWER][: min(2, n)]
            chosen = rare[: n - self.need[0, i] + 1]
            loose = rare[: n - self.need[1, i] + 1]
            heavy = often[at + answer].sum() > often[at + loose].sum()
            pairs += [(x, i) for x in np.unique(self.name[at + np.concatenate([chosen, loose if heavy else answer])]).tolist()]
        pairs.sort()
        self.anchor_items = np.array([i for _, i in pairs], dtype=np.int64)
        self.anchor_first = np.searchsorted(np.array([x for x, _ in pairs], dtype=np.int64), np.arange(len(self.known) + 1))

    def names(self, h: np.ndarray) -> np.ndarray:
        """The number of every word that some item holds, -1 for others."""
        out = np.full(len(h), -1, dtype=np.int32)
        if len(self.known):
            may = np.flatnonzero(self.low[(h & np.uint64(0xFFFF)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.known, h[may]), len(self.known) - 1)
            out[may] = np.where(self.known[at] == h[may], at, -1)
        return out

    def windows(self, names: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Items and starts (word numbers, ascending) of all windows that, slack included, hold an anchor of the item."""
        at = np.flatnonzero(names >= 0)
        some = self.anchor_first[names[at] + 1] - self.anchor_first[names[at]]
        at, some = at[some > 0], some[some > 0]
        ends, lo = np.cumsum(some), 0
        while lo < len(at):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + _PAIRS // 4, "right")))
            yield self._windows(at[lo:hi], some[lo:hi], names, first)
            lo = hi

    def _windows(self, at: np.ndarray, some: np.ndarray, names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        of, entry = _ranges(self.anchor_first[names[at]], some)
        place, item = at[of], self.anchor_items[entry]
        text = np.searchsorted(first, place, "right") - 1
        begin = first[text]
        # windows [s, s + n), s a multiple of STEP from the text's begin, with s - slack <= place < s + n + slack
        lo = np.maximum(0, -(-(place - begin - self.size[item] - self.slack[item] + 1) // STEP))
        hi = np.minimum(place - begin + self.slack[item], first[text + 1] - begin - 1) // STEP
        of, step = _ranges(lo, np.maximum(0, hi - lo + 1))
        key = np.unique((begin[of] + step * STEP) * len(self.size) + item[of])
        return key % len(self.size), key // len(self.size)

    def near(self, f: np.ndarray, item: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which windows' cosine with their item reaches the bound; starts ascend."""
        out, a = np.zeros(len(item), dtype=bool), 0
        while a < len(item):
            base = int(start[a])
            b = int(np.searchsorted(start, base + _RUN))
            run = f[base : int(end[a:b].max())]
            sums = np.zeros((len(self.axes), len(run) + 1))
            for axis, total in zip(self.axes, sums, strict=True):
                np.cumsum(axis[run], out=total[1:])
            for lo in range(a, b, _PAIRS // 4):
                some = slice(lo, min(b, lo + _PAIRS // 4))
                win = sums[:, end[some] - base] - sums[:, start[some] - base]
                norm = np.sqrt(np.einsum("ij,ij->j", win, win))
                out[some] = np.einsum("ij,ji->j", win, self.vec[item[some]]) >= self.cosine * np.maximum(norm, 1e-6)
            a = b
        return out

    def enough(self, names: np.ndarray, item: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Which ranges hold enough words of their item, repeats bounded by the item's, for a copy or a paraphrase."""
        out = np.zeros(len(item), dtype=bool)
        width = hi - lo
        ends = np.cumsum(width)
        at = 0
        while at < len(item):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PAIRS * 4, "right")))
            of, place = _ranges(lo[at:to], width[at:to])
            name = names[place]
            keep = np.flatnonzero(name >= 0)
            of, name = of[keep], name[keep]
            keep = self.has[self._pair(item[at:to][of], name)]
            of, name = of[keep], name[keep]
            least = self.need.min(axis=0)[item[at:to]]
            rough = np.bincount(of, minlength=to - at) >= least
            keep = rough[of]
            key, count = np.unique(of[keep].astype(np.int64) * len(self.known) + name[keep], return_counts=True)
            of, name = key // len(self.known), key % len(self.known)
            good = np.flatnonzero(rough)
            for i in good.tolist():
                a, b = np.searchsorted(of, (i, i + 1))
                out[at + i] = self._may(int(item[at + i]), name[a:b], count[a:b])
            at = to
        return out

    def _may(self, item: int, name: np.ndarray, count: np.ndarray) -> bool:
        own = self.name[self.first[item] : self.first[item + 1]]
        have = np.zeros(0, dtype=np.int64)
        kinds, times = np.unique(own, return_counts=True)
        at = np.minimum(np.searchsorted(name, kinds), max(0, len(name) - 1))
        have = np.where(name[at] == kinds, np.minimum(times, count[at]), 0) if len(name) else np.zeros(len(kinds), np.int64)
        total = int(have.sum())
        if total >= self.need[0, item]:
            return True
        k = int(self.answer[item])
        return total >= self.need[1, item] and int(np.isin(own[-k:], kinds[have > 0]).sum()) >= k - 1

    def check(self, i: int, text: list[int]) -> tuple[float, str] | None:
        """Share of item ``i`` in a run of words (their numbers), and how it was found."""
        own = self.name[self.first[i] : self.first[i + 1]].tolist()
        if i not in self._masks:
            if len(self._masks) > 4_096:
                self._masks.clear()
            self._masks[i] = _places(own)
        found = _common(self._masks[i], len(own), text)
        if found >= self.need[0, i]:
            return found / len(own), "copy"
        answer = own[-ANSWER:]
        if found >= self.need[1, i] and lcs(answer, text) >= len(answer) - 1:
            return found / len(own), "paraphrase"
        return None

    def find(self, col: pa.Array) -> dict[tuple[int, int], tuple[float, str]]:
        """(text, item): best share and kind."""
        words, f = _words(col)
        out: dict[tuple[int, int], tuple[float, str]] = {}
        names = self.names(words.hash)
        for item, start in self.windows(names, words.first):
            text = np.searchsorted(words.first, start, "right") - 1
            keep = self.near(f, item, start, np.minimum(start + self.size[item], words.first[text + 1]))
            item, start, text = item[keep], start[keep], text[keep]
            lo = np.maximum(words.first[text], start - self.slack[item])
            hi = np.minimum(words.first[text + 1], start + self.size[item] + self.slack[item])
            keep = self.enough(names, item, lo, hi)
            for i, t, a, b in zip(*(x[keep].tolist() for x in (item, text, lo, hi)), strict=True):
                best = out.get((t, i), (0,))[0]
                if best < 1 and (hit := self.check(i, names[a:b].tolist())) and hit[0] > best:
                    out[t, i] = hit
        return out


def _finders(docs: DataFrame, benchmark: DataFrame, cosine: float, copy: float, paraphrase: float, block_items: int) -> Iterator[Finder]:
    """A finder for each block of items that has any words."""
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    blocks = -(-items.count() // block_items)
    latent, often = latent_space(docs) if blocks else (None, None)
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        finder = Finder([(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()], latent, often, cosine, copy, paraphrase)
        if finder.size.any():
            yield finder


def matches(docs: DataFrame, benchmark: DataFrame, cosine: float = 0.1, copy: float = 0.8, paraphrase: float = 0.6, block_items: int = 16_384) -> DataFrame:
    """``doc_id, item_id, share, kind`` of every document and benchmark item found in it.

    Items are indexed by their anchors, so one pass over the texts looks for a whole block of
    ``block_items``; each further block is another pass, written before the next begins, so
    the driver holds one block. Null texts and texts without words hold nothing and items
    without words are found nowhere; items that repeat an item_id are each looked for;
    documents that share a doc_id are one; rows without doc_id or item_id come back with a
    null; of equal shares the kind "paraphrase" is kept. Empty tables give no rows; other
    columns are ignored.
    """
    kind = "doc_id long, item_id long, share double, kind string"
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    out = None
    for finder in _finders(docs, benchmark, cosine, copy, paraphrase, block_items):
        found = map_arrow(slim, _runner(finder), kind)
        if out is not None:
            path = new_path(docs.sparkSession, "matches")
            out.write.parquet(path)
            found = docs.sparkSession.read.parquet(path).union(found)
        out = found
    out = docs.sparkSession.createDataFrame([], kind) if out is None else out
    return out.groupBy("doc_id", "item_id").agg(F.max(F.struct("share", "kind")).alias("x")).select("doc_id", "item_id", F.round("x.share", 6).alias("share"), "x.kind")


def _runner(finder: Finder):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sub in pieces(batch, "text"):
                hits = finder.find(sub.column(1))
                if hits:
                    doc = pa.array([d for d, _ in hits], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [sub.column(0).take(doc), pa.array([finder.item_ids[i] for _, i in hits], pa.int64()), pa.array([s for s, _ in hits.values()], pa.float64()), pa.array([k for _, k in hits.values()])],
                        names=["doc_id", "item_id", "share", "kind"],
                    )

    return run


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, cosine: float = 0.1, copy: float = 0.8, paraphrase: float = 0.6, block_items: int = 16_384) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, with the same columns; each row is judged by its own text."""
    out = docs
    for finder in _finders(docs, benchmark, cosine, copy, paraphrase, block_items):
        out = map_arrow(out, _cleaner(finder), docs.schema)
    return out


def _cleaner(finder: Finder):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sub in pieces(batch, "text"):
                keep = np.ones(sub.num_rows, dtype=bool)
                for d, _ in finder.find(sub.column(sub.schema.get_field_index("text"))):
                    keep[d] = False
                yield sub.filter(pa.array(keep))

    return run
