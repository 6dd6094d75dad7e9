"""Token ids of whole texts, and their Simple-8b word-aligned files.

``Encoder`` gives the same ids as encoding each whole text at once. The last character of
a run of white space never joins the token before it where other text follows, so a text
may be cut there; each batch's distinct pieces are looked up in a table of pieces seen
before, and only new ones are encoded. Texts that hold a special token's string are
encoded whole.

The written table is a Parquet folder, which any shared file system takes and Spark reads
back by itself: one row a shard, with ``part`` (which range of doc_id), ``before`` (ids of
that part before this shard), ``ids`` (ids in it) as its index, and the shard's bytes.

Shard format ("S8B1", little-endian)::

    magic 4s | documents u32 | ids u64 | block u32 | blocks u32
    doc_id i64 * documents | ids of each document u32 * documents
    offsets u32 * (blocks + 1), in words | words u64 * offsets[-1]

Ids run through all documents of a shard and are cut into blocks of ``block`` ids. Each
64-bit word has a selector in its low 4 bits, then that selector's count of values.
A block with a value of over 60 bits is escaped: a word with selector 0, then raw values.
"""

from __future__ import annotations

import struct
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import compress, filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.llm.kernels import map_arrow, pieces, text_bytes
from loomwork.session import new_path

#: Values a word, bits a value, by selector; 0 is the escape.
COUNTS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 120], dtype=np.int64)
BITS = np.array([64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 0], dtype=np.int64)
BLOCK = 128
HEAD = struct.Struct("<4sIQII")

#: Blanks and line ends, before which a text may be cut, and all ASCII white space.
_CUT = np.zeros(256, dtype=bool)
_CUT[[32, 10]] = True
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, *range(9, 14)]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[10] = 32
#: First bytes of the multi-byte white space characters.
_WIDE = np.zeros(256, dtype=bool)
_WIDE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
#: Pieces looked up at once, and the bytes that one entry of the table takes besides its key and ids.
_CHUNK, _ENTRY = 1 << 20, 150
#: Bytes of the table of pieces while tokens are written: about 1.4 million pieces, which a worker doesn't encode again.
ROOM = 224 << 20


def _wide_blank(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a multi-byte white space character begins at each place."""
    a, b, c = (raw[np.minimum(at + k, len(raw) - 1)] for k in range(3))
    general = (b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & (c == 0x9F)
    return (a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE2) & general | (a == 0xE3) & (b == 0x80) & (c == 0x80)


def cut_places(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Where pieces begin: at every text, every blank or line end that no white space follows, every ASCII mark after an ASCII letter."""
    edge = np.zeros(len(raw) + 1, dtype=bool)
    np.logical_and(_LETTER[raw[:-1]], _MARK[raw[1:]], out=edge[1 : len(raw)])
    at = np.flatnonzero(_CUT[raw[:-1]])
    after = raw[at + 1]
    ok = ~_BLANK[after]
    wide = np.flatnonzero(_WIDE[after])
    ok[wide[_wide_blank(raw, at[wide] + 1)]] = False
    first = np.zeros(len(raw) + 1, dtype=bool)
    first[offs] = True
    edge[at[ok & ~first[at + 1]]] = True
    return np.flatnonzero(edge | first)


class Encoder:
    """Ids of whole texts by a ``tokenizers`` file: what ``encode(text, add_special_tokens=False)`` gives.

    Special tokens' strings in a text become their ids, as the library does by default;
    with ``special_text`` they are ordinary text. ``room``: bytes that the table of pieces
    may take before it is begun anew (one batch's new pieces come on top).
    """

    def __init__(self, path: str, special_text: bool = False, room: int = 96 << 20):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_text
        self.room = room
        self.special = [] if special_text else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.blanks = bool(self.tokenizer.encode(" ", add_special_tokens=False).ids)
        size = self.tokenizer.get_vocab_size()
        names = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.bytes, self.ends = np.array(list(map(len, names)), dtype=np.int64), np.array([x.endswith("</w>") for x in names])
        self._clear()

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.taken = 0
        self.flat, self.used = np.zeros(1 << 18, np.uint32), 0
        self.begin, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def _learn(self, keys: list[bytes]) -> None:
        """Enters new pieces and their ids; most are encoded many at once, as one text."""
        apart = self._begins if self.blanks else self._one_word
        plain = [k[0] == 32 and k[1:].isalpha() for k in keys]  # a blank and ASCII letters: either way the commonest
        many, few = list(compress(keys, plain)), []
        for k in filterfalse(set(many).__contains__, keys) if len(many) < len(keys) else ():
            (many if apart(k) else few).append(k)
        for at in range(0, len(many), 20_000):
            some = many[at : at + 20_000]
            ids = np.array(self.tokenizer.encode_batch_fast([b"".join(some).decode()], add_special_tokens=False)[0].ids, dtype=np.uint32)
            if self.blanks:
                ends = np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum(list(map(len, some)))) + 1
            else:
                ends = np.flatnonzero(self.ends[ids]) + 1
            self._enter(some, ids, np.diff(ends, prepend=0))
        for at in range(0, len(few), 2_000):
            some = few[at : at + 2_000]
            ids = [e.ids for e in self.tokenizer.encode_batch_fast([k.decode() for k in some], add_special_tokens=False)]
            self._enter(some, np.array([x for i in ids for x in i], dtype=np.uint32), np.array(list(map(len, ids)), dtype=np.int64))

    @staticmethod
    def _begins(key: bytes) -> bool:
        """Whether a piece begins with one white space character and other text, so that no token joins it with a piece before."""
        if key[0] not in b" \n" or len(key) == 1:
            return False
        return not _BLANK[key[1]] if key[1] < 128 else not key[1:].decode()[0].isspace()

    @staticmethod
    def _one_word(key: bytes) -> bool:
        """Whether a piece is a blank and one word, whose last token is the only one that ends a word."""
        if key[0] != 32:
            return False
        return key[1:].isalpha() or (not key.isascii() and unicodedata.normalize("NFC", key[1:].decode()).lower().isalpha())

    def _enter(self, keys: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, to = len(self.known), self.used + len(ids)
        if to > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(max(to, len(self.flat)), np.uint32)])
        if n + len(keys) > len(self.begin):
            more = np.zeros(max(n + len(keys), len(self.begin)), np.int64)
            self.begin, self.size = np.concatenate([self.begin[:n], more]), np.concatenate([self.size[:n], more])
        self.flat[self.used : to] = ids
        self.begin[n : n + len(keys)] = self.used + np.cumsum(sizes) - sizes
        self.size[n : n + len(keys)] = sizes
        self.known.update(zip(keys, range(n, n + len(keys)), strict=True))
        self.taken += sum(map(len, keys)) + _ENTRY * len(keys) + 4 * len(ids)
        self.used = to

    def _slots(self, raw: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """The table entry of every piece; each distinct piece is looked up once."""
        body = pa.py_buffer(np.ascontiguousarray(raw[cuts[0] : cuts[-1]]))
        found = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts - cuts[0]).astype(np.int32)), body]).dictionary_encode()
        keys = found.dictionary.to_numpy(zero_copy_only=False).tolist()  # bytes, many times faster than to_pylist
        if self.taken > self.room:
            self._clear()
        slot = list(map(self.known.get, keys))
        if None in slot:
            self._learn([k for k, at in zip(keys, slot, strict=True) if at is None])
            slot = list(map(self.known.__getitem__, keys))
        return np.array(slot, dtype=np.int64)[found.indices.to_numpy()]

    def batch(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after another (uint32), and the number of ids of each text."""
        if col.null_count:
            col = col.fill_null("")
        marked = [pc.match_substring(col, t).to_numpy(zero_copy_only=False) for t in self.special]
        if marked and np.any(marked):
            return self._one_by_one(col, np.any(marked, axis=0))
        raw, offs = text_bytes(col)
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(col), np.int64)
        cuts, parts, counts = cut_places(raw, offs), [], []
        if not self.blanks:  # case and white space don't count; a letter before a combining mark is left as it is
            raw = np.where(np.append(raw[1:], 0) < 128, _LOWER[raw], raw)
        for at in range(0, len(cuts) - 1, _CHUNK):
            slot = self._slots(raw, cuts[at : at + _CHUNK + 1])
            begin, size = self.begin[slot], self.size[slot]
            end = np.cumsum(size)
            parts.append(self.flat[np.repeat(begin - (end - size), size) + np.arange(end[-1])])
            counts.append(size)
        total = np.concatenate([[0], np.cumsum(np.concatenate(counts))])[np.searchsorted(cuts, offs)]
        return np.concatenate(parts), np.diff(total)

    def _one_by_one(self, col: pa.Array, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``batch``, with the marked texts encoded whole by the library."""
        ids = []
        for i, whole in enumerate(marked.tolist()):
            ids.append(np.array(self.tokenizer.encode(col[i].as_py(), add_special_tokens=False).ids, np.uint32) if whole else self.batch(col.slice(i, 1))[0])
        return np.concatenate(ids), np.array(list(map(len, ids)), dtype=np.int64)


_encoders: dict[str, Encoder] = {}


def encoder(path: str, room: int = 0) -> Encoder:
    """One encoder a process and file, with at least ``room`` bytes for its table."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    _encoders[path].room = max(_encoders[path].room, room)
    return _encoders[path]


def _block_pack(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of every row of ``values`` (rows padded with 0), and how many words each row takes.

    All rows advance together; each step packs one word for each row that has values left.
    """
    rows, width = values.shape
    look = 120
    padded = np.zeros((rows, width + look), dtype=np.uint64)
    padded[:, :width] = values
    need = np.zeros(padded.shape, dtype=np.uint8)
    need[:, :width] = np.where(values > 0, np.frexp(values.astype(np.float64))[1], 0)
    at, used = np.zeros(rows, dtype=np.int64), np.zeros(rows, dtype=np.int64)
    words = np.zeros((rows, width), dtype=np.uint64)
    live = np.flatnonzero(sizes > 0)
    while len(live):
        p = at[live]
        ahead = np.maximum.accumulate(need[live[:, None], p[:, None] + np.arange(8)], axis=1)
        choice = np.full(len(live), 14)
        for s in (13, 12, 11, 10, 9, 8, 7):  # growing counts: the last that fits stays
            choice[ahead[:, COUNTS[s] - 1] <= BITS[s]] = s
        dense = np.flatnonzero(ahead[:, 7] <= 6)
        if len(dense):
            far = np.maximum.accumulate(need[live[dense][:, None], p[dense][:, None] + np.arange(look)], axis=1)
            for s in (6, 5, 4, 3, 2, 1, 15):
                choice[dense[far[:, COUNTS[s] - 1] <= BITS[s]]] = s
        word = choice.astype(np.uint64)
        count, bits = COUNTS[choice], BITS[choice]
        for j in range(int(count[choice != 15].max(initial=0))):
            m = np.flatnonzero((count > j) & (choice != 15))
            word[m] |= padded[live[m], p[m] + j] << (4 + bits[m] * j).astype(np.uint64)
        words[live, used[live]] = word
        used[live] += 1
        at[live] += count
        live = live[at[live] < sizes[live]]
    return words, used


def encode(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Simple-8b: the offsets of the blocks in words (one more than blocks), and the words."""
    ids = np.asarray(ids, dtype=np.uint64)
    blocks = -(-len(ids) // block)
    grid = np.zeros((blocks, block), dtype=np.uint64)
    grid.reshape(-1)[: len(ids)] = ids
    sizes = np.minimum(block, len(ids) - np.arange(blocks) * block)
    wide = (grid >= np.uint64(1 << 60)).any(axis=1)
    words = np.zeros((blocks, block + 1), dtype=np.uint64)
    used = np.zeros(blocks, dtype=np.int64)
    tame = np.flatnonzero(~wide)
    if len(tame):
        words[tame, :block], used[tame] = _block_pack(grid[tame], sizes[tame])
    for b in np.flatnonzero(wide):
        words[b, 1 : sizes[b] + 1] = grid[b, : sizes[b]]
        used[b] = sizes[b] + 1
    return np.concatenate([[0], np.cumsum(used)]).astype(np.uint32), words[np.arange(block + 1) < used[:, None]]


def decode(offsets: np.ndarray, words: np.ndarray, total: int, block: int = BLOCK) -> np.ndarray:
    """All ids of a shard, selector by selector rather than word by word."""
    out = np.zeros(total, dtype=np.uint64)
    offsets = offsets.astype(np.int64)
    blocks = len(offsets) - 1
    if not blocks:
        return out
    sizes = np.minimum(block, total - np.arange(blocks) * block)
    wide = (words[offsets[:-1]] & np.uint64(15)) == 0
    for b in np.flatnonzero(wide):
        out[b * block : b * block + sizes[b]] = words[offsets[b] + 1 : offsets[b] + 1 + sizes[b]]
    owner = np.repeat(np.arange(blocks), np.diff(offsets))
    selector = (words & np.uint64(15)).astype(np.int64)
    selector[wide[owner]] = 0
    count = COUNTS[selector]
    before = np.cumsum(count) - count
    place = before - before[offsets[:-1]][owner] + owner * block
    last = (owner * block + sizes[owner]).astype(np.int64)
    for s in range(1, 15):
        m = np.flatnonzero(selector == s)
        if len(m):
            shift = (4 + BITS[s] * np.arange(COUNTS[s])).astype(np.uint64)
            value = (words[m][:, None] >> shift) & np.uint64((1 << int(BITS[s])) - 1)
            to = place[m][:, None] + np.arange(COUNTS[s])
            ok = to < last[m][:, None]
            out[to[ok]] = value[ok]
    return out


def shard(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray, block: int = BLOCK) -> bytes:
    offsets, words = encode(ids, block)
    head = HEAD.pack(b"S8B1", len(doc_ids), len(ids), block, len(offsets) - 1)
    return b"".join([head, doc_ids.astype("<i8").tobytes(), counts.astype("<u4").tobytes(), offsets.astype("<u4").tobytes(), words.astype("<u8").tobytes()])


def unshard(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, ids of each, and all ids of one shard."""
    magic, docs, total, block, blocks = HEAD.unpack_from(data)
    if magic != b"S8B1":
        raise ValueError("not a Simple-8b shard")
    at = HEAD.size
    doc_ids = np.frombuffer(data, "<i8", docs, at)
    counts = np.frombuffer(data, "<u4", docs, at + 8 * docs)
    at += 12 * docs
    offsets = np.frombuffer(data, "<u4", blocks + 1, at)
    words = np.frombuffer(data, "<u8", int(offsets[-1]), at + 4 * (blocks + 1))
    return doc_ids, counts, decode(offsets, words, total, block)


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = 0, shard_bytes: int = 4 << 20) -> None:
    """Writes the ids of all texts, each followed by ``end_id``, in ascending doc_id order.

    Needs ``doc_id`` and ``text``; other columns are ignored. A null or empty text has only
    the end id; rows with a null doc_id are left out (they have no place in the order); rows
    that share a doc_id follow in the order of their texts. One partition holds one range of
    ids; a table without rows writes no shards.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, done, part = encoder(tokenizer, ROOM), 0, TaskContext.get().partitionId()
        for batch in batches:
            for sub in pieces(batch, "text", shard_bytes):
                ids, n = enc.batch(sub.column(1))
                ends = np.cumsum(n)
                full = np.insert(ids, ends, np.uint32(end_id))
                doc = sub.column(0).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([done], pa.int64()), pa.array([len(full)], pa.int64()), pa.array([shard(doc, n + 1, full)], pa.binary())],
                    names=["part", "before", "ids", "shard"],
                )
                done += len(full)

    slim = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = slim.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    map_arrow(ordered, run, "part int, before long, ids long, shard binary").write.parquet(path)


def read_tokens(spark, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document of the written files.

    Only one number a partition reaches the driver: the ids that all earlier ones hold.
    """
    files = spark.read.schema("part int, before long, ids long, shard binary").parquet(path)
    base, total = {}, 0
    for row in files.groupBy("part").agg(F.sum("ids").alias("n")).orderBy("part").collect():
        base[row["part"]], total = total, total + row["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before, data in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                doc, n, ids = unshard(data)
                end = np.cumsum(n.astype(np.int64))
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * (e - k) : 4 * e]) for e, k in zip(end.tolist(), n.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc), pa.array(end - n + base[part] + before), pa.array(n.astype(np.int64)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    return map_arrow(files.select("part", "before", "shard"), run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, tokenizer: str, end_id: int = 0, path: str | None = None) -> DataFrame:
    """Writes the files and reads them back; ``path`` defaults to a new one in the shared folder."""
    path = path or new_path(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer, path, end_id)
    return read_tokens(docs.sparkSession, path)
