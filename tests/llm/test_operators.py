"""Every operator on a small table with nulls, empty texts, repeats, ties and clashing columns, against brute force."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from loomwork.llm import ann, decontam, license, packing, pii, quality, simhash, substring, tokens, toxicity

R = np.random.default_rng(1)
LEX = ["".join(R.choice(list("abcdefghij"), R.integers(2, 8))) for _ in range(300)]


def prose(n):
    return " ".join(R.choice(LEX, n)) + "."


PASSAGE, ITEM = prose(60), prose(25)
TEXTS = [
    None, "", " ", "one", "Mail me: a.b@x.org_c@y.net, +1 (555) 010-9999 or 4111 1111 1111 1111; host 10.0.0.1, 300.1.1.1; DE89 3704 0044 0532 0130 00.", prose(90), prose(90), prose(40) + " " + PASSAGE + " " + prose(30),
    prose(12) + "\n" + PASSAGE + prose(20), prose(30) + " " + ITEM + " " + prose(30), "Released under the MIT License.\nCopyright. All rights reserved.", "x" * 5000 + " " + prose(2500), "a  b\n \n c\t", prose(50), "é ß\n" + prose(20),
]
TEXTS += [TEXTS[5], TEXTS[5], TEXTS[13] + " tail"]
KINDS = "doc_id long, text string, lang string, source string, n_chars long, spans string, fp long, h long, label int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", len(t or ""), "clash", 1, 2, 3) for i, t in enumerate(TEXTS)] + [(5, TEXTS[5], "en", "s", 1, "clash", 1, 2, 3)]
    return spark.createDataFrame(rows, KINDS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], KINDS)


def test_codec_round_trip():
    for ids in (R.integers(0, 50257, 3000), np.zeros(700, int), R.integers(0, 3, 999), np.concatenate([R.integers(0, 1 << b, 20) for b in range(1, 63)]), np.zeros(0, int), np.array([2**63 + 5], dtype=np.uint64)):
        off, words = tokens.encode(ids)
        assert (tokens.decode(off, words, len(ids)) == ids.astype(np.uint64)).all()


def brute_ids(name, text, end):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name)).encode(text or "", add_special_tokens=False).ids + [end]


def test_tokens(docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = tokens.token_output(docs, path).orderBy("start").collect()
    at, order = 0, sorted(list(enumerate(TEXTS)) + [(5, TEXTS[5])], key=lambda x: x[0])
    assert len(got) == len(order)
    for row, (i, t) in zip(got, order, strict=True):
        ids = brute_ids("byte_bpe_50k.json", t, 0)
        assert tuple(row) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert tokens.token_output(empty, path).count() == 0


def test_packing(docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = packing.pack(docs, path, capacity=500).toPandas()
    for row in got.itertuples():
        ids = brute_ids("word_bpe_49k.json", TEXTS[row.doc_id], 1)[row.start : row.start + row.length]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == row.ids_crc32
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all()
    assert got.groupby("sequence_id").length.sum().max() <= 500
    assert got.length.sum() == sum(len(brute_ids("word_bpe_49k.json", t, 1)) for t in [*TEXTS, TEXTS[5]])
    assert packing.pack(empty, path).count() == 0
    bins, _ = packing.best_fit(np.array([9, 8, 2, 1]), 10, 1, 100)
    assert len(set(bins.tolist())) == 4  # one document a sequence
    for rule in ("norm", "dot"):
        bins, _ = packing.best_fit(np.array([6, 5, 5, 4]), 10, 10, 100, rule)
        assert len(set(bins.tolist())) == 2


def brute_fp(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash(spark, docs, empty):
    got = simhash.simhash(docs).collect()
    fps = {i: brute_fp(t) for i, t in enumerate(TEXTS)}
    group = {i: {i} for i in fps}
    for a in fps:
        for b in fps:
            if (fps[a] ^ fps[b]).bit_count() <= 4 and group[a] is not group[b]:
                group[a] |= group[b]
                for x in group[b]:
                    group[x] = group[a]
    assert len(got) == len(TEXTS) + 1
    for r in got:
        assert (r["fingerprint"], r["component_id"]) == (f"{fps[r['doc_id']]:016x}", min(group[r["doc_id"]]))
    assert simhash.simhash(empty).count() == 0
    kept = {r["doc_id"] for r in simhash.keep_one(docs).collect()}
    assert kept == {min(g) for g in group.values()}
    close = [7, 7 ^ 0b1111, 7 ^ (1 << 63 | 1 << 40 | 1 << 20 | 1), 1 << 50]
    links = simhash.links(spark.createDataFrame([(x if x < 1 << 63 else x - (1 << 64),) for x in close], "fp long")).collect()
    assert {frozenset(x % (1 << 64) for x in r) for r in links} >= {frozenset(close[:2]), frozenset([close[0], close[2]])}


def test_pii(docs, empty):
    row = pii.pii_digest(docs).where("doc_id = 4").first()
    text = TEXTS[4]
    found = {k: text[int(a) : int(b)] for k, a, b in (x.split(":") for x in row["spans"].split(","))}
    assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]) == (2, 1, 1, 1)
    assert found["card"] == "4111 1111 1111 1111" and found["ip"] == "10.0.0.1" and found["iban"].replace(" ", "") == "DE89370400440532013000"
    assert {text[m.start() : m.end()] for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)} == {"a.b@x.org", "_c@y.net"}
    nothing = pii.pii_digest(docs).where("doc_id = 0").first()
    assert nothing["base_sha256"] == hashlib.sha256(b"").hexdigest() and nothing["spans"] == ""
    masked = pii.mask(docs).where("doc_id = 4").first()
    assert "4111" not in masked["text"] and "[EMAIL]" in masked["text"] and masked["n_chars"] == len(masked["text"])
    assert pii.pii_digest(empty).count() == 0


def test_license(docs, empty):
    got = {(r["doc_id"], r["license"]) for r in license.scan(docs).collect()}
    assert got == {(10, "MIT"), (10, "Proprietary")}
    assert license.scan(empty).count() == 0


def test_substring(docs, empty):
    got = {r["doc_id"]: r for r in substring.repeats(docs).collect()}
    assert set(got) == {5, 7, 8, 13, 15, 16, 17}
    assert got[8]["class_id"] == 7 and got[8]["n_removed"] > 0 and got[7]["n_removed"] == 0
    assert got[17]["class_id"] == 13
    assert substring.repeats(empty).count() == 0
    bands, rows = substring.tune_bands()
    assert 1 - (1 - 0.8**rows) ** bands >= 0.99


def test_substring_large_band(spark, monkeypatch):
    """Many near copies of one line, split into parts: the links join what brute force joins, and each is a true one."""
    monkeypatch.setattr(substring, "PART", 16)
    rng = np.random.default_rng(5)
    base = rng.choice(LEX, 300).tolist()
    lines = []
    for i in range(90):
        words = list(base)
        for at in rng.choice(300, rng.integers(1, 9), replace=False):
            words[at] = f"w{i}x{at}"
        lines.append(" ".join(words))
    table = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    found = substring.units(table, 20, *substring.tune_bands()).where("line")
    distinct = found.select("h", F.struct("doc_id", "at").alias("first"), "bands", "sketch")
    name = {r["h"]: r["first"]["doc_id"] for r in distinct.collect()}
    got = {frozenset((name[r["src"]], name[r["dst"]])) for r in substring.near_lines(distinct, table, 20, 0.8).collect()}
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, lines)]
    true = {frozenset((a, b)) for a in range(90) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}

    def groups(links):
        label = list(range(90))
        for a, b in map(tuple, links):
            label = [label[a] if x == label[b] else x for x in label]
        return {frozenset(i for i in range(90) if label[i] == x) for x in set(label)}

    assert len(true) > 50
    assert got <= true
    assert groups(got) == groups(true)


def test_decontam(spark, docs, empty):
    bench = spark.createDataFrame([(1, ITEM), (2, prose(30)), (3, None), (4, "")], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"], r["kind"]) for r in decontam.matches(docs, bench, cosine=0.3).collect()] == [(9, 1, "copy")]
    assert decontam.matches(empty, bench).count() == 0
    assert 9 not in {r["doc_id"] for r in decontam.keep_uncontaminated(docs, bench, cosine=0.3).collect()}
    assert decontam.lcs([1, 2, 3, 2, 4, 1, 2], [2, 4, 3, 1, 2, 1]) == 4


def test_models(spark, empty):
    rows = []
    for i in range(400):
        toxic, bad = i % 4 == 0, i % 5 == 0
        text = prose(30 + i % 20)
        text = " ".join(w.upper() + "!!" for w in text.split()) if bad else text
        rows.append((i, text + (" vile vilest scum" if toxic else ""), int(not bad), int(toxic)))
    rows += [(400, None, None, None), (401, "", None, None)]
    t = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")
    docs, labels = t.select("doc_id", "text"), t.select("doc_id", "quality", "toxic")
    q = quality.quality(docs, labels).join(labels, "doc_id").toPandas()
    assert len(q) == 402 and q.score.between(0, 1).all()
    held = q[q.held_out & q.quality.notna()]
    assert (held.predicted == held.quality).mean() > 0.9
    x = toxicity.toxicity(docs, labels).join(labels.withColumnRenamed("toxic", "truth"), "doc_id").toPandas()
    known = x[x.truth.notna()]
    assert (known.toxic == known.truth).mean() > 0.97 and x.severity.between(0, 3).all()
    kept = {r["doc_id"] for r in toxicity.keep_clean(docs, labels).collect()}
    assert {400, 401} <= kept and len(kept) < 330
    assert quality.quality(empty, labels).count() == 0 and toxicity.toxicity(empty, labels).count() == 0
    assert toxicity.toxicity(docs, labels.limit(0)).where("toxic = 1").count() == 0


def test_ann(spark):
    x = R.standard_normal((3000, 24))
    x[10] = x[11]
    rows = [(i, [float(v) for v in e]) for i, e in enumerate(x)] + [(None, [1.0] * 24), (9001, None), (9002, [0.0] * 24), (9003, [float("nan")] * 24), (9004, [None] * 24), (9005, []), (0, rows0 := [float(v) for v in x[0]])]
    assert rows0
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=20, block_rows=1000, query_rows=60).toPandas()
    want = set()
    for q in range(0, 3000, 20):
        s = ann.exact_scores(x, x[q])
        s[q] = -np.inf
        want |= {(q, int(i)) for i in np.lexsort((np.arange(3000), -s))[:20]}
    assert len(got) == 150 * 20 and len(want & set(zip(got.query_id, got.vec_id, strict=True))) / len(want) > 0.95
    few = ann.nearest(spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>"), F.col("vec_id") == 0).collect()
    assert [r["rank"] for r in few] == [1, 2]


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
    packed = corpus_pipeline.run(spark, sf).toPandas()
    assert packed.groupby("sequence_id").length.sum().max() <= 4096 and packed.doc_id.nunique() > 0.6 * docs.count()


def test_decontam_paraphrases(spark):
    """At the defaults: 60 to 80 percent of an item's words in order, the last five among them, at every offset."""
    rng = np.random.default_rng(11)
    say = lambda n: rng.choice(LEX, n).tolist()
    items = [say(int(n)) for n in rng.integers(14, 60, 40)]
    rows = [(i, " ".join(say(200))) for i in range(100, 400)]
    for k in range(80):
        w = items[k % 40]
        kept = set(rng.choice(len(w) - 5, int(np.ceil(len(w) * rng.uniform(0.6, 0.8))) - 5, replace=False).tolist()) | set(range(len(w) - 5, len(w)))
        rows.append((k, " ".join(say(50 + k) + [x if i in kept else f"other{i}" for i, x in enumerate(w)] + say(60))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.matches(docs, bench).collect()}
    planted = {(k, k % 40) for k in range(80)}
    assert len(got & planted) >= 0.95 * len(planted)
    assert got <= planted


def test_keep_one_judges_rows(spark):
    """Rows without doc_id, or with the same one, whose texts differ all stay; near copies among them do not."""
    texts = [prose(60) for _ in range(8)]
    rows = [(None, t) for t in texts[:4]] + [(1, texts[4]), (1, texts[5]), (1, texts[5]), (2, texts[6]), (3, texts[6]), (None, texts[6]), (None, texts[7]), (None, texts[7])]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = [(None, t) for t in texts[:4]] + [(1, texts[4]), (1, texts[5]), (2, texts[6]), (None, texts[7])]
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, want))


def test_keep_uncontaminated_judges_rows(spark):
    """A row without doc_id that holds an item goes, and one without an item stays."""
    clean, leak = [prose(80) for _ in range(4)], prose(30) + " " + ITEM + " " + prose(30)
    rows = [(None, clean[0]), (None, leak), (None, None), (1, clean[1]), (1, leak), (2, clean[2]), (3, leak)]
    rows += [(i, prose(150)) for i in range(10, 110)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    kept = decontam.keep_uncontaminated(docs, bench).collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [r for r in rows if r[1] != leak]))


def test_token_table_keeps_what_the_default_room_forgets():
    """620,000 pieces, more than 96 MB of the table: written tokens must not encode them a second time."""
    import numpy as np
    import public_tokenizers
    import pyarrow as pa

    from loomwork.llm import tokens

    enc = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"), room=tokens.ROOM)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz"))
    words = ["".join(w) for w in letters[np.array(np.unravel_index(np.arange(620_000), (26,) * 5)).T].tolist()]
    texts = [pa.array([" " + " ".join(words[at : at + 155_000])]) for at in range(0, 620_000, 155_000)]
    first, learn, met = [enc.batch(t) for t in texts], enc._learn, []
    assert enc.taken > 96 << 20
    enc._learn = lambda keys: met.extend(keys) or learn(keys)
    again = [enc.batch(t) for t in texts]
    assert not met and all(np.array_equal(a[0], b[0]) for a, b in zip(first, again, strict=True))
    assert tokens.encoder(public_tokenizers.path("byte_bpe_50k.json"), tokens.ROOM).room >= tokens.ROOM
