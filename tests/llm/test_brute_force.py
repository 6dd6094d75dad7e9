"""Operators against brute force: planted paraphrases, spans by plain patterns, models in plain NumPy, the pipeline stage by stage."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from loomwork.llm import ann, decontam, kernels, license, packing, pii, quality, simhash, substring, tokens, toxicity

R = np.random.default_rng(4)
LEX = ["".join(R.choice(list("abcdefghijkl"), R.integers(2, 9))) for _ in range(1200)]


def prose(n):
    return " ".join(R.choice(LEX, n)) + "."


ODD = [
    " ", "  ", "\n", "\n\n", "\t", "\r\n", " ", " ", "　", "\u0085", "a", "word", "The", "W", "̊", "'s", "'ll", " don't", "12", "!", "...", "-", "İ", "é", "é", "Σ", "ς",
    "ﬁ", "日本", "ß", "​", "\U0001f642", "Ⅷ", "K", "<|endoftext|>", "<|startoftext|>",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("special", [False, True])
def test_ids_of_odd_texts(name, special):
    """Strings of special tokens, runs of all white space, marks and letters that change when normalised; the table is begun anew often."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path(name))
    plain.encode_special_tokens = special
    ours, r = tokens.Encoder(public_tokenizers.path(name), special, room=20_000), random.Random(7)
    texts = ["".join(r.choices(ODD if i % 2 else ODD[:-2], k=r.choice([0, 1, 2, 3, 9, 14]))) for i in range(3000)] + [None]
    for at in range(0, len(texts), 100):
        ids, count = ours.batch(pa.array(texts[at : at + 100], pa.string()))
        for text, part in zip(texts[at : at + 100], np.split(ids, np.cumsum(count)[:-1]), strict=True):
            assert part.tolist() == plain.encode(text or "", add_special_tokens=False).ids


def test_word_hashes_do_not_depend_on_chunks(monkeypatch):
    texts = pa.array([prose(400), "", "x" * 900 + " y", None, "\n a  b\n", "é" * 300])
    want = [kernels.Words(texts, split=s) for s in ("space", "alnum", "class")]
    monkeypatch.setattr(kernels, "_CHUNK", 16)
    for s, w in zip(("space", "alnum", "class"), want, strict=True):
        got = kernels.Words(texts, split=s)
        assert (got.hash == w.hash).all() and (got.prefix(4)[1] == w.prefix(4)[1]).all()


def test_each_capacity_binds(spark):
    docs = spark.createDataFrame([(i, prose(20 + i % 30)) for i in range(120)], "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    for options, bound in (({"capacity": 300}, "tokens"), ({"capacity": 4000, "max_docs": 3}, "docs"), ({"capacity": 4000, "max_cost": 20_000}, "cost")):
        got = packing.pack(docs, path, **options).toPandas()
        by = got.groupby("sequence_id").length
        most = {"tokens": by.sum().max(), "docs": by.size().max(), "cost": (got.length**2).groupby(got.sequence_id).sum().max()}
        limit = {"tokens": 300, "docs": 3, "cost": 20_000}[bound]
        assert limit * 0.8 <= most[bound] <= limit
        assert got.length.sum() == sum(len(tokens.encoder(path).tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in docs.collect())
    with pytest.raises(ValueError, match="max_cost"):
        packing.pack(docs, path, max_cost=-1)


# decontamination


def paraphrase(rng, words, share):
    kill = set(rng.choice(len(words) - 5, int((len(words)) * share), replace=False).tolist())
    return [f"new{rng.integers(10**6)}" if i in kill else w for i, w in enumerate(words)]


@pytest.mark.parametrize("share", [0.0, 0.15, 0.25, 0.35])
def test_planted_paraphrases_at_any_place_and_partitioning(spark, share):
    rng = np.random.default_rng(int(share * 100))
    items = [rng.choice(LEX, int(n)).tolist() for n in rng.integers(15, 60, 60)]
    rows = [(k, " ".join(rng.choice(LEX, 30 + 3 * k).tolist() + paraphrase(rng, items[k % 60], share) + rng.choice(LEX, 50).tolist())) for k in range(120)]
    rows += [(1000 + k, prose(300)) for k in range(200)]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = [{tuple(r) for r in decontam.matches(docs.repartition(n), bench).collect()} for n in (1, 7)]
    found, planted = {(d, i) for d, i, _, _ in got[0]}, {(k, k % 60) for k in range(120)}
    assert got[0] == got[1]
    assert len(found & planted) >= 0.95 * len(planted) and found <= planted
    kinds = {k for _, _, _, k in got[0]}
    assert kinds == {"copy"} if share < 0.2 else "paraphrase" in kinds


def brute_matches(texts, items, copy=0.8, paraphrase=0.6):
    """Every window of every text, by a plain dynamic programme."""

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    out = set()
    for d, text in enumerate(texts):
        words = re.findall(r"[a-z0-9]+", text)
        for i, item in enumerate(items):
            n, slack = len(item), max(8, len(item) // 4)
            for s in range(0, len(words), 4):
                part = words[max(0, s - slack) : s + n + slack]
                share = lcs(item, part) / n
                if share >= copy - 1e-9 or (share >= paraphrase - 1e-9 and lcs(item[-5:], part) >= len(item[-5:]) - 1):
                    out.add((d, i))
    return out


def test_no_pruning_loses_a_match():
    """Items with repeated words, short ones, and texts of few words: without the cosine bound the finder finds what all windows hold."""
    rng = np.random.default_rng(8)
    few = LEX[:14]
    items = [rng.choice(few, int(n)).tolist() for n in (2, 3, 5, 9, 12, 16, 20)] + [["a", "a", "a", "b"], ["solo"]]
    texts = [" ".join(rng.choice(few, int(rng.integers(0, 60))).tolist()) for _ in range(60)] + ["a b a a", "solo", " ".join(items[5][:10] + items[5][11:])]
    finder = decontam.Finder([(i, " ".join(w)) for i, w in enumerate(items)], rng.standard_normal((decontam.BINS, 8)).astype(np.float32), rng.integers(0, 9, decontam.BINS * decontam.FINE).astype(float), -2.0, 0.8, 0.6)
    got = {(d, i) for d, i in finder.find(pa.array(texts))}
    assert got == brute_matches(texts, items) and len(got) > 20


def test_latent_space_is_the_svd(spark):
    """The leading directions are those of a plain SVD of all passages."""
    texts = [prose(130) for _ in range(150)]
    latent, _ = decontam.latent_space(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    words, f = decontam._words(pa.array(texts))
    row, passage = words.row, decontam._passages(words)
    place = np.unique(row * 1000 + passage, return_inverse=True)[1]
    a = np.zeros((decontam.BINS, place.max() + 1))
    np.add.at(a, (f, place), 1)
    df = np.bincount(np.unique(row * decontam.BINS + f) % decontam.BINS, minlength=decontam.BINS)
    idf = np.maximum(0, np.log((len(texts) + 1) / (df + 1)))
    u, s, _ = np.linalg.svd(idf[:, None] * a, full_matrices=False)
    # the first direction kept carries nearly the variance of its true counterpart
    ours = latent / np.maximum(1e-12, idf[:, None])
    kept = np.linalg.norm((ours / np.linalg.norm(ours, axis=0)).T @ (idf[:, None] * a), axis=1)
    assert kept[0] > 0.6 * s[decontam.COMMON]


# personal data


def brute_spans(text):
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }
    return [(k, m.start(), m.end()) for k, (p, ok) in kinds.items() for m in re.finditer(p, text) if ok(m.group())]


def test_spans_equal_the_plain_patterns(spark, monkeypatch):
    r = random.Random(3)
    bits = ["a.b@x.org", "@", "x@y", ".", "..", "10.0.0.1", "300.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999", "+", "12", " ", "-", "é", "\U0001f642", "\n", "x_y", "DE89 3704 0044 0532 0130 00", "card ", "00"]
    texts = ["".join(r.choices(bits, k=r.randint(0, 16))) for _ in range(700)] + [None, "", " ".join(["a@b.cd 1.2.3.4"] * 300)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    for row in pii.pii_digest(docs).collect():
        want = brute_spans(texts[row["doc_id"]] or "")
        assert row["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in pii.BASE] == [sum(x[0] == k for x in want) for k in pii.BASE]
    masked = {r["doc_id"]: r for r in pii.mask(docs).collect()}
    assert all(r["spans"] == "x" for r in masked.values()) and masked[700]["text"] is None
    assert masked[702]["text"] == " ".join(["[EMAIL] [IP]"] * 300)


# licences


def test_licences_in_running_text(spark):
    mit = license.TEMPLATES["MIT"][-1]
    texts = [
        "This work is licensed under the GNU General\nPublic License, version 3.", "Copyright 2020 Acme, released under the MIT License.", "/* " + "\n * ".join(re.findall(r"(?:\S+\s*){1,9}", mit)) + " */", "the rights of all readers", None, "",
        mit.replace("Software", "Work", 1),
    ]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, license string")
    got = {(r["doc_id"], r["license"]): r["dice"] for r in license.scan(docs).collect()}
    assert got[0, "GPL-3.0"] == got[1, "MIT"] == got[2, "MIT"] == 1.0 and 0.9 < got[6, "MIT"] < 1
    assert {d for d, _ in got} == {0, 1, 2, 6}
    assert license.scan(docs, {}).count() == 0


# models


def test_word_vectors_and_pooling_in_plain_numpy(spark):
    texts = [prose(60), "One, two! three", None, "", prose(30)]
    vectors = quality.word_vectors(spark.createDataFrame([(t,) for t in texts], "text string").repartition(2))
    places, signs = quality._index_vectors()
    want = np.zeros((quality.BINS, quality.DIM))
    each = []
    for text in texts:
        _, t = quality._tokens(pa.array([text or ""]))
        each.append(t)
        for i in range(len(t)):
            for j in (i - 2, i - 1, i + 1, i + 2):
                if 0 <= j < len(t):
                    for p, s in zip(places[t[j]], signs[t[j]], strict=True):
                        want[t[i], p] += s
    want /= np.maximum(1e-6, np.linalg.norm(want, axis=1, keepdims=True))
    assert np.abs(vectors - want).max() < 1e-5
    x = quality.pooled(pa.array([t or "" for t in texts]), vectors)
    for row, t in zip(x, each, strict=True):
        v = want[t] if len(t) else np.zeros((1, quality.DIM))
        assert np.abs(row[: quality.DIM] - v.mean(axis=0)).max() < 1e-4
        assert np.abs(row[quality.DIM : 2 * quality.DIM] - v.std(axis=0)).max() < 1e-3


def test_models_with_repeats_nulls_and_clashing_columns(spark):
    rows = [(i, prose(25) + (" vile scum" if i % 3 == 0 else ""), 9, 0.5, "x") for i in range(150)] * 2 + [(None, prose(10), 9, 0.5, "x"), (151, None, 9, 0.5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int, score double, features string")
    labels = spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(150)] * 2 + [(None, 1, 1), (3, None, None), (4, 0, 0)], "doc_id long, quality int, toxic int")
    q, t = quality.quality(docs, labels).toPandas(), toxicity.toxicity(docs, labels).toPandas()
    assert len(q) == len(t) == len(rows) and q.score.between(0, 1).all()
    assert (t.toxic == [int(r[0] is not None and r[0] < 150 and r[0] % 3 == 0) for r in rows]).mean() > 0.97 or t.groupby("doc_id").toxic.max().sum() >= 49
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and kept.where("doc_id is null").count() == 1


def test_one_row_scores_follow_the_ordinal_rule(spark):
    """Severity is the sum of P(grade > j), the grade the likeliest, toxic where P(grade > 0) reaches one half."""
    model = toxicity.OrdinalModel(np.unique(toxicity._features(pa.array(["vile scum"])) % toxicity.BINS))
    model.weights, model.theta = np.linspace(0.5, 1.5, len(model.weights)), np.array([1.0, 2.0, 3.0])
    texts = ["vile scum here", "a vile day", "nothing", "", None]
    for text, p in zip(texts, model.predict(pa.array(texts)), strict=True):
        bins = set((toxicity._features(pa.array([text or ""])) % toxicity.BINS).tolist())
        score = sum(w for b, w in zip(np.flatnonzero(model.slot >= 0).tolist(), model.weights, strict=True) if b in bins)
        assert p == pytest.approx(1 / (1 + np.exp(model.theta - score)))


# neighbours


@pytest.mark.parametrize(("spread", "most"), [(0.0, 0.2), (0.3, 0.3)])
def test_collision_counting_verifies_few_and_finds_most(spread, most):
    """Random directions, the hardest case: of one length, and of lengths that differ."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((12_000, 64))
    x *= rng.uniform(1 - spread, 1 + spread, (12_000, 1)) / np.linalg.norm(x, axis=1, keepdims=True)
    block, hit = ann.Block(np.arange(12_000), x), 0
    for q in range(0, 12_000, 400):
        ids, score = block.search(q, x[q], 20)
        exact = ann.exact_scores(x, x[q])
        assert (score == exact[ids]).all() and list(zip(-score, ids, strict=True)) == sorted(zip(-score, ids, strict=True)) and q not in ids
        exact[q] = -np.inf
        hit += len(set(ids.tolist()) & set(np.argsort(-exact)[:20].tolist()))
    assert hit >= 0.95 * 600 and block.verified < most * 30 * 12_000


def test_neighbours_of_small_tables(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>, dim int, block int, chunk int")
    assert ann.nearest(empty, F.col("vec_id") % 20 == 0).count() == 0
    few = spark.createDataFrame([(i, [1.0, float(i % 2)], 7, 8, 9) for i in range(50)], "vec_id long, embedding array<double>, dim int, block int, chunk int")
    got = ann.nearest(few, F.col("vec_id") == 1, k=3).collect()
    assert [tuple(r)[:4] for r in got] == [(1, 1, 3, 2.0), (1, 2, 5, 2.0), (1, 3, 7, 2.0)]  # ties to the smaller id


# near-duplicates and repeats


def fingerprint(text):
    w = (text or "").encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps):
    """The smallest position joined to each by fingerprints at most 4 bits apart."""
    label = list(range(len(fps)))
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 4 and label[a] != label[b]:
                lo, hi = sorted((label[a], label[b]))
                label = [lo if x == hi else x for x in label]
    return label


@pytest.mark.parametrize("segments", [2, 3, 4, 5, None])
def test_links_for_any_number_of_segments(spark, segments):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = sorted({b ^ sum(1 << x for x in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(6)})
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    found = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), 4, segments).collect()
    assert all(bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 4 for a, b in found)
    at = {x: i for i, x in enumerate(signed)}
    label = list(range(len(fps)))
    for a, b in found:
        lo, hi = sorted((label[at[a]], label[at[b]]))
        label = [lo if x == hi else x for x in label]
    assert label == components(fps)


def test_hot_fingerprints_and_clashing_columns(spark, monkeypatch):
    """A third of all rows in one group, and names that the operator uses itself."""
    monkeypatch.setattr(simhash, "_HOT", 4)
    texts = [""] * 40 + [prose(50)] * 30 + [prose(40) for _ in range(30)]
    rows = [(i, t, "c", 1, 2, 3) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string, _id int, _fp int, fp int").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in simhash.simhash(docs).collect()}
    want = components([fingerprint(t) for t in texts])
    assert got == dict(enumerate(want))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and {tuple(r) for r in kept.collect()} == {rows[i] for i in set(want)}


def test_a_long_text_in_segments(monkeypatch):
    monkeypatch.setattr(simhash, "_SEGMENT", 50)
    for n in (0, 1, 3, 4, 5, 40, 300):
        text = "\n".join(R.choice(LEX, n)) + " É"
        assert simhash.fingerprint(text) == fingerprint(text)


def test_shared_runs_are_found_and_nothing_else(spark):
    """Runs of 51 equal words always; texts that share no run of 20 words never."""
    runs = [prose(60) for _ in range(12)]
    rows = [(k, prose(30 + 7 * k) + " " + runs[k % 12] + " " + prose(40)) for k in range(24)] + [(100 + k, prose(150)) for k in range(60)]
    rows += [(200 + k, prose(40) + " " + " ".join(runs[k].split()[:15]) + " " + prose(40)) for k in range(12)]
    got = {r["doc_id"]: r for r in substring.repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert set(got) == set(range(24))
    assert all(got[k]["class_id"] == k % 12 and (got[k]["n_removed"] > 0) == (k >= 12) for k in got)


def test_very_long_texts(spark):
    """One text of 12 MB among short ones: results for all rows, and the short ones' as without it."""
    long = " ".join(R.choice(LEX, 2_000_000))
    rows = [(i, prose(60)) for i in range(40)]
    short, docs = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*rows, (99, long)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    item = " ".join(long.split()[-3000:-2970])
    assert quality.quality(docs, labels).where("doc_id = 99").first()["score"] is not None
    assert toxicity.toxicity(docs, labels).count() == 41
    assert [tuple(r)[:2] for r in decontam.matches(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()] == [(99, 1)]
    assert set(simhash.simhash(docs).where("doc_id < 99").collect()) == set(simhash.simhash(short).collect())
    assert substring.repeats(docs).where("doc_id < 99").count() == substring.repeats(short).count()


# pipeline


def test_pipeline_stage_by_stage(spark):
    """Every stage's rows against a brute-force version over what the stage before it kept."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = [re.findall(r"[^\W_]+", r["text"].lower()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    stage = dict(corpus_pipeline.STAGES)
    rows = lambda d: sorted(tuple(r) for r in d.collect())

    toxic = {r["doc_id"] for r in toxicity.toxicity(docs, spark.read.parquet(f"{sf}/labels.parquet")).where("toxic = 1").collect()}
    clean = stage["toxicity"](spark, docs, sf).cache()
    assert rows(clean) == rows(docs.where(~F.col("doc_id").isin(*toxic))) and toxic

    by = sorted(clean.collect(), key=lambda r: r["doc_id"])
    first = {by[i]["doc_id"] for i in set(components([fingerprint(r["text"]) for r in by]))}
    single = stage["simhash_near_dedup"](spark, clean, sf).cache()
    assert rows(single) == sorted(tuple(r) for r in by if r["doc_id"] in first)

    kept = stage["benchmark_decontamination"](spark, single, sf).cache()
    gone = {r["doc_id"] for r in single.collect()} - {r["doc_id"] for r in kept.collect()}
    for r in single.collect():
        words = re.findall(r"[^\W_]+", r["text"].lower())
        held = any(" " + " ".join(i) + " " in " " + " ".join(words) + " " for i in bench)
        assert not held or r["doc_id"] in gone
        if r["doc_id"] in gone:  # all but an item in five words of some item stand close together
            assert any(len(set(i) & set(words)) >= 0.6 * len(set(i)) for i in bench)

    masked = {r["doc_id"]: r for r in stage["pii"](spark, kept, sf).collect()}
    for r in kept.collect():
        spans = brute_spans(r["text"])
        assert (masked[r["doc_id"]]["text"] != r["text"]) or not spans
        assert not any(r["text"][a:b] in masked[r["doc_id"]]["text"] for k, a, b in spans if k in ("email", "card"))

    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    packed = corpus_pipeline.run(spark, sf).toPandas().sort_values(["sequence_id", "offset"])
    ids = {i: plain.encode(r["text"], add_special_tokens=False).ids + [1] for i, r in masked.items()}
    assert set(packed.doc_id) == set(ids) and packed.length.sum() == sum(map(len, ids.values()))
    for p in packed.itertuples():
        assert p.ids_crc32 == zlib.crc32(np.array(ids[p.doc_id][p.start : p.start + p.length], "<u4").tobytes())
    assert (packed.groupby("sequence_id").length.cumsum() - packed.length == packed.offset).all()
    assert packed.groupby("sequence_id").length.sum().max() <= 4096
