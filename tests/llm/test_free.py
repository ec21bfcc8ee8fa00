"""Packing, archives, classifiers, fingerprints and near copies against brute force, with odd rows."""

import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quipu.llm import fingerprint, group_join, packing, quality, toxicity, warc
from quipu.llm.components import components
from quipu.llm.queries import op8_fingerprints, tokenizer_path

ODD = [None, "", " \t\n", "one", "A a a A", "Hello, world!", "É😀 naïve Straße İstanbul ΣΑΣ", "x" * 50_000, "word " * 9_000, "<|endoftext|> y", "don't we'LL"]


def words(seed, n, vocabulary=4000):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, i * 2**55, "mine") for i, t in enumerate(ODD)] + [(4, ODD[4], 1, "again"), (None, "lost one", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_chars long, score string")


def test_pieces_equal_the_tokenizer(odd):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    got = collections.defaultdict(list)
    for r in packing.pieces(odd.filter("doc_id IS NOT NULL"), tokenizer_path()).orderBy("doc_id", "score", "piece").collect():
        got[r["doc_id"], r["score"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"], r["n_chars"]))
    assert len(got) == len(ODD) + 1
    for (i, score), parts in got.items():
        ids = [*plain.encode(ODD[i] or "", add_special_tokens=False).ids, 0]
        cuts = [ids[k : k + 2048] for k in range(0, len(ids), 2048)]
        crc = [zlib.crc32(np.asarray(c, "<u4").tobytes()) for c in cuts]
        size = 1 if score == "again" else i * 2**55
        assert parts == [(k, 2048 * k, len(c), crc[k], size) for k, c in enumerate(cuts)]


def held(plan):
    out = collections.Counter()
    for lengths, times in plan:
        for v in lengths:
            out[v] += times
    return out


@pytest.mark.parametrize("kind", ["spread", "short", "one", "full", "none"])
def test_plan_uses_up_the_histogram(kind):
    r = np.random.default_rng(1)
    size, counts = 256, np.zeros(257, np.int64)
    lengths = {"spread": r.integers(1, 257, 20_000), "short": r.integers(1, 20, 500), "one": [129] * 77, "full": [256] * 9, "none": []}[kind]
    np.add.at(counts, np.asarray(lengths, int), 1)
    plan = packing.plan(counts)
    assert held(plan) == collections.Counter({i: int(c) for i, c in enumerate(counts) if c})
    assert all(sum(p) <= size for p, _ in plan)
    used, least = sum(t for _, t in plan), -(-int((counts * np.arange(257)).sum()) // size)
    big = int(counts[129:].sum())
    assert used <= max(least, big) * 1.01 + 1


def test_least_squares_fit():
    counts = np.zeros(101, np.int64)
    counts[[30, 70, 50]] = 40, 40, 60
    patterns = packing.few_document_patterns(counts)
    fitted = packing.fit_counts(patterns, counts)
    made = dict(zip(map(tuple, patterns.tolist()), fitted, strict=True))
    assert made[70, 30, 0] == pytest.approx(40, abs=1) and 2 * made[50, 50, 0] == pytest.approx(60, abs=2)


def test_packing_is_gapless(odd, spark):
    rows = packing.pack(packing.pieces(odd, tokenizer_path())).collect()
    assert len(rows) == packing.pieces(odd, tokenizer_path()).count()
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(packing.pieces(odd.limit(0), tokenizer_path())).count() == 0


def test_archives_round_trip(spark, tmp_path):
    big = "".join(random.Random(3).choice("abcé\r\n<>") for _ in range(700_000))
    pages = [
        (5, "http://a/\r\nX: y", "<p>same</p>"), (2, None, "<p>same</p>"), (9, "u", None), (8, "u", ""), (7, "u", "\r\n\r\nx\r\n\r\n"), (1, "u", big), (3, "v", big),
        (None, "n", "alone"), (4, "w", "<p>same</p>"), (4, "w", "<p>same</p>"),
    ]
    frame = spark.createDataFrame([(*p, "x", True) for p in pages], "page_id long, url string, html string, payload_digest string, last boolean")
    files, folder = warc.archive(frame, str(tmp_path / "warc"))
    chunks = warc.read_chunks(files, folder, chunk=100_000).collect()
    got = collections.defaultdict(list)
    for r in chunks:
        got[r["archive"], r["record_no"]].append(r)
    rows = []
    for parts in got.values():
        parts.sort(key=lambda r: r["chunk_no"])
        assert [p["last"] for p in parts] == [False] * (len(parts) - 1) + [True]
        data, digest = b"".join(p["data"] for p in parts), hashlib.sha1()
        for p in parts:
            digest.update(p["data"])
            assert base64.b32encode(digest.digest()).decode() == p["digest_so_far"] and len(p["data"]) <= 100_000
        end = parts[-1]
        rows.append((end["page_id"], end["payload_bytes"], end["payload_digest"], end["record_type"], end["refers_to"], data))
    payload = {p: (h or "").encode() for p, _, h in pages}
    heads = {5: 2, 4: 2, 3: 1, 9: 8}
    want = []
    for p, *_ in pages:
        first = heads.get(p)
        digest = base64.b32encode(hashlib.sha1(payload[p]).digest()).decode()
        want.append((p, len(payload[p]), digest, "revisit" if first else "response", first, b"" if first else payload[p]))
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    assert len(got) == len(pages)
    none, folder = warc.archive(frame.limit(0), str(tmp_path / "none"))
    assert warc.read_chunks(none, folder).count() == 0
    from pyspark.sql import Row  # all payloads below the limit are responses

    small, folder = warc.archive(frame, str(tmp_path / "small"), min_bytes=50)
    kinds = [Row(**r.asDict()) for r in warc.read_chunks(small, folder, with_data=False).filter("last").select("page_id", "record_type").collect()]
    assert sorted(r["page_id"] for r in kinds if r["record_type"] == "revisit") == [3]


def test_damaged_archive_is_found(spark, tmp_path):
    frame = spark.createDataFrame([(1, "u", "payload " * 100)], "page_id long, url string, html string")
    files, folder = warc.archive(frame, str(tmp_path / "w"))
    import gzip

    path = files.first()["path"]
    raw = gzip.decompress(open(path, "rb").read()).replace(b"payload payload", b"payload Payload", 1)
    open(path, "wb").write(gzip.compress(raw))
    with pytest.raises(Exception, match="is damaged"):
        warc.read_chunks(files, folder).count()


def test_trees_learn_and_score_everything(spark, odd):
    good = [(i, " ".join(words(i, 80)), 1) for i in range(120)]
    junk = [(500 + i, " ".join(w + "###" for w in words(i, 80)), 0) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in good + junk], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in good + junk] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    rows = quality.score_quality(docs.withColumn("quality", F.lit("clash")), model).collect()
    assert all((r["quality"] >= quality.ACCEPT) == (r["doc_id"] < 500) for r in rows)
    got = quality.score_quality(odd, model)
    assert got.columns == ["doc_id", "n_chars", "score", "quality"]
    assert all(0 <= r["quality"] <= 1 for r in got.collect()) and got.count() == odd.count()
    none = quality.train(docs, labels.limit(0))
    assert {r["quality"] for r in quality.score_quality(docs, none).collect()} == {0.5}
    x = np.asarray([[1.0], [2.0]] * 50)
    assert quality.grow(x, np.ones(100)).score(x).min() > 0.9


def test_segments_are_maximal():
    def brute(values):
        n, found = len(values), []

        def split(a, b):
            best = max(((sum(values[i:j]), -(j - i), i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0,))
            if best[0] <= 1e-12:
                return
            _, _, i, j = best
            split(a, i)
            found.append((i, j - 1, best[0]))
            split(j, b)

        split(0, n)
        return found

    r = random.Random(7)
    for _ in range(60):
        values = [r.choice([-0.25, -0.25, -0.25, 0.3, 0.7, 1.1]) for _ in range(r.randrange(0, 16))]
        got = toxicity.segments([(i, v) for i, v in enumerate(values) if v > 0], 0.25)
        assert sum(s for *_, s in got) == pytest.approx(sum(s for *_, s in brute(values)))
        assert all(sum(values[a : b + 1]) == pytest.approx(s) for a, b, s in got)


def test_toxic_passages(spark, odd):
    clean = [(i, " ".join(words(i, 120)), 0) for i in range(300)]
    toxic = []
    for i in range(90):
        w = words(1000 + i, 120)
        w[40:40] = random.Random(i).sample(["scoundrel", "wretch", "villain", "knave"], 3)
        toxic.append((1000 + i, " ".join(w), 1))
    docs = spark.createDataFrame([(i, t) for i, t, _ in clean + toxic], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in clean + toxic] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    rows = toxicity.score_texts(docs, model).collect()
    assert all((r["toxicity"] >= toxicity.REJECT) == (r["doc_id"] >= 1000) for r in rows)
    assert all(r["passages"][0]["first"] == 40 and r["passages"][0]["last"] == 42 for r in rows if r["doc_id"] >= 1000)
    got = toxicity.score_texts(odd.withColumn("passages", F.lit(1)), model)
    assert got.count() == odd.count() and max(r["toxicity"] for r in got.collect()) < toxicity.REJECT
    assert sorted(r["n_chars"] or 0 for r in got.collect()) == sorted(r["n_chars"] or 0 for r in odd.collect())
    none = toxicity.train(docs, labels.filter("toxic = 0"))
    assert max(r["toxicity"] for r in toxicity.score_texts(docs, none).collect()) < 0.1


def walk(text):
    """The embedding, one step at a time."""
    moves, c, at, out = fingerprint._moves(), fingerprint._classes(text), 0, []
    while at < len(c):
        out.append(int(c[at]))
        at += int(moves[(len(out) - 1) % len(moves)][out[-1]])
    return out


def test_embedding_is_the_walk():
    texts = ["", "a", "hello world " * 30, "é😀" * 100, "b" * 2000]
    got, sampler = fingerprint.embed(texts), fingerprint.Sampler()
    sampler.places(np.asarray([2000]))
    for t, row in zip(texts, got, strict=True):
        steps = walk(t)
        for v, records in zip(row, sampler.records, strict=True):
            p = max((r for r in records if r < len(steps)), default=-1)
            want = 0 if p < 0 else ((p * 0x9E3779B97F4A7C15 + steps[p] + 1) % 2**64 * 0xC2B2AE3D27D4EB4F % 2**64 >> 33) % 255 + 1
            assert v == want
    assert not got[0].any()


def test_likeness_follows_edits(spark):
    r = random.Random(5)
    base = "".join(r.choice("abcdefgh ij") for _ in range(3000))
    other = "".join(r.choice("abcdefgh ij") for _ in range(3000))
    few = "".join("Q" + c if i % 60 == 0 else c for i, c in enumerate(base))
    a, b, c, d = fingerprint.embed([base, few, base[:2000] + other[:1000], other])
    near = [float(fingerprint.alike(a, x)) for x in (a, b, c, d)]
    assert near[0] == 1 and near[1] > 0.7 > near[3] + 0.4 and near[1] > near[2] > near[3]
    docs = spark.createDataFrame([(1, base), (2, few), (3, other), (4, base), (5, None)], "doc_id long, text string")
    pairs, members = fingerprint.near_pairs(docs, 0.7)
    assert [(r["a"], r["b"]) for r in pairs.collect()] == [(1, 2)]
    assert {r["doc_id"]: r["rep"] for r in members.collect()} == {1: 1, 2: 2, 3: 3, 4: 1, 5: 5}


@pytest.mark.parametrize("n", [0, 1, 2, 57])
def test_successors(spark, n):
    r = random.Random(n)
    rows = [(i * 3, None if i % 10 == 4 else f"t{i}") for i in range(n)]
    r.shuffle(rows)
    got = {x["doc_id"]: x["following"] for x in fingerprint.with_successor(spark.createDataFrame(rows, "doc_id long, text string"), 5).collect()}
    rows.sort(reverse=True)
    assert got == {i: rows[(k + 1) % n][1] or "" for k, (i, _) in enumerate(rows)}


def test_odd_successors(odd):
    got = fingerprint.with_successor(odd)
    assert got.count() == odd.count()
    assert fingerprint.fingerprints(odd).columns == ["doc_id", "n_chars", "score", "fingerprint"]


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def linked(texts):
    """Components by comparing every pair."""
    label = {i: i for i in texts}
    sets = {i: shingle_set(t) for i, t in texts.items()}
    ids = sorted(texts)
    for x in ids:
        for y in ids:
            both = len(sets[x] & sets[y])
            if x < y and sets[x] and sets[y] and 100 * both >= 80 * len(sets[x] | sets[y]):
                lo, hi = sorted((label[x], label[y]))
                label = {i: lo if v == hi else v for i, v in label.items()}
    return label, {i: len(s) for i, s in sets.items()}


def test_near_copies_equal_brute_force(spark):
    r = random.Random(11)
    passage, texts = words(99, 60), {}
    for i in range(25):
        own = words(i, r.choice([3, 4, 5, 30, 120]), 90_000)
        texts[len(texts)] = " ".join(own + passage * (i % 2))
        for _ in range(r.randrange(4)):
            w = own + passage * (i % 2)
            for _ in range(r.randrange(1, 3)):
                w[r.randrange(len(w))] = "changed"
            texts[len(texts)] = " ".join(w)
    chain = words(7777, 150, 90_000)
    for k in range(12):
        chain = chain[:]
        chain[12 * k % 150] = f"link{k}"
        texts[len(texts)] = " ".join(chain)
    texts |= {500 + i: t for i, t in enumerate(ODD)}
    texts |= {600: texts[3].upper(), 601: texts[3], 2**60: texts[3] + " "}
    rows = [(i, t, "x") for i, t in texts.items()] + [(601, texts[601], "x"), (None, "nobody's own text", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rep string")
    want, sizes = linked(texts)
    for share in (1.0, 0.0):
        got = group_join.near_copies(docs, share=share).collect()
        assert len(got) == len(rows)
        for row in got:
            if row["doc_id"] is None:
                assert row["component_id"] is None
            else:
                assert (row["component_id"], row["n_shingles"]) == (want[row["doc_id"]], sizes[row["doc_id"]]), row
    assert group_join.near_copies(docs.limit(0)).count() == 0


def test_long_chains_settle(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {95: 90, 100: 90}


def near_texts():
    """Texts that are alike, each band of theirs shared with texts of smaller ids that are not alike."""
    r = random.Random(21)
    letters = lambda n: "".join(r.choice("abcdefgh ij") for _ in range(n))
    out, base = {}, letters(1500)
    for i in range(60):
        cut = r.randrange(500, 800)
        out[i] = base[:cut] + letters(1500 - cut)
    for i in range(40):
        at = r.randrange(1000, 1400)
        out[1000 + i] = base[:at] + "Q" + base[at + 1 :]
    out |= {2000 + i: letters(1500) for i in range(100)}
    return out | {3000: base, 3001: out[1000], 3002: None}


def brute_pairs(texts, least):
    ids, prints = sorted(texts), fingerprint.embed([texts[i] or "" for i in sorted(texts)])
    rep = {}
    for i, p in zip(ids, prints, strict=True):
        rep.setdefault(p.tobytes(), i)
    heads = sorted(rep.values())
    of = dict(zip(ids, prints, strict=True))
    return {(a, b) for a in heads for b in heads if a < b and fingerprint.alike(of[a], of[b]) >= least}, {i: rep[of[i].tobytes()] for i in ids}


@pytest.mark.parametrize("block", [fingerprint.QUERIES, 7])
def test_band_members_meet_all_queries(spark, block):
    texts = near_texts()
    docs = spark.createDataFrame(list(texts.items()) + [(None, "nobody's")], "doc_id long, text string")
    want, rep = brute_pairs(texts, fingerprint.ALIKE)
    assert len(want) > 80
    rows = fingerprint.near_pairs(docs, block=block)[0].collect()
    got = [(r["a"], r["b"]) for r in rows]
    assert len(got) == len(set(got)) and set(got) <= want and len(got) >= 0.99 * len(want)
    asked = {rep[i] for i in texts if i % 50 == 0}
    few = [(r["a"], r["b"]) for r in fingerprint.near_pairs(docs, asked=F.col("doc_id") % 50 == 0, block=block)[0].collect()]
    assert sorted(few) == sorted(p for p in got if asked & set(p))
    prints = fingerprint.stored(fingerprint.fingerprints(docs), "test-prints")
    found = fingerprint.partners(prints, prints.filter("doc_id % 50 = 0"), block=block)
    counts = {r["doc_id"]: r["partners"] for r in prints.join(found, "fingerprint").filter("doc_id IS NOT NULL").collect()}
    both = [(x, y) for a, b in got for x, y in ((a, b), (b, a))]
    n = collections.Counter(x for x, y in both if y in asked)
    assert counts == {i: n[rep[i]] for i in texts if n[rep[i]]}


def test_fingerprint_query_counts_partners(spark, tmp_path):
    texts = near_texts()
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want, rep = brute_pairs(texts, fingerprint.ALIKE)
    asked = {rep[i] for i in texts if i % 50 == 0}
    n = collections.Counter(x for a, b in want for x, y in ((a, b), (b, a)) if y in asked)
    rows = op8_fingerprints(spark, str(tmp_path)).collect()
    assert len(rows) == len(texts) and {r["doc_id"]: r["partners"] for r in rows} == {i: n[rep[i]] for i in texts}
