"""Top-k search, prefix trie and lexical search against brute force, with odd rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from quipu.llm import ball_search, balls, lexical, prefix_trie, shard_search
from quipu.llm.common import stored
from quipu.llm.queries import op11_top_k, op12_prefix_trie, op13_lexical_search

VECTORS = "vec_id long, embedding array<double>, score long, rank int, shard string, found long"


def scaled(x):
    if x is None or any(v is None or not math.isfinite(v) for v in x):
        return None
    out = [math.floor(256 * v) for v in x]
    return out if math.sqrt(sum(v * v for v in out)) < 2**31 else None


def best_by_hand(rows, every=50, k=5):
    rows = [(i, scaled(x)) for i, x in rows]
    rows = [(i, x) for i, x in rows if i is not None and x is not None]
    asks = {(i, tuple(x)) for i, x in rows if i % every == 0}
    out = []
    for i, x in asks:
        found = sorted((-sum(a * b for a, b in zip(x, y, strict=False)), j) for j, y in rows if j != i)[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found)]
    return sorted(out)


def vector_rows():
    r = np.random.default_rng(5)
    rows = [(i, (r.normal(size=8) / 3).tolist()) for i in range(400)]
    same = (r.normal(size=8) / 3).tolist()
    rows += [(i, same) for i in range(400, 700)]  # a large group of ties
    rows += [(50, None), (51, [None] + [1.0] * 7), (52, [math.nan] * 8), (750, [math.inf] * 8), (800, []), (801, []), (850, [0.5, -0.5]), (851, [1e30] * 8)]
    rows += [(900, [4e6] * 3), (901, [-4e6, 4e6, 4e6]), (None, same), (100, same), (3, rows[3][1]), (3, rows[3][1])]
    return rows


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame([(i, x, 1, 2, "x", 3) for i, x in vector_rows()], VECTORS)


def answers(rows):
    return sorted(tuple(r) for r in rows.select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("shard_bytes", [1 << 20, 2000])
def test_top_k_equals_brute_force(vectors, monkeypatch, shard_bytes):
    monkeypatch.setattr(ball_search, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(ball_search, "BLOCK_BYTES", 200)
    shards = stored(ball_search.index(vectors.repartition(3)), "t")
    assert answers(ball_search.top_k(shards, vectors.filter("vec_id % 50 = 0"))) == best_by_hand(vector_rows())


def test_top_k_by_shuffle_and_of_nothing(vectors, monkeypatch):
    monkeypatch.setattr(ball_search, "SHARD_BYTES", 1000)
    shards, asks = stored(ball_search.index(vectors.coalesce(1)), "t"), vectors.filter("vec_id % 50 = 0")
    blocks = stored(ball_search.question_blocks(asks), "t")
    found = shard_search.top_k(shards, blocks, 5, ball_search._loaded, ball_search._asked, broadcast_bytes=0).withColumnRenamed("found", "vec_id")
    assert answers(found) == best_by_hand(vector_rows())
    empty = stored(ball_search.index(vectors.limit(0)), "t")
    assert ball_search.top_k(empty, asks).count() == ball_search.top_k(shards, vectors.limit(0)).count() == ball_search.top_k(empty, vectors.limit(0)).count() == 0


def test_query_prunes_and_is_whole(spark, tmp_path):
    r = np.random.default_rng(6)
    centres = r.normal(size=(20, 6)) * 4
    rows = [(i, (centres[i % 20] + r.normal(size=6) / 8).tolist()) for i in range(2000)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert answers(op11_top_k(spark, str(tmp_path))) == best_by_hand(rows)
    ids, points = np.arange(2000), np.asarray([scaled(x) for _, x in rows], np.int32)
    best = balls.Best(40, 5)
    scored = ball_search.search_shard(ball_search.tree_of(ids, points), ids, points, ids[::50], points[::50], best)
    assert scored < 40 * 2000 / 4


def trie_by_hand(rows):
    turns = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            turns[c].append((t is not None, t or 0, role, digest, text))
    turns = {c: [(r, x) for _, _, r, _, x in sorted(v)] for c, v in turns.items()}
    whole = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = (*turns.get(c - int(math.fmod(c, 5)), [])[:h], *turns[c][h:])
    members, children = collections.defaultdict(list), collections.defaultdict(set)
    for c, q in whole.items():
        for d in range(len(q) + 1):
            members[q[:d]].append(c)
            if d:
                children[q[: d - 1]].add(q[:d])
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        leaves[p], saved[p] = sum(leaves[k] for k in children[p]) or 1, own + sum(saved[k] for k in children[p])
        ends = ",".join(str(c) for c in sorted(c for c in members[p] if len(whole[c]) == len(p)))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(members[p]), len(p), parent, len(members[p]), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversation_rows(n=150):
    r = random.Random(7)
    rows = []
    for c in range(n):
        if c % 5 == 0 and c % 3 == 0:
            continue  # a family without its first conversation
        shared = c % 3 == 1
        for t in range(r.choice([1, 1, 2, 5, 12]) if not shared else 4):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"same {t}" if shared else r.choice(["yes", "nó", "", f"w{r.randrange(4)}"])))
    rows += [(7, None, None, None), (7, None, "user", "yes"), (7, 0, "user", "yes"), (7, 0, "user", "yes"), (7, 0, "tool", "yes")]
    rows += [(None, 0, "user", "lost"), (-3, 0, "user", "below"), (-5, 0, "user", "far below"), (10**15, 0, "a", "b" * 40_000), (10**15, 1, "ab", "")]
    rows += [(2**40, t, "user", f"t{t % 3}") for t in range(700)]
    return rows


@pytest.fixture(scope="module")
def conversations(spark):
    rows = [(*x, 9, "mine") for x in conversation_rows()]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth int, family string")


def nodes(rows):
    return sorted((tuple(r) for r in rows.select(*prefix_trie.NAMES).collect()), key=str)


@pytest.mark.parametrize("turns", [250_000, 40, 1])
def test_trie_equals_brute_force(conversations, monkeypatch, turns):
    monkeypatch.setattr(prefix_trie, "BLOCK_TURNS", turns)
    assert nodes(prefix_trie.conversation_trie(conversations)) == trie_by_hand(conversation_rows())


def test_trie_of_one_text_of_turnless_ones_and_of_nothing(spark, conversations, tmp_path):
    same = [(c, t, "user", "x") for c in range(200) for t in range(3)]
    spark.createDataFrame(same, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert nodes(op12_prefix_trie(spark, str(tmp_path))) == trie_by_hand(same)
    bare = [(c, 0, "user", "x") for c in range(1, 5)]  # no first conversation, and few or no turns after the first h
    assert nodes(prefix_trie.conversation_trie(spark.createDataFrame(bare, "conv_id long, turn long, role string, text string"))) == trie_by_hand(bare)
    assert prefix_trie.conversation_trie(conversations.limit(0)).count() == 0


def test_extents_are_found_from_any_row():
    r = np.random.default_rng(8)
    values = r.integers(0, 5, 90)
    values[0] = -1
    table = prefix_trie.range_minima(values)
    place, depth = r.integers(0, 90, 300), r.integers(0, 6, 300)
    left, right = prefix_trie.extents(table, place, depth)
    for p, d, a, b in zip(place, depth, left, right, strict=True):
        lo = hi = p
        while values[lo] >= d:
            lo -= 1
        while hi + 1 < 90 and values[hi + 1] >= d:
            hi += 1
        assert (a, b) == (lo, hi)
    start = np.minimum(place, 89 - depth)
    assert prefix_trie.range_minimum(table, start, start + depth).tolist() == [values[s : s + d + 1].min() for s, d in zip(start, depth, strict=True)]


TERM, FOLD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked_by_hand(docs, items, k=10):
    counts = [(i, collections.Counter(TERM.findall((t or "").translate(FOLD)))) for i, t in docs]
    n_docs, length = sum(1 for _, c in counts if c), sum(sum(c.values()) for _, c in counts)
    df = collections.Counter(w for _, c in counts for w in c)
    out = []
    for item, text in set(items):
        asked, found = set(TERM.findall((text or "").translate(FOLD))), []
        for i, c in counts:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // max(1, length)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (1_000_000_000 * c[w] // (1000 * c[w] + 8 * m)) for w in asked if c[w])
            if score > 0 and i is not None:
                found.append((-score, i))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def text_rows():
    r = random.Random(9)
    draw = lambda n: " ".join(f"W{min(r.randrange(900), r.randrange(900))}" for _ in range(n))
    docs = [(i, draw(r.choice([1, 30, 80]))) for i in range(300)]
    docs += [(i, docs[4][1]) for i in range(300, 420)]  # a large group of ties
    docs += [(420, None), (421, ""), (422, "... \x7f _-"), (423, "w1 " * 30_000), (424, "É é É w1_W2\x00w3 ÀÉ x²"), (None, "w1 w2 lost"), (5, docs[5][1]), (5, docs[5][1])]
    items = [(k, docs[k * 7][1][:150]) for k in range(30)] + [(30, None), (31, "é É"), (32, "nowhere"), (33, "w1"), (33, "w1"), (33, "w2"), (None, "w3 w4"), (34, docs[4][1])]
    return docs, items


@pytest.mark.parametrize("lookup", [lexical.LOOKUP_BYTES, 0])
def test_ranked_search_equals_brute_force(spark, monkeypatch, lookup):
    monkeypatch.setattr(lexical, "SHARD_ROWS", 100)
    monkeypatch.setattr(lexical, "LEAF_ROWS", 8)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 7)
    docs, items = text_rows()
    frame = spark.createDataFrame([(i, t, "x", 4) for i, t in docs], "doc_id long, text string, n string, row int").repartition(3)
    asked = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, item int")
    got = sorted((tuple(r) for r in lexical.rank_documents(frame, asked, lookup_bytes=lookup).collect()), key=str)
    assert got == ranked_by_hand(docs, items)
    assert lexical.rank_documents(frame.limit(0), asked).count() == lexical.rank_documents(frame, asked.limit(0)).count() == 0


def test_ranked_search_query_and_pruning(spark, tmp_path):
    docs, items = text_rows()
    docs, items = [d for d in docs if d[0] is not None], sorted({i[0]: i for i in items if i[0] is not None}.values())
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted((tuple(r) for r in op13_lexical_search(spark, str(tmp_path)).collect()), key=str)
    assert got == ranked_by_hand(docs, items)
    # Short documents of their own words: their balls are out of reach of a long item that is found elsewhere.
    lengths = np.full(512, 4, np.int64)
    numbers = np.concatenate([np.arange(4) + 4 * (k // 128) for k in range(512)])
    impacts = np.where(np.repeat(np.arange(512) < 128, 4), 900_000, 1_000).astype(np.int64)
    shard = lexical.Shard(np.arange(512), lengths, numbers, impacts)
    best = balls.Best(1, 10)
    assert shard.search(np.asarray([0, 4]), np.arange(4), np.full(4, 3000), best) <= 256
    assert best.ids[0].tolist() == list(range(10))


def test_statistics_stay_whole_where_counts_are_large():
    shard = lexical.Shard(np.asarray([1, 2]), np.asarray([1, 1]), np.asarray([0, 0]), np.asarray([10**6, 10**6 - 1]))
    best = balls.Best(1, 2)
    shard.search(np.asarray([0, 1]), np.asarray([0]), np.asarray([10**12 + 1]), best)
    assert best.scores[0].tolist() == [10**18 + 10**6, (10**12 + 1) * (10**6 - 1)]


@pytest.mark.parametrize("parts", [(256, 2048, 500), (3, 4, 2)])
def test_a_dense_family_of_near_copies(spark, monkeypatch, parts):
    """Many copies with many edits: some link, most only through others, some just fail."""
    from quipu.llm import group_join
    from tests.llm.test_free import linked

    for name, value in zip(("ASKING", "ASKED", "SHARE"), parts, strict=True):
        monkeypatch.setattr(group_join, name, value)
    r = random.Random(31)
    base, texts = [f"b{r.randrange(10**6)}" for _ in range(200)], {}
    for i in range(160):
        w = base[:]
        for _ in range(r.choice([0, 1, 2, 3, 4, 5, 6])):
            w[r.randrange(200)] = f"e{r.randrange(10**6)}"
        texts[i] = " ".join(w)
    shared = [f"p{k}" for k in range(40)]  # a passage in texts that are not alike
    texts |= {1000 + i: " ".join([f"o{r.randrange(10**6)}" for _ in range(r.choice([3, 8, 30]))] + shared) for i in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    want, sizes = linked(texts)
    assert 1 < len(set(want.values())) and max(collections.Counter(want.values()).values()) > 100
    for share in (1.0, 0.0):
        got = {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in group_join.near_copies(docs, share=share).collect()}
        assert got == {i: (want[i], sizes[i]) for i in texts}
