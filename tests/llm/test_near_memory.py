"""What near copies hold at a time."""

import random

import pytest
from pyspark.sql import functions as F

from quipu.llm import common, group_join


@pytest.fixture
def steps(spark, monkeypatch):
    """name -> (rows that it stores, settings of the batches then), as near_copies() stores them."""
    seen = {}

    def stored(rows, name):
        seen[name] = rows, [spark.conf.get(k) for k in common._BATCHES]
        return common.stored(rows, name)

    monkeypatch.setattr(group_join, "stored", stored)
    return seen


def test_near_copies_take_few_texts_at_a_time(spark, steps):
    """Batches of Spark's own size, 10,000 texts, took an executor of 3 GB over its memory."""
    before = [spark.conf.get(k) for k in common._BATCHES]
    texts = [" ".join(f"w{i}x{k}" for k in range(9)) for i in range(20)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:3])], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in group_join.near_copies(docs).collect()}
    assert got == {i: i % 20 for i in range(23)}
    assert {"near-sets", "near-links"} <= set(steps)
    assert all(int(v) <= common.BATCH_ROWS for _, now in steps.values() for v in now)
    assert [spark.conf.get(k) for k in common._BATCHES] == before


def test_settings_stay_where_they_are_smaller_or_a_step_fails(spark):
    arrow, parquet = common._BATCHES
    old = spark.conf.get(parquet, None)
    spark.conf.set(arrow, "7")
    try:
        with pytest.raises(ValueError, match="x"), common.text_batches(spark):
            assert (spark.conf.get(arrow), spark.conf.get(parquet)) == ("7", str(common.BATCH_ROWS))
            raise ValueError("x")
        assert (spark.conf.get(arrow), spark.conf.get(parquet, None)) == ("7", old)
        spark.conf.set(arrow, "0")  # no limit
        with common.text_batches(spark):
            assert spark.conf.get(arrow) == str(common.BATCH_ROWS)
        assert spark.conf.get(arrow) == "0"
    finally:
        spark.conf.unset(arrow)


def test_rare_shingles_are_dealt_once_and_not_gathered_by_key(spark, steps):
    """A map of all shingles of a task, most of which one class alone has, took most of the executor's heap."""
    r = random.Random(5)
    rows = [(r.randrange(40), i, r.randrange(9)) for i in range(120)]
    rows += [(1000 + i, i, 0) for i in range(50)] + [(2000, 7, 1), (2000, 7, 1)]
    rows = spark.createDataFrame(rows, "shingle long, rep long, pos int")
    names = ["shingle", "rep", "pos", "anchors"]
    listed = lambda d: sorted(map(repr, d.select(*names).collect()))
    assert listed(group_join._shared_rare(rows)) == listed(group_join._shared(rows))

    text = lambda k: " ".join(f"t{k}w{i}" for i in range(80))
    docs = spark.createDataFrame([(i, text(i // 2) + " end" * (i % 2)) for i in range(12)], "doc_id long, text string")
    got = group_join.near_copies(docs, share=0.0).select("component_id").distinct()
    assert sorted(r[0] for r in got.collect()) == [0, 2, 4, 6, 8, 10]
    plan = steps["near-shared"][0]
    rare = plan.select(F.col("shingle"))._jdf.queryExecution().optimizedPlan().toString().split("posexplode(rare")
    assert len(rare) == 2, "rare shingles are read once"


def test_classes_that_few_share_shingles_with_are_asked_alone_and_texts_are_packed(spark, steps):
    """A family was asked as a whole, so that texts with a shared passage, and their whole family, were compared: 6.6 x input was moved."""
    r = random.Random(9)
    words = lambda k: [f"v{r.randrange(10**9)}" for _ in range(k)]
    passages = [words(9) for _ in range(12)]
    texts = [words(60) + passages[i % 12] + words(60 + i) for i in range(48)]
    texts += [[*t[:-1], "end"] for t in texts[:6]] + [["é\U0001f600", *texts[0]]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in group_join.near_copies(docs, share=0.0).collect()}
    assert got == {i: i - 48 if 48 <= i < 54 else 0 if i == 54 else i for i in range(55)}
    teams = steps["near-teams"][0]._jdf.queryExecution().optimizedPlan().toString()
    assert "holders" in teams, "few holders: alone"
    assert dict(steps["near-texts"][0].dtypes) == {"doc_id": "bigint", "n_bytes": "int", "packed": "binary"}


@pytest.mark.parametrize(("few", "rows"), [(0, 500_000), (64, 0)])
def test_any_grouping_and_either_join_give_the_same_links(spark, monkeypatch, few, rows):
    monkeypatch.setattr(group_join, "FEW", few)
    monkeypatch.setattr(group_join, "SMALL_ROWS", rows)
    r = random.Random(3)
    stock = [f"s{i}" for i in range(400)]
    base = [[r.choice(stock) for _ in range(70)] for _ in range(8)]
    texts = [b[:k] + [f"x{i}"] + b[k + 1 :] if i % 3 else b[: 40 + k] for i, (b, k) in enumerate((b, k) for b in base for k in (3, 20, 35, 66))]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    sets = [set(group_join.shingles(" ".join(t)).tolist()) for t in texts]
    want = list(range(len(texts)))
    for _ in texts:
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                if 100 * len(x & y) >= 80 * len(x | y):
                    want[i] = want[j] = min(want[i], want[j])
    got = {r["doc_id"]: r["component_id"] for r in group_join.near_copies(docs).collect()}
    assert got == dict(enumerate(want))


def test_texts_come_back_as_they_were_packed(spark):
    docs = spark.createDataFrame([(1, "aé\U0001f600\x00 b" * 50), (2, ""), (3, None), (1, "aé\U0001f600\x00 b" * 50), (4, "x")], "doc_id long, text string")
    found = group_join._texts(docs, spark.createDataFrame([(1,), (2,), (3,)], "doc_id long")).collect()
    assert {r["doc_id"]: group_join._unpacked(r["n_bytes"], bytes(r["packed"])) for r in found} == {1: "aé\U0001f600\x00 b" * 50, 2: "", 3: ""}
    assert len(found) == 3
