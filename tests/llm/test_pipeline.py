"""The pipeline's stages on small tables with odd rows."""

import collections
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from quipu.llm import mixing, packing
from quipu.llm.queries import tokenizer_path

RUDE = ["scoundrel", "wretch", "villain", "knave"]


def text(seed, n=80):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(90_000)}" for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows, labels = [], []
    for i in range(120):
        rude = i % 4 == 0
        t = text(i) + (" " + " ".join(RUDE[:3]) if rude else "")
        rows.append((i, t, f"s{i % 3}"))
        labels.append((i, int(rude)))
    rows += [(200 + i, text(1) + (f" end{i}" if i else ""), "s0") for i in range(3)]
    rows += [(300, "key: password=abcdefgh1234 here", "s1"), (301, None, "s1"), (302, "", None), (None, text(500), "s2"), (None, None, None), (303, text(501), "s2")]
    rows += [(303, text(501), "s2"), (304, "word " * 9_000, "s1")]
    full = [(i, t, "en", s, len(t or ""), 1) for i, t, s in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, size int").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages, seen = dict(pipeline.STAGES), {}
    assert list(stages) == ["toxicity", "near_copies", "secrets", "mixing", "packing"]
    for name, stage in stages.items():
        before, docs = docs, pipeline.stored(stage(spark, docs, folder), f"test-{name}")
        seen[name] = (before, docs)
        assert name == "packing" or docs.columns == before.columns
    ids = lambda d: collections.Counter(r["doc_id"] for r in d.select("doc_id").collect())

    before, after = seen["toxicity"]
    assert ids(before) - ids(after) == collections.Counter({i: 1 for i in range(0, 120, 4)})
    before, after = seen["near_copies"]
    assert ids(before) - ids(after) == collections.Counter({200: 1, 201: 1, 202: 1, 303: 1})
    before, after = seen["secrets"]
    changed = [r for r in after.collect() if r["text"] and "[SECRET]" in r["text"]]
    assert [(r["doc_id"], r["text"], r["n_chars"]) for r in changed] == [(300, "key: [SECRET] here", 18)]
    assert ids(before) == ids(after)
    before, after = seen["mixing"]
    times = mixing.repetitions(before).groupBy("doc_id").agg(F.sum("times").alias("n")).collect()
    assert ids(after) == +collections.Counter({r["doc_id"]: r["n"] for r in times})
    before, after = seen["packing"]
    assert after.count() == packing.pieces(before.select("doc_id", "text"), tokenizer_path()).count()
    by = collections.defaultdict(list)
    for r in after.collect():
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 2048


def test_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
