"""Callers' columns that are named like results and helpers; cut archives; limits of the mix."""

import collections

import pytest
from pyspark.sql import functions as F

from quipu.llm import mixing, packing, pii, quality, rules, secret_scan, warc
from quipu.llm.queries import tokenizer_path

TEXTS = ["mail me at anna@firma.de or call +49 (30) 1234567 now", "token: abcdefgh12345678", None, "", "plain words " * 40, "plain words " * 40]


@pytest.fixture(scope="module")
def plain(spark):
    rows = [(i, t, "a" if i % 2 else "b") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


CLASHES = {
    "pii": ["email", "ip", "card", "phone", "base", "added", "candidates", "n_email", "n_card", "__text", "__number", "__spoken", "__name", "spans"],
    "rules": [*rules.COUNTS, "base_failed", "quality", "kept", "__text", "__words", "__lines"],
    "quality": ["quality", "__in_text", "score"],
    "mixing": ["size", "source_size", "target", "times", "limit", "weight", "level", "__ticket", "__step", "__whole", "__more", "__cut", "__s"],
    "secrets": ["blob", "findings", "rule", "__text", "__first", "__paths", "__missing", "__seen", "__path"],
    "pieces": ["piece", "start", "length", "ids_crc32", "sequence_id", "offset", "n", "__slice", "__rank", "__before", "__place", "__in_text"],
}


def run(name, docs):
    if name == "pii":
        return pii.find_personal_data(docs)
    if name == "rules":
        return rules.vote_quality(docs)
    if name == "quality":
        return quality.score_quality(docs, quality.grow(*_points()))
    if name == "mixing":
        return mixing.repetitions(docs)
    if name == "secrets":
        return secret_scan.scan(docs)
    return packing.pack(packing.pieces(docs, tokenizer_path()))


def _points():
    import numpy as np

    x = np.random.default_rng(1).normal(size=(60, len(quality.FEATURES)))
    return x, (x[:, 0] > 0).astype(float)


@pytest.mark.parametrize("name", list(CLASHES))
def test_clashing_columns_come_back(spark, plain, name):
    extra = CLASHES[name]
    docs = plain.select("*", *[F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")).alias(c) for c in extra])
    alone, beside = run(name, plain), run(name, docs)
    own = [c for c in alone.columns if c not in ("sequence_id", "offset")]
    show = lambda rows: sorted(map(str, rows.select(*own).collect()))
    assert show(alone) == show(beside)
    back = {c: f"{c}_before" if c in alone.columns else c for c in extra}
    assert set(beside.columns) == set(alone.columns) | set(back.values())
    for row in beside.collect():
        assert [row[back[c]] for c in extra] == [f"{c}-{row['doc_id']}" for c in extra]
    assert run(name, docs.limit(0)).count() == 0


def test_a_cut_archive_is_refused(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"u{i}", f"<p>page {i}</p>" * (1 + 40 * i)) for i in range(5)], "page_id long, url string, html string").coalesce(1)
    files, folder = warc.archive(pages, str(tmp_path / "w"))
    path = files.first()["path"]
    whole = open(path, "rb").read()
    assert warc.read_chunks(files, folder).filter("last").count() == 5
    ends, rest = [], whole
    import zlib

    while rest:
        z = zlib.decompressobj(31)
        z.decompress(rest)
        rest = z.unused_data
        ends.append(len(whole) - len(rest))
    assert len(ends) == 5
    for cut in (0, 5, ends[0] - 1, ends[0], ends[0] + 1, ends[3], ends[3] + 10, len(whole) - 60, len(whole) - 1):
        with open(path, "wb") as out:
            out.write(whole[:cut])
        with pytest.raises(Exception, match="truncated|records of"):
            warc.read_chunks(files, folder).collect()
    with open(path, "wb") as out:
        out.write(whole)
    assert warc.read_chunks(files, folder).filter("last").count() == 5


def test_chunks_are_cut_one_by_one(spark):
    payloads = {0: b"", 1: b"x", 2: b"0123456789", 3: b"0123456789a", 4: bytes(range(256)) * 5}
    rows = [(i, None, f"d{i}", len(p), "response", None, bytearray(p)) for i, p in payloads.items()] + [(9, None, "d", 11, "revisit", 3, bytearray(b"0123456789a"))]
    ddl = "page_id long, url string, payload_digest string, payload_bytes long, record_type string, refers_to long, __payload binary"
    found = collections.defaultdict(list)
    for r in warc.chunk_rows(spark.createDataFrame(rows, ddl), 10).collect():
        found[r["page_id"]].append((r["chunk_no"], r["last"], bytes(r["data"])))
    assert found.pop(9) == [(0, True, b"")]
    for i, p in payloads.items():
        n = max(1, -(-len(p) // 10))
        assert found[i] == [(k, k == n - 1, p[10 * k : 10 * k + 10]) for k in range(n)]


def test_no_document_exceeds_its_epochs(spark):
    rows = [(i, "" if i % 2 else "a b c", "s" if i < 40 else "t") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    times = [r["times"] for r in mixing.repetitions(docs, max_epochs=3).collect()]
    assert max(times) <= 3 and mixing.mix(docs).groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3


def test_equal_texts_with_other_labels_teach_nothing(spark):
    from quipu.llm import toxicity

    texts = [f"you scoundrel wretch {i} " + "plain talk " * (i % 7) for i in range(60)] + [f"a calm day {i} " + "plain talk " * (i % 7) for i in range(120)]
    rows = [(i, t, int(i < 60)) for i, t in enumerate(texts)]
    # Each toxic text again, labelled clean, and a clean one again with its own label, in any order of rows.
    rows += [(1000 + i, t, 0) for i, t in enumerate(texts[:3])] + [(2000, texts[70], 0)]
    learnt = []
    for order in (rows, rows[::-1], [r for r in rows if not (r[0] < 3 or 1000 <= r[0] < 1003)]):
        docs = spark.createDataFrame([r[:2] for r in order], "doc_id long, text string").repartition(3)
        labels = spark.createDataFrame([(r[0], r[2]) for r in order], "doc_id long, toxic int")
        model = toxicity.train(docs, labels)
        learnt.append({w: round(x, 9) for w, x in model.lexicon.items()})
    assert learnt[0] == learnt[1] and len(learnt[0]) > 0
