import numpy as np
import pytest

from quipu.operators import search, vector_blocks

SCHEMA = "key long, embedding array<float>, metadata struct<dominio: string, corte: string, seccion: string, concepto: string, valor: long>"


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(300, 8)).astype(np.float32)
    # A third of the index are copies of one vector, one vector is zero.
    vectors[::3] = vectors[0]
    vectors[5] = 0
    questions = rng.normal(size=(9, 8))
    questions[0] = vectors[0]
    return vectors, questions


@pytest.fixture
def index(spark, data):
    rows = [(i, v.tolist(), ("CASA", "2026-04", "S", None, i)) for i, v in enumerate(data[0])]
    return spark.createDataFrame([*rows, (999, None, None)], SCHEMA).repartition(5)


@pytest.fixture
def questions(spark, data):
    return spark.createDataFrame([(i, q.tolist()) for i, q in enumerate(data[1])], "question_id long, embedding array<double>")


def brute_force(vectors, question, k):
    size = np.linalg.norm(vectors.astype(np.float64), axis=1)
    scored = [
        (-round(float(vectors[i].astype(np.float64) @ question / (size[i] * np.linalg.norm(question))), 6), i)
        for i in range(len(vectors))
        if size[i] > 0
    ]
    return [(i, -s) for s, i in sorted(scored)[:k]]


@pytest.mark.parametrize("block_bytes", [8 << 20, 8 * 8 * 2])
def test_equals_brute_force(index, questions, data, block_bytes):
    rows = search.nearest_for_all(index, questions, 5, block_bytes).collect()
    for q in range(len(data[1])):
        got = [(r["key"], r["score"]) for r in sorted((r for r in rows if r["question_id"] == q), key=lambda r: r["rank"])]
        assert got == brute_force(data[0], data[1][q], 5)


def test_text_keys_and_all_ties(spark):
    rows = spark.createDataFrame([(f"k{i:02d}", [1.0, 2.0]) for i in range(20)], "key string, embedding array<float>")
    questions = spark.createDataFrame([("q", [2.0, 4.0]), ("zero", [0.0, 0.0])], "question_id string, embedding array<double>")
    got = [tuple(r) for r in search.nearest_for_all(rows.repartition(4), questions, 3).orderBy("rank").collect()]
    assert got == [("q", "k00", 1.0, 1), ("q", "k01", 1.0, 2), ("q", "k02", 1.0, 3)]


def test_one_question(index, data):
    got = [(r["key"], r["score"]) for r in search.nearest(index, data[1][3].tolist(), 5).collect()]
    assert got == brute_force(data[0], data[1][3], 5)


def test_context(spark, index, questions):
    empty = questions.limit(0)
    assert search.answer_context(index, empty).count() == 0
    hits = search.with_metadata(search.nearest_for_all(index, questions, 2), index, 18)
    rows = {r["question_id"]: r["contexto"] for r in search.context(questions, hits.filter("question_id <> 1")).collect()}
    assert rows[1] == search.NO_CONTEXT
    assert rows[0] == "\n".join(f"\nDominio: CASA\nPeriodo: 2026-04\nSección: S\nConcepto: None\nValor: {i}\n" for i in (0, 3))


def test_hashing_embedder(spark):
    texts = ["Saldo de casa", "saldo DE  casa", "otra cosa", "", None]
    rows = search.embed_by_hashing(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, texto string"), dimension=64).orderBy("n").collect()
    vectors = [np.array(r["embedding"]) for r in rows]
    assert all(len(v) == 64 for v in vectors)
    assert np.allclose(vectors[0], vectors[1]) and not np.allclose(vectors[0], vectors[2])
    assert np.allclose([np.linalg.norm(v) for v in vectors], [1, 1, 1, 0, 0])


def test_index_from_documents(spark, tmp_path):
    docs = spark.createDataFrame(
        [("a", "CASA", "2026-04", "X", "TOTAL", True, "S", "", 1, "saldo casa"), ("b", "CASA", "2026-04", "X", "TOTAL", True, "S", "", 2, "gasto salud")],
        "id string, dominio string, corte string, categoria_bloque string, tipo_registro string, es_futuro boolean, seccion string, concepto string, valor long, texto string",
    )
    path = str(tmp_path / "index")
    search.write_index(search.build_index(docs), path)
    stored = spark.read.parquet(path)
    question = search.embed_by_hashing(spark.createDataFrame([("gasto en salud",)], "texto string")).first()["embedding"]
    best = search.nearest(stored, question, 1).first()
    assert best["key"] == "b" and best["metadata"]["valor"] == 2


def test_pivots_leave_no_neighbour_out(spark, monkeypatch):
    r = np.random.default_rng(4)
    centres = r.normal(size=(25, 12))
    rows = [(f"k{i:04d}", (centres[i % 25] + r.normal(size=12) / 20).tolist()) for i in range(1500)]
    rows += [(f"s{i:04d}", rows[7][1]) for i in range(400)]  # equal vectors: keys decide
    rows += [("none", None), ("zero", [0.0] * 12), ("null", [None] + [1.0] * 11), ("nan", [float("nan")] * 12)]
    asked = [(i, rows[i * 30][1]) for i in range(40)] + [(40, r.normal(size=12).tolist()), (41, [0.0] * 12), (42, None)]
    index = spark.createDataFrame(rows, "key string, embedding array<double>").repartition(5)
    questions = spark.createDataFrame(asked, "question_id long, embedding array<double>")
    x = vector_blocks.unit(np.asarray([v for _, v in rows[:1900]]))
    want = set()
    for i, v in asked[:41]:
        scores = np.round(x @ (np.asarray(v) / np.linalg.norm(v)), 12) + 0.0
        best = sorted((-s, k) for s, (k, _) in zip(scores, rows, strict=False))[:5]
        want |= {(i, k, round(-s, 6) + 0.0, n + 1) for n, (s, k) in enumerate(best)}
    monkeypatch.setattr(vector_blocks, "BLOCK_BYTES", 4000)
    pivots = vector_blocks.choose_pivots(index, 25)
    blocks = vector_blocks.packed(index, "key", pivots, 4000)
    assert blocks.count() > 30
    for limit in (32 << 20, 0):
        monkeypatch.setattr(vector_blocks, "BROADCAST_BYTES", limit)
        got = search.nearest_by_pivots(blocks, pivots, questions).select("question_id", "key", "score", "rank")
        assert {tuple(r) for r in got.collect()} == want
        assert {tuple(r) for r in search.nearest_for_all(index, questions, 5, 1000).select("question_id", "key", "score", "rank").collect()} == want
    # What is scored once the question's own cell was searched.
    scored, best = 0, vector_blocks.Best(1, 5, None)
    q = x[:1]
    cell = int((pivots @ q[0]).argmax())
    for row in sorted(blocks.collect(), key=lambda b: b["celda"] != cell):
        vectors = np.frombuffer(row["vectores"]).reshape(len(row["ids"]), -1)
        scored += vector_blocks.search_block(q, vectors, row["ids"], np.frombuffer(row["lejos"]), pivots[row["celda"]], best)
    assert scored < 1900 / 3
    assert sorted(k for _, k in best.found[0]) == sorted(k for i, k, _, _ in want if i == 0)
    nothing = index.limit(0)
    assert search.nearest_by_pivots(*search.pivot_index(nothing), questions).count() == search.nearest_for_all(index, questions.limit(0)).count() == 0
