"""Exact cosine search of many questions in a large index, block by block.

Index and questions are packed into blocks of vectors, one row each; every block of questions meets every block of the index and keeps
its k best rows so far. With pivots the index is ordered by nearest pivot and distance from it. Unit vectors of cosine s are
sqrt(2 - 2 s) apart, and by the triangle inequality x is at least |d(q, p) - d(x, p)| from q; so once a question has k rows, only rows
in a ring around a block's pivot can better the worst of them, and most blocks have none. The questions of a cell first meet the blocks of
the same cell, and the k-th scores they find there are where all other blocks begin.
"""

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from quipu.scratch import run_folder
from quipu.workers import with_package

#: Bytes of vectors in a block, at most, and of question blocks that are broadcast together.
BLOCK_BYTES = 2 << 20
BROADCAST_BYTES = 32 << 20
#: Blocks of the index that a block of questions meets in one task where they are shuffled.
BLOCKS_A_TASK = 16
#: Pivots, and rows of the index that they are chosen from, at most.
PIVOTS = 64
PIVOT_SAMPLE = 4096
#: Scores are compared up to the noise of floating-point sums, so that equal texts tie and the key decides.
SCORE_DIGITS = 12
_SLACK = 1e-9


def _stored(rows: DataFrame, name: str) -> DataFrame:
    path = run_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Vectors as rows; the shorter ones end in zeros."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    size = int(lengths.max(initial=0))
    if (lengths == size).all():
        return flat.reshape(-1, size)
    out = np.zeros((len(lengths), size), flat.dtype)
    out[np.arange(size) < lengths[:, None]] = flat
    return out


def _usable(vectors: DataFrame, name: str) -> DataFrame:
    """Rows whose vector has a length to divide by."""
    numbers = F.forall(name, lambda x: x.isNotNull() & ~F.isnan(x))
    return vectors.filter(F.col(name).isNotNull() & numbers & F.exists(name, lambda x: x != 0))


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def choose_pivots(index: DataFrame, pivots: int = PIVOTS, sample: int = PIVOT_SAMPLE) -> np.ndarray:
    """Unit vectors far from each other, of a bounded sample by hash of the key: each is the one farthest from those before it."""
    rows = _usable(index, "embedding").select("embedding", F.xxhash64("key").alias("_orden"))
    rows = rows.orderBy("_orden").limit(sample).select("embedding").toArrow()
    if not rows.num_rows:
        return np.zeros((0, 0))
    x = unit(_matrix(rows.column(0).combine_chunks()))
    chosen, best = [0], x @ x[0]
    while len(chosen) < min(pivots, len(x)) and best.min() < 1 - _SLACK:
        chosen.append(int(best.argmin()))
        best = np.maximum(best, x @ x[chosen[-1]])
    return x[chosen]


def apart(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * cosines))


def _near(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivot of every row and the distance from it."""
    size = max(x.shape[1], pivots.shape[1])
    widened = [np.pad(m, ((0, 0), (0, size - m.shape[1]))) for m in (unit(x), pivots)]
    cosines = widened[0] @ widened[1].T
    cell = cosines.argmax(axis=1)
    return cell.astype(np.int32), apart(cosines[np.arange(len(x)), cell])


def packed(vectors: DataFrame, name: str, pivots: np.ndarray | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of (``name``, embedding) in stored blocks: bloque, celda, ids, largo (numbers in a vector), vectores (bytes of float32 or
    float64), lejos (distances from the cell's pivot, ascending). Null, zero and unmeasurable vectors are left out."""
    rows = _usable(vectors.select(name, "embedding"), "embedding")
    number = np.float64 if isinstance(rows.schema["embedding"].dataType.elementType, T.DoubleType) else np.float32
    kind = rows.schema[name].dataType
    if pivots is not None and len(pivots):
        placed = T.StructType([*rows.schema.fields, T.StructField("celda", T.IntegerType()), T.StructField("lejos", T.DoubleType())])

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    cell, away = _near(_matrix(batch.column("embedding")), pivots)
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(away)], names=[*batch.schema.names, "celda", "lejos"])

        rows = with_package(rows).mapInArrow(place, placed)
        rows = _stored(rows, "vector-cells")
        size = rows.agg(F.sum(F.size("embedding") * np.dtype(number).itemsize)).first()[0] or 0
        # A cell may hold any share of the rows: it is cut by distance and key, and may go over several tasks.
        rows = rows.repartitionByRange(max(1, size // (8 * block_bytes)), "celda", "lejos", name).sortWithinPartitions("celda", "lejos", name)
    else:
        rows = rows.withColumns({"celda": F.lit(0), "lejos": F.lit(0.0)})

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, length, cell = [], 0, None
        for batch in batches:
            cells = batch.column("celda").to_numpy()
            for part in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(cells)) + 1):
                if not len(part):
                    continue
                rows_each = max(1, block_bytes // max(1, number().itemsize * len(batch.column("embedding")[0])))
                for start in range(int(part[0]), int(part[-1]) + 1, rows_each):
                    piece = batch.slice(start, min(rows_each, int(part[-1]) + 1 - start))
                    if held and (cell != cells[start] or length + piece.num_rows > rows_each):
                        yield block(held)
                        held, length = [], 0
                    cell = cells[start]
                    held.append(piece)
                    length += piece.num_rows
        if held:
            yield block(held)

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks()
        x = _matrix(whole.column("embedding").combine_chunks()).astype(number)
        values = [
            pa.array([whole.column("celda")[0].as_py()], pa.int32()),
            pa.array([whole.column(name).to_pylist()], pa.list_(to_arrow_type(kind))),
            pa.array([x.shape[1]], pa.int32()), pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()),
            pa.array([whole.column("lejos").to_numpy().tobytes()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(values, ["celda", "ids", "largo", "vectores", "lejos"])

    fields = [("celda", T.IntegerType()), ("ids", T.ArrayType(kind)), ("largo", T.IntegerType()), ("vectores", T.BinaryType()), ("lejos", T.BinaryType())]
    made = with_package(rows).mapInArrow(pack, T.StructType([T.StructField(*f) for f in fields]))
    return _stored(made.select(F.monotonically_increasing_id().alias("bloque"), "*"), "vector-blocks")


class Best:
    """The k best (score, id) of each question of a block so far."""

    def __init__(self, questions: int, k: int, floor: np.ndarray | None):
        self.k, self.found = k, [[] for _ in range(questions)]
        self.least = np.full(questions, -np.inf) if floor is None else floor.copy()

    def add(self, who: int, scores: np.ndarray, ids: list) -> None:
        some = np.flatnonzero(scores >= self.least[who])
        if len(some) > self.k:
            # Ties with the k-th stay in until the ids decide.
            worst = np.partition(scores[some], len(some) - self.k)[len(some) - self.k]
            some = some[scores[some] >= worst]
        if len(some):
            merged = [*self.found[who], *((-scores[i], ids[i]) for i in some)]
            self.found[who] = heapq.nsmallest(self.k, merged)
            if len(self.found[who]) == self.k:
                self.least[who] = max(self.least[who], -self.found[who][-1][0])


def search_block(asked: np.ndarray, x: np.ndarray, ids: list, away: np.ndarray, pivot: np.ndarray | None, best: Best) -> int:
    """Adds what a block of the index has for a block of questions (unit vectors). Returns the number of scores computed."""
    size = max(asked.shape[1], x.shape[1])
    q, x = (np.pad(m, ((0, 0), (0, size - m.shape[1]))) for m in (asked, unit(x)))
    low, high = np.zeros(len(q), np.int64), np.full(len(q), len(x))
    if pivot is not None:
        at = apart(q[:, : len(pivot)] @ pivot[:size])
        reach = np.where(np.isfinite(best.least), apart(np.where(np.isfinite(best.least), best.least, 0.0) - _SLACK), np.inf) + np.sqrt(_SLACK)
        low, high = np.searchsorted(away, at - reach, "left"), np.searchsorted(away, at + reach, "right")
    some = np.flatnonzero(high > low)
    if not len(some):
        return 0
    start, end = int(low[some].min()), int(high[some].max())
    # Adding 0.0 turns a rounded -0.0 into 0.0.
    scores = np.round(q[some] @ x[start:end].T, SCORE_DIGITS) + 0.0
    for row, who in enumerate(some.tolist()):
        best.add(who, scores[row], ids[start:end])
    return scores.size


def _met(index: DataFrame, questions: DataFrame, same_cell: bool | None) -> DataFrame:
    asked = questions.select(*[F.col(c).alias(f"q_{c}") for c in questions.columns])
    if same_cell:
        return index.join(asked, F.col("celda") == F.col("q_celda"))
    other = F.lit(True) if same_cell is None else F.col("celda") != F.col("q_celda")
    size = questions.agg(F.sum(F.octet_length("vectores"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return index.join(F.broadcast(asked), other)
    salts = -(-index.count() // BLOCKS_A_TASK)
    numbers = F.broadcast(asked.select("q_bloque"))
    dealt = index.join(numbers, F.col("q_bloque") >= 0).withColumn("_sal", F.pmod(F.xxhash64("bloque"), F.lit(salts)))
    salted = asked.withColumn("_sal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return dealt.join(salted, ["q_bloque", "_sal"]).filter(other).drop("_sal")


def _searched(pairs: DataFrame, k: int, pivots: np.ndarray | None) -> DataFrame:
    kinds = [pairs.schema[c].dataType.elementType for c in ("q_ids", "ids")]
    schema = T.StructType(
        [T.StructField("bloque", T.LongType()), T.StructField("lugar", T.IntegerType()), T.StructField("question_id", kinds[0]),
         T.StructField("key", kinds[1]), T.StructField("score", T.DoubleType())]
    )
    columns = ["celda", "ids", "largo", "vectores", "lejos", *[c for c in pairs.columns if c.startswith("q_")]]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple[list, np.ndarray, Best]] = {}
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                number = np.float32 if len(row["vectores"]) == 4 * len(row["ids"]) * row["largo"] else np.float64
                x = np.frombuffer(row["vectores"], number).reshape(len(row["ids"]), row["largo"])
                if row["q_bloque"] not in kept:
                    number = np.float32 if len(row["q_vectores"]) == 4 * len(row["q_ids"]) * row["q_largo"] else np.float64
                    asked = unit(np.frombuffer(row["q_vectores"], number).reshape(len(row["q_ids"]), row["q_largo"]))
                    floor = None
                    if row.get("q_minimos"):
                        floor = np.full(len(asked), -np.inf)
                        floor[[f["lugar"] for f in row["q_minimos"]]] = [f["score"] for f in row["q_minimos"]]
                    kept[row["q_bloque"]] = row["q_ids"], asked, Best(len(asked), k, floor)
                    if len(kept) > BLOCKS_A_TASK:
                        old = next(iter(kept))
                        yield rows_of(old, *kept.pop(old))
                _, asked, best = kept[row["q_bloque"]]
                search_block(asked, x, row["ids"], np.frombuffer(row["lejos"], np.float64), None if pivots is None else pivots[row["celda"]], best)
        for number, held in kept.items():
            yield rows_of(number, *held)

    def rows_of(number: int, ids: list, _: np.ndarray, best: Best) -> pa.RecordBatch:
        found = [(number, place, ids[place], key, -score) for place, rows in enumerate(best.found) for score, key in rows]
        values = list(zip(*found, strict=True)) if found else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(v, to_arrow_type(f.dataType)) for v, f in zip(values, schema.fields, strict=True)], schema.names)

    return with_package(pairs.select(*columns)).mapInArrow(step, schema)


def nearest_blocks(index: DataFrame, questions: DataFrame, k: int, pivots: np.ndarray | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """question_id, key, score, rank: the k best keys for every question. index: packed rows of ``key``, by ``pivots`` if given;
    questions: question_id and embedding. No question passes through the driver and none is left out."""
    asked = packed(questions, "question_id", pivots, block_bytes)
    place = Window.partitionBy("bloque", "lugar").orderBy(F.desc("score"), "key")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    if pivots is None or not len(pivots):
        found = _searched(_met(index, asked, None), k, None)
    else:
        first = _stored(_searched(_met(index, asked, True), k, pivots), "vector-near")
        floors = ranked(first).filter(F.col("rank") == k).groupBy("bloque").agg(F.collect_list(F.struct("lugar", "score")).alias("minimos"))
        found = first.unionByName(_searched(_met(index, asked.join(floors, "bloque", "left"), False), k, pivots))
    return ranked(found).select("question_id", "key", "score", "rank")
