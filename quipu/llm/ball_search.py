"""Exact top-k by inner product: a ball tree per shard, searched best-first by blocks of queries.

Components become whole numbers, floor(256 x). The vectors are cut into shards as they are read, without a shuffle; each shard is one
row with its points and its tree. A query opens the nodes of a shard in the order of their upper bounds, centre . q + |q| radius, and
ends where none can better its k-th score. That score is shared: a few shards are searched first, and what they give is the floor of
all others; inside a task it goes on from shard to shard. Whole numbers are compared exactly, ties go to the smaller id.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.llm import balls, shard_search
from quipu.llm.common import cut_batch, stored, with_package

SCALE = 256
TOP = 5
ASK_EVERY = 50
#: Bytes of points in a shard, and queries in a block (fewer where vectors are long), about.
SHARD_BYTES = 1 << 20
BLOCK_BYTES = 1 << 19
LEAF_ROWS = 64
_LARGEST_NORM = 2.0**31

_INDEX = "dim int, n int, ids binary, points binary, starts binary, ends binary, lefts binary, least binary, centres binary, radii binary"


def whole_vectors(values: pa.Array) -> list[np.ndarray | None]:
    """floor(256 x) of every vector; None for vectors that are null, hold a null or non-finite component, or are too long for exact
    64-bit products."""
    out: list[np.ndarray | None] = []
    for row in values:
        found = row.values
        if found is None or found.null_count:
            out.append(None)
            continue
        x = np.floor(SCALE * found.to_numpy(zero_copy_only=False).astype(np.float64)) if len(found) else np.empty(0)
        out.append(x.astype(np.int32) if np.isfinite(x).all() and np.sqrt((x * x).sum()) < _LARGEST_NORM else None)
    return out


def _blocks(batches: Iterator[pa.RecordBatch], bytes_each: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, ids, points) of vectors of one length, cut into blocks of about ``bytes_each``."""
    held: dict[int, list] = {}
    for batch in (part for whole in batches for part in cut_batch(whole)):
        for i, x in zip(batch.column("vec_id").to_pylist(), whole_vectors(batch.column("embedding")), strict=True):
            if x is None or i is None:
                continue
            rows = held.setdefault(len(x), [])
            rows.append((i, x))
            if len(rows) * max(1, len(x)) * 4 >= bytes_each:
                yield len(x), *_stacked(held.pop(len(x)))
    for dim, rows in held.items():
        yield dim, *_stacked(rows)


def _stacked(rows: list) -> tuple[np.ndarray, np.ndarray]:
    return np.asarray([i for i, _ in rows], np.int64), np.stack([x for _, x in rows])


def tree_of(ids: np.ndarray, points: np.ndarray) -> balls.Tree:
    x = points.astype(np.float64)

    def ball(rows: np.ndarray) -> tuple:
        centre = x[rows].mean(axis=0)
        return centre, np.sqrt(((x[rows] - centre) ** 2).sum(axis=1))

    def side(rows: np.ndarray, away: np.ndarray) -> np.ndarray:
        one = x[rows[away.argmax()]]
        other = x[rows[((x[rows] - one) ** 2).sum(axis=1).argmax()]]
        return x[rows] @ (other - one)

    return balls.build(len(ids), ids, LEAF_ROWS, ball, side)


def index(vectors: DataFrame) -> DataFrame:
    """The shards of vectors (vec_id long, embedding): one row each, with its tree. Other columns are left out."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, ids, points in _blocks(batches, SHARD_BYTES):
            tree = tree_of(ids, points)
            parts = [ids[tree.order], points[tree.order], tree.start, tree.end, tree.left, tree.least, tree.centre, tree.radius]
            row = [[dim], [len(ids)], *[[np.ascontiguousarray(p).tobytes()] for p in parts]]
            names = [c.split()[0] for c in _INDEX.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int32() if k < 2 else pa.binary()) for k, v in enumerate(row)], names)

    made = with_package(vectors.select("vec_id", "embedding")).mapInArrow(step, _INDEX)
    return made.select(F.monotonically_increasing_id().alias("shard"), "*")


def question_blocks(asks: DataFrame) -> DataFrame:
    """Queries (vec_id, embedding) in blocks of one dimension; equal rows ask once."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, ids, points in _blocks(batches, BLOCK_BYTES):
            values = ((dim, pa.int32()), (ids.tolist(), pa.list_(pa.int64())), (points.tobytes(), pa.binary()), (points.nbytes + ids.nbytes, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in values], ["dim", "ids", "points", "size"])

    asks = stored(asks.select("vec_id", "embedding").distinct(), "ball-asks")
    size = asks.agg(F.sum(F.size("embedding") * 4)).first()[0] or 0
    made = with_package(asks.repartition(max(1, size // BLOCK_BYTES))).mapInArrow(step, "dim int, ids array<long>, points binary, size long")
    return made.select(F.monotonically_increasing_id().alias("block"), "*")


def _loaded(row: dict) -> tuple[balls.Tree, np.ndarray, np.ndarray]:
    n, dim, as_longs = row["n"], row["dim"], lambda c: np.frombuffer(row[c], np.int64)
    centre = np.frombuffer(row["centres"], np.float64).reshape(-1, dim) if dim else np.zeros((len(as_longs("starts")), 0))
    tree = balls.Tree(np.arange(n), as_longs("starts"), as_longs("ends"), as_longs("lefts"), as_longs("least"), centre, np.frombuffer(row["radii"], np.float64))
    return tree, as_longs("ids"), np.frombuffer(row["points"], np.int32).reshape(n, dim)


def _asked(shard: tuple, block: dict, best: balls.Best) -> int:
    points = np.frombuffer(block["points"], np.int32).reshape(len(block["ids"]), block["dim"])
    return search_shard(*shard, np.asarray(block["ids"], np.int64), points, best)


def search_shard(tree: balls.Tree, ids: np.ndarray, points: np.ndarray, own: np.ndarray, asked: np.ndarray, best: balls.Best) -> int:
    """Adds a shard's rows to ``best`` for the queries ``asked`` (ids ``own``). Vectors of different lengths: the shorter one counts
    as ending in zeros."""
    dim = min(points.shape[1], asked.shape[1])
    x, q = points.astype(np.float64), asked.astype(np.float64)
    norms, centre = np.sqrt((q * q).sum(axis=1)), tree.centre
    centre_norms = np.sqrt((centre * centre).sum(axis=1))
    bounds = balls.upper_bounds(q[:, :dim] @ centre[:, :dim].T, norms, centre_norms, tree.radius)
    longest = np.sqrt((x * x).sum(axis=1).max(initial=0.0)) * norms.max(initial=0.0)
    exact = longest < balls.EXACT / 2

    def score(who: np.ndarray, rows: np.ndarray) -> tuple:
        if exact:
            found = (q[who][:, :dim] @ x[rows][:, :dim].T).astype(np.int64)
        else:
            found = asked[who][:, :dim].astype(np.int64) @ points[rows][:, :dim].astype(np.int64).T
        found[own[who][:, None] == ids[rows][None, :]] = balls.NO_SCORE
        return found, ids[rows]

    return balls.search(tree, bounds, best, score)


def top_k(shards: DataFrame, asks: DataFrame, k: int = TOP) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of the index with the highest inner products for every query, its own id's
    rows left out; ties go to the smaller vec_id. shards: a stored index; asks: (vec_id, embedding).

    Vectors that are null or empty of an id, or hold null or non-finite components, take no part on either side, and neither do those
    whose scaled norm reaches 2**31, whose products may not fit 64 bits. A vector without components scores 0. Equal rows ask once but
    are found as often as they stand there; of one id with different vectors each asks for itself. Empty tables give an empty result.
    """
    blocks = stored(question_blocks(asks), "ball-questions")
    found = shard_search.top_k(shards, blocks, k, _loaded, _asked)
    return found.withColumnRenamed("found", "vec_id")
