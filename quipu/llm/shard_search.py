"""Blocks of queries against shards: every block meets every shard, and the k-th score found so far is shared.

A few shards are searched first; the k-th scores they give are the floors of the others. Inside a task the best results of a block go on
from shard to shard.
"""

from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quipu.llm.balls import NO_SCORE, Best
from quipu.llm.common import stored, with_package

#: Blocks of queries are broadcast up to so many bytes in all; beyond, shards and blocks meet by a shuffle.
BROADCAST_BYTES = 32 << 20
#: Shards that a block meets in one task where they are shuffled.
SHARDS_A_TASK = 16
#: One shard in so many is searched first.
FIRST = 16
#: Blocks whose results a task keeps while it goes from shard to shard.
KEPT_BLOCKS = 64


def met(shards: DataFrame, blocks: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Every shard with every block, whose columns get the prefix q_. blocks has size, its bytes."""
    total = blocks.agg(F.sum("size")).first()[0] or 0
    asked = blocks.select(*[F.col(c).alias(f"q_{c}") for c in blocks.columns])
    if total <= broadcast_bytes:
        return shards.join(F.broadcast(asked), F.size("q_ids") > 0)
    salts = -(-shards.count() // SHARDS_A_TASK)
    numbers = F.broadcast(blocks.select(F.col("block").alias("q_block")))
    dealt = shards.join(numbers, F.col("q_block") >= 0).withColumn("salt", F.pmod(F.xxhash64("shard"), F.lit(salts)))
    return dealt.join(asked.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))), ["q_block", "salt"]).drop("salt")


def _searched(pairs: DataFrame, k: int, load: Callable, ask: Callable) -> DataFrame:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: OrderedDict[int, tuple[list, Best]] = OrderedDict()
        shard, at = None, None
        for batch in batches:
            names = {c: batch.schema.names.index(c) for c in batch.schema.names}
            take = lambda r, start: {c.removeprefix("q_"): batch.column(i)[r].as_py() for c, i in names.items() if c.startswith("q_") == start}  # noqa: B023, E731
            for r in range(batch.num_rows):
                if (number := batch.column(names["shard"])[r].as_py()) != at:
                    at, shard = number, load(take(r, False))
                block = take(r, True)
                if block["block"] not in kept:
                    kept[block["block"]] = block["ids"], Best(len(block["ids"]), k, _floor(block))
                kept.move_to_end(block["block"])
                ask(shard, block, kept[block["block"]][1])
                if len(kept) > KEPT_BLOCKS:
                    yield _rows(*kept.popitem(last=False))
        for item in kept.items():
            yield _rows(*item)

    return with_package(pairs).mapInArrow(step, "block long, place int, query_id long, found long, score long")


def _floor(block: dict) -> np.ndarray | None:
    if not block.get("floors"):
        return None
    floor = np.full(len(block["ids"]), NO_SCORE, np.int64)
    floor[[f["place"] for f in block["floors"]]] = [f["kth"] for f in block["floors"]]
    return floor


def _rows(block: int, held: tuple[list, Best]) -> pa.RecordBatch:
    ids, best = held
    who, column = np.nonzero(best.scores != NO_SCORE)
    own = pa.array(ids, pa.int64()).take(pa.array(who))
    arrays = [pa.array(np.full(len(who), block)), pa.array(who.astype(np.int32)), own, pa.array(best.ids[who, column]), pa.array(best.scores[who, column])]
    return pa.RecordBatch.from_arrays(arrays, ["block", "place", "query_id", "found", "score"])


def top_k(shards: DataFrame, blocks: DataFrame, k: int, load: Callable[[dict], object], ask: Callable[[object, dict, Best], object], broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """query_id, rank (from 1), found, score: every query's k highest scores over all shards, ties to the smaller found id.

    shards: stored rows with a number ``shard``, from which load() makes what ask() searches; blocks: stored rows with ``block``,
    ``ids`` (array of the queries' ids) and ``size``, its bytes. ask() adds what it finds for the block's queries to a Best.
    """
    first = F.pmod(F.xxhash64("shard"), F.lit(FIRST)) == 0
    early = stored(_searched(met(shards.filter(first), blocks, broadcast_bytes), k, load, ask), "search-early")
    place = Window.partitionBy("block", "place").orderBy(F.desc("score"), "found")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    floors = ranked(early).filter(F.col("rank") == k).groupBy("block").agg(F.collect_list(F.struct("place", F.col("score").alias("kth"))).alias("floors"))
    late = _searched(met(shards.filter(~first), blocks.join(floors, "block", "left"), broadcast_bytes), k, load, ask)
    return ranked(early.unionByName(late)).select("query_id", "rank", "found", "score")
