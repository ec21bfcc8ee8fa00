"""Running balances that a limited decrement never takes below zero.

Per key and in replay order a step either adds x, or is limited:
w := max(0, w + x). Both are functions w -> max(a, w + b), which compose, so a
balance follows from two running aggregates instead of a row-by-row walk. With
S the running sum and M the running minimum of S over the limited steps:

    balance from an absent key     S - least(0, M)
    balance from a start balance w greatest(w + S, S - M)
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quipu.config import BROADCAST_ROWS
from quipu.schema import KEY, ORDER
from quipu.scratch import enable_checkpoints

# Above this many steps on one key the key is split over tasks.
HOT_KEY_STEPS = 5_000_000

# Positions inside a chunk take the low bits, the chunk number the high ones.
CHUNK_POSITION_BITS = 40


def _running(steps: DataFrame, group: list) -> DataFrame:
    """Adds the running values of each group.

    _s is the running sum, _m the running minimum of _s over limited steps, _m0
    that minimum before the step, and posicion counts the steps. One sort serves
    all of them.
    """
    ordered = Window.partitionBy(*group).orderBy(*ORDER)
    so_far, before = ordered.rowsBetween(Window.unboundedPreceding, 0), ordered.rowsBetween(Window.unboundedPreceding, -1)
    limited = F.when(F.col("limitado"), F.col("_s"))
    summed = steps.withColumns({"_s": F.sum("delta").over(so_far), "posicion": F.row_number().over(ordered).cast("bigint")})
    return summed.withColumns(
        {"_m": F.min(limited).over(so_far), "_m0": F.min(limited).over(before)}
    )


def _with_effect(running: DataFrame, start: Column) -> DataFrame:
    """Adds saldo and efectivo (what the step really changed) from a group's start balance; row by row."""
    # greatest() skips nulls, so without limited steps the balance is start + sum.
    sum_before = F.col("_s") - F.col("delta")
    before = F.greatest(start + sum_before, sum_before - F.col("_m0"))
    return (
        running.withColumn("saldo", F.greatest(start + F.col("_s"), F.col("_s") - F.col("_m")))
        .withColumn("efectivo", F.col("saldo") - before)
        .drop("_s", "_m", "_m0")
    )


def step_counts(steps: DataFrame) -> tuple:
    """(steps on the fullest key, all steps, keys)."""
    per_key = steps.groupBy(*KEY).count()
    row = per_key.agg(F.max("count").alias("most"), F.sum("count").alias("all"), F.count("count").alias("keys")).first()
    return row["most"] or 0, row["all"] or 0, row["keys"]


def running_balance(steps: DataFrame, hot_key_steps: int | None = HOT_KEY_STEPS, chunks: int | None = None) -> DataFrame:
    """Adds saldo, efectivo and posicion (the replay order inside a key) to every step.

    Normally one shuffle by key and one sort. A key with more than
    ``hot_key_steps`` steps would be one oversized sort, so then the steps are
    cut into ordered chunks first (``None`` skips the check). ``chunks`` sets
    their number.
    """
    if hot_key_steps is not None:
        most, total, keys = step_counts(steps)
        if most > hot_key_steps:
            default = int(steps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            return _chunked_balance(steps, chunks or max(default, -(-4 * total // hot_key_steps)), keys)
    return _with_effect(_running(steps, KEY), F.lit(0))


def _chunked_balance(steps: DataFrame, chunks: int, keys: int) -> DataFrame:
    """The same balances with every key spread over as many tasks as it fills.

    The full replay order is unique, so range partitioning balances the tasks
    whatever the skew; the partition number is the chunk. The running values of
    the chunks are checkpointed because two branches read them and the chunk
    numbers depend on sampled bounds.
    """
    enable_checkpoints(steps.sparkSession)
    ranged = steps.repartitionByRange(chunks, *KEY, *ORDER).withColumn("_chunk", F.spark_partition_id())
    group = KEY + ["_chunk"]
    local = _running(ranged, group).checkpoint()

    # One row per key and chunk. A range boundary cuts at most one key, so there are at most keys + chunks rows.
    summary = local.groupBy(*group).agg(F.sum("delta").alias("_sum"), F.min("_m").alias("_low"))
    earlier = Window.partitionBy(*KEY).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        summary.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        .withColumn("_floor", F.min(F.col("_before") + F.col("_low")).over(earlier))
        .withColumn("_start", F.col("_before") - F.least(F.lit(0), F.coalesce(F.col("_floor"), F.lit(0))))
        .select(*group, "_start")
    )
    if keys + chunks <= BROADCAST_ROWS:
        starts = F.broadcast(starts)
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"s.{c}")) for c in group]
    started = local.alias("l").join(starts.alias("s"), same).select("l.*", "s._start")
    position = F.shiftleft(F.col("_chunk").cast("bigint"), CHUNK_POSITION_BITS) + F.col("posicion")
    return _with_effect(started, F.col("_start")).withColumn("posicion", position).drop("_start", "_chunk")
