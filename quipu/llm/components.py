"""Connected components by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import discard, stored


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, label): every node of edges (a, b) that isn't the smallest of its component, with that smallest node.

    Each round shortens paths by half, also in long chains; it ends when a round changes nothing. Nothing but two numbers a round
    reaches the driver.
    """
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = stored(now, "components")
    mark = _mark(now)
    for _ in range(rounds if mark[0] else 0):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))
        small = large.join(least, "u").select(F.inline(pairs)).filter("u <> v").distinct()
        before, now = now, stored(small, "components")
        discard(before)
        last, mark = mark, _mark(now)
        if mark == last:
            break
    else:
        if mark[0]:
            raise RuntimeError("components did not settle")
    found = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    found.stored_in = now.stored_in
    return found
