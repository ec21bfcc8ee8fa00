"""Mixing sources to target weights.

Targets come from capped water-filling: every source gets its share by weight, sources above their epoch limit are clamped to it,
and the excess goes to the others by weight until none is above. That is one water level, found by a sort of the sources by
limit per weight. Documents are then repeated: all of them the whole number of epochs, and a seeded part once more.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quipu.llm.columns import kept_apart
from quipu.llm.common import stored, whole_text, word_count

MAX_EPOCHS = 3
WEIGHTS = (5, 2, 1)
SEED = "mix-1"


def alternating_weights(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Weights by the sources' code-point order, null last."""
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source"))
    values = F.array(*[F.lit(w) for w in weights])
    return sources.withColumn("weight", F.get(values, (rank - 1) % len(weights)))


def targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """sources (source, source_size, weight) with target, a double; together they share the total of all sizes.

    The windows run over one row per source. A weight of 0 or a null one gives a target of 0.
    """
    s = sources.filter(F.col("weight") > 0).withColumn("limit", F.col("source_size") * max_epochs)
    whole = Window.partitionBy()
    order = Window.orderBy(F.col("limit") / F.col("weight"), "limit", "weight")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    past = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    level = (F.sum("source_size").over(whole) - past("limit")) / (F.sum("weight").over(whole) - past("weight"))
    s = s.withColumns({"level": level, "place": F.row_number().over(order)})
    fits = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("place"))
    s = s.withColumn("water", F.min_by("level", fits).over(whole))
    target = F.least(F.col("limit").cast("double"), F.col("water") * F.col("weight"))
    found = s.select("source", "source_size", F.coalesce(target, F.col("limit").cast("double")).alias("target"))
    none = sources.filter(~F.coalesce(F.col("weight") > 0, F.lit(False)))
    return found.unionByName(none.select("source", "source_size", F.lit(0.0).alias("target")))


def _ticket(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def _sized(docs: DataFrame, seed: str) -> DataFrame:
    rows = docs.withColumns({"size": word_count(whole_text()), "__ticket": _ticket(F.col("doc_id"), seed)})
    return rows.withColumn("__step", F.substring("__ticket", 1, 3))


def _decisions(rows: DataFrame, weigh, max_epochs: int) -> tuple[DataFrame, DataFrame]:
    """Per source: source_size, target, __whole epochs and the step that the cut falls into; per document of such a step: __more."""
    steps = stored(rows.groupBy("source", "__step").agg(F.sum("size").alias("step_size")), "mix-steps")
    sources = targets(weigh(steps.groupBy("source").agg(F.sum("step_size").alias("source_size"))), max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = sources.withColumn("__whole", epochs.cast("long"))
    sources = sources.withColumn("__need", F.col("target") - F.col("__whole") * F.col("source_size"))
    filled = Window.partitionBy("source").orderBy("__step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = steps.withColumn("__upto", F.sum("step_size").over(filled))
    reach = reach.join(sources.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")), "left")
    rest = F.col("__need") - F.col("__upto") + F.col("step_size")
    cut = reach.groupBy("source").agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.first("__whole").alias("__whole"),
        F.min(F.when(F.col("__upto") > F.col("__need"), F.struct("__step", rest.alias("rest")))).alias("__cut"),
    )
    cut = stored(cut.withColumnRenamed("source", "__source"), "mix-targets")
    inside = rows.join(cut, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__step") == F.col("__cut.__step")))
    inside = inside.groupBy("source", "doc_id", "size", "__ticket").agg(F.count("*").alias("n"), F.first("__cut").alias("__cut"))
    order = Window.partitionBy("source").orderBy("__ticket", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.col("size") * F.col("n")
    more = (F.sum(own).over(order) - own / 2 <= F.col("__cut.rest")).cast("long")
    keys = {"source": "__s", "doc_id": "__id", "size": "__size"}
    return cut, stored(inside.select("source", "doc_id", "size", more.alias("__more")).withColumnsRenamed(keys), "mix-cuts")


def _decided(rows: DataFrame, cut: DataFrame, edge: DataFrame, max_epochs: int) -> DataFrame:
    """rows with source_size, target and times."""
    same = F.col("source").eqNullSafe(F.col("__s")) & F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("size") == F.col("__size"))
    out = rows.join(cut, F.col("source").eqNullSafe(F.col("__source")), "left").join(edge, same, "left")
    before = F.coalesce(F.col("__step") < F.col("__cut.__step"), F.lit(False)).cast("long")
    # Documents without a word fit behind any target.
    out = out.withColumn("times", F.least(F.col("__whole") + F.coalesce("__more", before), F.lit(max_epochs).cast("long")))
    return out.drop("__ticket", "__step", "__cut", "__whole", "__more", "__source", *["__s", "__id", "__size"])


def repetitions(docs: DataFrame, weigh=alternating_weights, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per row of docs (doc_id, source, text, ...), without its text: size, source_size, target and times, how often the mix
    takes it.

    Documents of a source are ordered by a seeded ticket; the part of a target beyond whole epochs is filled in that order, up to
    the nearest document. The order is found by its first 4096 steps: sums per step, and an exact sort in the step that the cut
    falls into only, so that no task holds a source. A null text has size 0; repeated rows of one id, source and size are taken
    together; an empty table gives an empty result. Reruns agree, and no document is taken more than max_epochs times. Other columns
    stay; one named like a result comes back as <name>_before.
    """

    def decided(rows: DataFrame) -> DataFrame:
        rows = stored(_sized(rows, seed).drop("text"), "mix-sizes")
        return _decided(rows, *_decisions(rows, weigh, max_epochs), max_epochs)

    return kept_apart(docs, ["doc_id", "source", "text"], decided)


def mix(docs: DataFrame, weigh=alternating_weights, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """docs repeated as the mix takes them, columns kept; rows taken no time are left out. Extra columns stay; those named like the
    helpers (size, times, source_size, target) come back unchanged."""
    renamed = docs.select(*[F.col(c).alias(c if c in ("doc_id", "source", "text") else f"__doc_{c}") for c in docs.columns])
    rows = stored(_sized(docs.select("doc_id", "source", "text"), seed).drop("text"), "mix-sizes")
    out = _decided(_sized(renamed, seed), *_decisions(rows, weigh, max_epochs), max_epochs).filter("times > 0")
    out = out.select(*renamed.columns, F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("__copy"))
    return out.select(*[F.col(c).alias(c.removeprefix("__doc_")) for c in renamed.columns])
