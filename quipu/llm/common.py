"""Shared expressions: words, code-point spans, stored tables."""

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quipu.scratch import run_folder
from quipu.workers import with_package

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
_BLOCK = 64


def no_rows(spark: SparkSession, columns: str) -> DataFrame:
    """An empty table of the columns of a DDL. createDataFrame([]) would start Python workers of another kind beside those of the steps,
    on every executor."""
    fields = T.StructType.fromDDL(columns).fields
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows written to the cluster's shared folder and read again: cuts lineage, survives lost executors."""
    path = run_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    found = rows.sparkSession.read.schema(rows.schema).parquet(path)
    found.stored_in = path
    return found


def discard(*tables: DataFrame) -> None:
    """Removes stored tables that nothing reads any more: what was made of them is stored itself. The driver's garbage is collected as
    well, since Spark removes the shuffle files of what was made before only then."""
    for rows in tables:
        jvm, conf = rows.sparkSession.sparkContext._jvm, rows.sparkSession.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(rows.stored_in)
        path.getFileSystem(conf).delete(path, True)
    if tables:
        jvm.System.gc()


#: Rows of a few small columns that may be broadcast.
SMALL_ROWS = 500_000


def small_side(rows: DataFrame, at_most: int = SMALL_ROWS) -> DataFrame:
    """A stored table for the small side of a join: broadcast where it is counted to be small, else joined by shuffle."""
    return F.broadcast(rows) if rows.count() <= at_most else rows


#: Rows of texts that a task reads from Parquet or hands to Python at a time, at most.
BATCH_ROWS = 1_000
_BATCHES = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")


@contextmanager
def text_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside takes at most BATCH_ROWS rows at a time: Spark's own batches of 4,096 and 10,000 texts are larger than what an
    executor and its Python workers have room for beside the heap. Smaller settings of the session stay; all are as before afterwards."""
    before = {name: spark.conf.get(name, None) for name in _BATCHES}
    for name, value in before.items():
        if value is None or not 0 < int(value) <= BATCH_ROWS:
            spark.conf.set(name, str(BATCH_ROWS))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


#: What operators keep in a Python worker from task to task, by name.
KEPT: dict[str, dict] = {}


def forget(keeps: str = "") -> None:
    """Empties what is kept, but for ``keeps``, and returns free memory to the system. A worker serves one step after the other as long as
    the session lasts, and what it holds counts beside the executor's heap, also while a step without Python runs."""
    for name, kept in KEPT.items():
        if name != keeps:
            kept.clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lean(step: Callable[[Iterator], Iterator], keeps: str = "") -> Callable[[Iterator], Iterator]:
    """The Python step, which begins and ends with no more in its worker than it keeps."""

    def run(batches: Iterator) -> Iterator:
        forget(keeps)
        try:
            yield from step(batches)
        finally:
            forget(keeps)

    return run


#: Python sees about so many bytes of a batch at a time.
PART_BYTES = 8 << 20


def cut_batch(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about PART_BYTES; Arrow batches may be much larger than what Python objects leave room for."""
    rows = max(1, batch.num_rows * PART_BYTES // max(1, batch.nbytes))
    for k in range(0, batch.num_rows, rows):
        yield batch.slice(k, rows)


def map_batches(rows: DataFrame, used: list[str], kept: list[str], added: str, compute: Callable[..., dict], keeps: str = "") -> DataFrame:
    """kept columns as they are, plus the columns of the DDL ``added``, computed batch by batch in Python.

    compute gets the used columns as lists and returns a list or array for every added column, and, where it makes several rows of
    one or none, "rows": the place of each result's input row. Kept columns stay in Arrow, so nulls and large ids survive. keeps: what compute leaves in KEPT for
    the worker's next task.
    """
    fields = T.StructType.fromDDL(added).fields
    types = [to_arrow_type(f.dataType) for f in fields]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in cut_batch(whole)):
            made = compute(*[batch.column(f"__in_{c}").to_pylist() for c in used])
            places = made.get("rows")
            old = [batch.column(c) for c in kept]
            if places is not None:
                old = [c.take(pa.array(np.asarray(places, np.int64))) for c in old]
            new = [pa.array(made[f.name], t) for f, t in zip(fields, types, strict=True)]
            yield pa.RecordBatch.from_arrays([*old, *new], names=[*kept, *[f.name for f in fields]])

    source = with_package(rows).select(*[F.col(f"`{c}`") for c in kept], *[F.col(c).alias(f"__in_{c}") for c in used])
    return source.mapInArrow(lean(step, keeps), T.StructType([*[rows.schema[c] for c in kept], *fields]))


def whole_text(name: str = "text") -> Column:
    """The text; empty where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, also where use() puts it into lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def word_list(text: Column) -> Column:
    """Words of a text: maximal runs without ASCII white space."""
    return bound(
        F.trim(text, F.lit(BLANKS)),
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE, -1)),
    )


def word_count(text: Column) -> Column:
    """Number of words."""
    return bound(F.trim(text, F.lit(BLANKS)), lambda t: F.when(t == "", 0).otherwise(F.size(F.split(t, SPACE, -1)))).cast("long")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _ends(steps: Column) -> Column:
    """Running sums, block by block, so that many matches in one text don't cost their square."""

    def inside(offsets: Column) -> Column:
        block = lambda i: F.floor(i / _BLOCK).cast("int")
        return F.transform(
            steps,
            lambda _, i: F.get(offsets, block(i)) + _total(F.slice(steps, block(i) * _BLOCK + 1, i % _BLOCK + 1)),
        )

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / _BLOCK).cast("int")),
        lambda b: _total(F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK))),
    )
    return bound(
        blocks,
        lambda sums: bound(F.transform(sums, lambda _, i: F.when(i == 0, 0).otherwise(_total(F.slice(sums, F.lit(1), i)))), inside),
    )


SPANS = "array<struct<start:int,end:int,hit:string>>"


def spans(text: Column, pattern: str, where: Column | None = None) -> Column:
    """Leftmost non-overlapping matches with their place in code points (end exclusive).

    The pieces between matches and the matches themselves alternate, so places are running sums of lengths. ``where``: a cheap
    necessary condition; texts without it are not searched.
    """

    def placed(hits: Column) -> Column:
        def joined(gaps: Column) -> Column:
            steps = F.transform(hits, lambda h, i: F.length(h) + F.get(gaps, i))
            return bound(
                bound(steps, _ends),
                lambda ends: F.transform(
                    hits, lambda h, i: F.struct((F.get(ends, i) - F.length(h)).alias("start"), F.get(ends, i).alias("end"), h.alias("hit"))
                ),
            )

        return F.when(F.size(hits) > 0, bound(F.transform(F.split(text, pattern, -1), lambda p: F.length(p)), joined))

    found = bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)
    if where is not None:
        found = F.when(where, found)
    return F.coalesce(found.cast(SPANS), F.array().cast(SPANS))


def span_text(all_spans: Column) -> Column:
    """kind:start:end, comma-joined, of an array of struct(start, rank, kind, end) by start, then rank."""
    return F.concat_ws(
        ",",
        F.transform(
            F.sort_array(all_spans),
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
    )


def ranked(found: Column, kind: str, rank: int) -> Column:
    """Spans with their kind, in the form span_text() takes."""
    return F.transform(
        found,
        lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end")),
    )
