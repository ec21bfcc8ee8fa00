"""The stored vector index: refreshed by what changed.

Every refresh adds one folder with the rows that differ from what is stored: documents with a new text get a new vector, those with other
metadata keep theirs, and documents that are gone leave a tombstone. The newest row of a key counts. Rows are numbered in loads of at
most LOAD_ROWS for stores that take so many at a time.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.config import BROADCAST_ROWS
from quipu.operators.search import embed_by_hashing
from quipu.sources.folders import exists, names, put_once

#: Fixed value: rows of one load.
LOAD_ROWS = 50
METADATA = ["dominio", "corte", "categoria_bloque", "tipo_registro", "es_futuro", "seccion", "concepto", "valor"]


def last_refresh(spark: SparkSession, path: str) -> int:
    """Number of the newest refresh, -1 before the first."""
    return max((int(n.removeprefix("lote=")) for n in names(spark, path) if n.startswith("lote=")), default=-1)


def _rows(spark: SparkSession, path: str) -> DataFrame:
    # Refreshes are read by name: one that is committed meanwhile is not half seen.
    folders = [f"{path}/lote={n}" for n in range(last_refresh(spark, path) + 1)]
    return spark.read.option("basePath", path).parquet(*folders)


def _newest(rows: DataFrame) -> DataFrame:
    """(key, lote, huella, ficha) of the newest row of every key that is not gone; vectors aren't read."""
    last = F.max_by(F.struct("lote", "huella", "ficha", "borrado"), "lote").alias("_")
    found = rows.groupBy("key").agg(last).select("key", "_.*")
    return found.filter("NOT borrado").drop("borrado")


def read_index(spark: SparkSession, path: str) -> DataFrame | None:
    """key, embedding, metadata, huella (of the text), vector_de (the refresh that made the vector) and lote (that wrote the row)."""
    if last_refresh(spark, path) < 0:
        return None
    rows = _rows(spark, path)
    current = _newest(rows).select("key", "lote")
    return rows.join(current, ["key", "lote"], "left_semi").select("key", "embedding", "metadata", "huella", "vector_de", "lote")


def _print(value: Column) -> Column:
    return F.sha2(F.coalesce(value, F.lit("")), 256)


def _wanted(documents: DataFrame) -> DataFrame:
    metadata = F.struct(*METADATA)
    return documents.select(F.col("id").alias("key"), "texto", metadata.alias("metadata"), _print(F.col("texto")).alias("huella"), _print(F.to_json(metadata)).alias("ficha"))


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return _newest(_rows(spark, path)).select("key", F.col("huella").alias("_huella"), F.col("ficha").alias("_ficha"), F.col("lote").alias("_lote"))


def differing(documents: DataFrame, path: str) -> DataFrame:
    """(key, huella, ficha, _lote, _nuevo) of the documents that differ from what is stored; _nuevo: in their text. Texts stay where they
    are, only their prints meet the stored ones."""
    met = _wanted(documents).select("key", "huella", "ficha").join(_stored(documents.sparkSession, path), "key", "left")
    new = ~F.col("huella").eqNullSafe(F.col("_huella"))
    found = met.withColumn("_nuevo", new).filter(F.col("_nuevo") | (F.col("ficha") != F.col("_ficha")))
    return found.select("key", "huella", "ficha", "_lote", "_nuevo").distinct()


def changes(
    documents: DataFrame, path: str, number: int, embed=embed_by_hashing, whole: bool = True, differ: DataFrame | None = None, few: bool = False
) -> DataFrame:
    """The rows that refresh ``number`` adds. documents: id (unique), texto and the metadata columns. ``whole``: they are all that there
    is, so that stored keys without a document are gone. ``differ``: what ``differing`` found, if it is known; ``few``: it may be
    broadcast, so that texts aren't shuffled."""
    spark, wanted = documents.sparkSession, _wanted(documents)
    fields = ["key", "embedding", "metadata", "huella", "ficha", "vector_de", "borrado"]
    made_now = [F.lit(number).alias("vector_de"), F.lit(False).alias("borrado")]
    if number == 0:
        return embed(wanted).select(*fields[:5], *made_now)
    differ = differing(documents, path) if differ is None else differ
    side = F.broadcast if few else lambda rows: rows
    new, other = side(differ.filter("_nuevo").select("key", "huella", "ficha")), side(differ.filter("NOT _nuevo").select("key", "huella", "ficha", "_lote"))
    # A document without a key is new in every refresh.
    same = [wanted[c].eqNullSafe(new[c]) for c in ("key", "huella", "ficha")]
    fresh = embed(wanted.join(new, same, "left_semi"))
    moved = wanted.drop("texto").join(other, ["key", "huella", "ficha"])
    vectors = _rows(spark, path).select("key", F.col("lote").alias("_lote"), "embedding", "vector_de")
    moved = moved.join(vectors, ["key", "_lote"]).withColumn("borrado", F.lit(False))
    found = fresh.select(*fields[:5], *made_now).unionByName(moved.select(*fields))
    if not whole:
        return found
    stored = _stored(spark, path)
    gone = stored.join(wanted.select("key"), "key", "left_anti").select("key", F.col("_huella").alias("huella"), F.col("_ficha").alias("ficha"))
    empty = {c: F.lit(None).cast(fresh.schema[c].dataType) for c in ("embedding", "metadata")}
    gone = gone.withColumns({**empty, "vector_de": F.lit(None).cast("int"), "borrado": F.lit(True)})
    return found.unionByName(gone.select(*fields))


def refresh(documents: DataFrame, path: str, embed=embed_by_hashing, number: int | None = None, whole: bool = True) -> bool:
    """Adds the refresh after the newest one, or ``number``; False if it is there already. A repeated refresh of the same documents adds
    a folder without rows. Without ``whole`` nothing is taken out."""
    number = last_refresh(documents.sparkSession, path) + 1 if number is None else number
    if exists(documents.sparkSession, f"{path}/lote={number}"):
        return False
    differ = differing(documents, path).persist() if number else None
    try:
        rows = changes(documents, path, number, embed, whole, differ, number > 0 and differ.count() <= BROADCAST_ROWS)
        return put_once(_loaded(rows), path, f"lote={number}")
    finally:
        if differ is not None:
            differ.unpersist()


def _loaded(rows: DataFrame) -> DataFrame:
    place = F.monotonically_increasing_id()  # counts through a partition
    rows = rows.withColumn("_n", place).withColumn("carga", F.struct(F.shiftright("_n", 33).alias("parte"), F.floor((F.col("_n") % (1 << 33)) / LOAD_ROWS).alias("n")))
    return rows.drop("_n")


def loads(spark: SparkSession, path: str, number: int) -> DataFrame:
    """The rows of one refresh in lists of at most LOAD_ROWS, for a store outside: cambios has key, embedding, metadata and borrado."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/lote={number}")
    return rows.groupBy("carga").agg(F.collect_list(F.struct("key", "embedding", "metadata", "borrado")).alias("cambios"))
