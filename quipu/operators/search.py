"""Embedding and exact cosine search."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quipu.config import BROADCAST_ROWS
from quipu.operators.vector_blocks import BLOCK_BYTES, SCORE_DIGITS, choose_pivots, nearest_blocks, packed

DIMENSION = 1536
TOP_K = 5
WORDS = r"[\p{L}\p{M}\p{N}_]+"
WORD_CACHE = 200_000
#: Rows that are embedded together.
EMBED_ROWS = 1024
# Scores are shown shorter than they are compared.
SHOWN_DIGITS = 6


def embed_by_hashing(rows: DataFrame, text: str = "texto", output: str = "embedding", dimension: int = DIMENSION) -> DataFrame:
    """Unit-length term-frequency vectors by feature hashing over the whole text.

    Words are runs of letters, marks, digits and underscores of any script, in lower case. A word's place is the first 32 bits of
    its MD5 modulo ``dimension``. A null text and one without words give the zero vector. Spark finds the words; a task hashes each
    different word of a batch once and counts places in whole arrays.
    """
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(WORDS), F.lit(0))
    kept = rows.select(*[c for c in rows.columns if c != output], words.alias("_palabras"))
    schema = T.StructType([*[f for f in kept.schema.fields if f.name != "_palabras"], T.StructField(output, T.ArrayType(T.FloatType()))])
    names = schema.fieldNames()[:-1]

    def place(word: str) -> int:
        return int.from_bytes(hashlib.md5(word.encode("utf-8", "surrogatepass")).digest()[:4], "big") % dimension

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places: dict[str, int] = {}
        for batch in (whole.slice(k, EMBED_ROWS) for whole in batches for k in range(0, whole.num_rows, EMBED_ROWS)):
            if len(places) > WORD_CACHE:
                places.clear()
            found = batch.column("_palabras")
            different = found.flatten().dictionary_encode()
            for word in different.dictionary.to_pylist():
                if word not in places:
                    places[word] = place(word)
            own = np.fromiter((places[w] for w in different.dictionary.to_pylist()), np.int64, len(different.dictionary))
            row = np.repeat(np.arange(batch.num_rows), found.value_lengths().to_numpy(zero_copy_only=False))
            spots = row * dimension + own[different.indices.to_numpy()] if len(row) else row
            vectors = np.bincount(spots, minlength=batch.num_rows * dimension).reshape(-1, dimension).astype(np.float64)
            lengths = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
            unit = (vectors / np.where(lengths > 0, lengths, 1)).astype(np.float32)
            made = pa.ListArray.from_arrays(pa.array(np.arange(0, unit.size + 1, dimension), pa.int32()), pa.array(unit.ravel()))
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], made], names=[*names, output])

    return kept.mapInArrow(embed, schema)


def build_index(documents: DataFrame, embed=embed_by_hashing) -> DataFrame:
    """(key, embedding, metadata) from documents; ``embed`` adds an embedding column from texto."""
    fields = ["dominio", "corte", "categoria_bloque", "tipo_registro", "es_futuro", "seccion", "concepto", "valor"]
    return embed(documents).select(F.col("id").alias("key"), "embedding", F.struct(*fields).alias("metadata"))


def write_index(index: DataFrame, path: str) -> None:
    """Full refresh: readers see the old files until the job commits."""
    index.write.mode("overwrite").parquet(path)


def cosine(vector: Column, query: list) -> Column:
    """Cosine similarity with one fixed vector; null for a zero vector."""
    q = F.array(*[F.lit(float(x)) for x in query])
    dot = F.aggregate(F.zip_with(vector, q, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda t, x: t + x)
    size = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double")))
    length = float(np.sqrt(np.dot(query, query)))
    return F.when((size > 0) & F.lit(length > 0), dot / (size * F.lit(length)))


def nearest(index: DataFrame, query: list, k: int = TOP_K) -> DataFrame:
    """The k best keys for one question vector."""
    scored = index.withColumn("score", F.round(cosine(F.col("embedding"), query), SCORE_DIGITS))
    best = scored.filter(F.col("score").isNotNull()).orderBy(F.col("score").desc(), "key").limit(k)
    return best.withColumn("score", F.round("score", SHOWN_DIGITS))


def nearest_for_all(index: DataFrame, questions: DataFrame, k: int = TOP_K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(question_id, key, score, rank): the k best keys for every question (question_id, embedding), each row of the index scored.

    Questions go to the tasks in blocks; only k candidates per question and task are shuffled. For an index that is asked often,
    ``pivot_index`` and ``nearest_by_pivots`` score a part of it.
    """
    found = nearest_blocks(packed(index, "key"), questions, k, block_bytes=block_bytes)
    return found.withColumn("score", F.round("score", SHOWN_DIGITS) + 0.0)


def pivot_index(index: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """The index in blocks around pivots, and the pivots."""
    pivots = choose_pivots(index)
    return packed(index, "key", pivots), pivots


def nearest_by_pivots(blocks: DataFrame, pivots: np.ndarray, questions: DataFrame, k: int = TOP_K) -> DataFrame:
    """The same rows as ``nearest_for_all``, without scoring what the triangle inequality rules out."""
    return nearest_blocks(blocks, questions, k, pivots).withColumn("score", F.round("score", SHOWN_DIGITS) + 0.0)


def with_metadata(hits: DataFrame, index: DataFrame, at_most: int) -> DataFrame:
    """Hits with their index metadata. ``at_most`` bounds the hits (k per question)."""
    side = F.broadcast(hits) if at_most <= BROADCAST_ROWS else hits
    return index.select("key", "metadata").join(side, "key")


NO_CONTEXT = "No se encontró información relevante."


def context(questions: DataFrame, hits: DataFrame) -> DataFrame:
    """(question_id, contexto): the hits of a question as text blocks in rank order.

    ``hits`` carries rank and the metadata struct. At most k hits exist per
    question, so the collected lists are small.
    """

    def shown(name: str) -> Column:
        return F.coalesce(F.col(f"metadata.{name}").cast("string"), F.lit("None"))

    # The wording of a text block.
    labels = [("Dominio", "dominio"), ("Periodo", "corte"), ("Sección", "seccion"), ("Concepto", "concepto"), ("Valor", "valor")]
    lines = [F.concat(F.lit(f"{label}: "), shown(name), F.lit("\n")) for label, name in labels]
    blocks = hits.select("question_id", "rank", F.concat(F.lit("\n"), *lines).alias("_bloque"))
    joined = blocks.groupBy("question_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "_bloque"))), lambda b: b["_bloque"]), "\n").alias("contexto")
    )
    return (
        questions.select("question_id")
        .join(joined, "question_id", "left")
        .withColumn("contexto", F.coalesce("contexto", F.lit(NO_CONTEXT)))
    )


def answer_context(index: DataFrame, questions: DataFrame, k: int = TOP_K) -> DataFrame:
    """(question_id, contexto) for every question against the index."""
    hits = nearest_for_all(index, questions, k)
    return context(questions, with_metadata(hits, index, k * questions.count()))


def valid_questions(requests: DataFrame) -> DataFrame:
    """Requests that have both a question and a channel."""
    return requests.filter((F.coalesce("question", F.lit("")) != "") & (F.coalesce("channel_id", F.lit("")) != ""))
