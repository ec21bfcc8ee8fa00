"""Corpus preparation: the stages of the training-data pipeline, each over all that its predecessor kept."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quipu.llm import group_join, mixing, packing, secret_scan, toxicity
from quipu.llm.common import small_side, stored, table, text_batches, whole_text
from quipu.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose toxicity stays below the operator's limit. The lexicon is learnt from the labels of the documents at hand."""
    model = toxicity.train(docs, table(spark, folder, "labels"))
    return toxicity.score_texts(docs, model).filter(F.col("toxicity") < toxicity.REJECT).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of every component of near copies: the one with the smallest id, once. Rows without an id all stay."""
    found = stored(group_join.near_copies(docs).select("doc_id", "component_id"), "pipeline-components")
    copies = stored(found.filter("doc_id <> component_id").select("doc_id").distinct(), "pipeline-copies")
    again = stored(found.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "pipeline-again")
    kept = docs.join(small_side(copies), "doc_id", "left_anti")
    once = kept.join(small_side(again), "doc_id", "left_anti")
    first = kept.join(small_side(again), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return once.select(*docs.columns).unionByName(first.select(*docs.columns))


def mask_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with every finding masked; n_chars follows the text where a text changes."""
    found = secret_scan.scan(docs.select("doc_id", "text")).filter(F.size("findings") > 0)
    found = stored(found.select("blob", "findings").dropDuplicates(["blob"]), "pipeline-findings")
    keyed = docs.withColumn("blob", F.unhex(F.sha2(whole_text(), 256))).join(small_side(found), "blob", "left")
    changed = F.col("findings").isNotNull()
    text = F.when(changed, secret_scan.masked(F.col("text"), F.col("findings"))).otherwise(F.col("text"))
    out = keyed.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents repeated as often as the mix takes them."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of all documents with their place in a sequence; a document that the mix repeats is packed as often."""
    rows = packing.pack(packing.pieces(docs.select("doc_id", "text"), tokenizer_path()))
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Scores, shingle components and packing are no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The last stage's rows. Every stage's result is written as Parquet to the shared folder and read again."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        with text_batches(spark):
            docs = stored(stage(spark, docs, folder), f"pipeline-{name}")
    return docs
