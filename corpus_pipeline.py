"""Documents to training sequences: toxic ones go, one of each group of near copies stays, leaks go, secrets are masked, the rest is packed.

Each stage reads all that the one before kept, as Parquet, and returns the columns
of documents, but for the last, which returns pieces of sequences.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import one_label, small_side, table
from corpusloom.llm.decontamination import contained_items
from corpusloom.llm.ngram_join import similar_documents
from corpusloom.llm.packing import pack_documents
from corpusloom.llm.queries import tokenizer_path
from corpusloom.llm.secret_scan import redacted
from corpusloom.llm.token_ids import WORDS_KEPT
from corpusloom.llm.toxicity import THRESHOLD, learn_toxicity
from corpusloom.session import cut_lineage, shared_folder, small_batches

_BROADCAST_ROWS = 300_000
# Packing runs in executors whose heaps the stages before have filled: a quarter of the words that it keeps alone.
PACKING_WORDS = WORDS_KEPT // 4


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below the threshold; a missing text scores as an empty one.

    Where the labels teach nothing (none of one kind, or too few), all stay.
    """
    small_batches(spark)
    labels = one_label(table(spark, sf_dir, "labels"), "toxic", F.lit(True))
    model = learn_toxicity(docs, labels)
    if not len(model.buckets):
        return docs
    return docs.where(model.column("text") < THRESHOLD)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of linked documents, and all linked to nothing.

    Rows that repeat an id are one document, of which one row stays. Rows without an
    id cannot be the one that stands for a group: of equal texts among them one stays.
    """
    small_batches(spark)
    told = cut_lineage(similar_documents(docs).where(F.col("doc_id").isNotNull()))
    gone = cut_lineage(told.where(F.col("doc_id") != F.col("class_id")).select("doc_id").distinct())
    repeated = cut_lineage(told.groupBy("doc_id").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("doc_id"))
    kept = docs.where(F.col("doc_id").isNotNull()).join(small_side(gone, _BROADCAST_ROWS), "doc_id", "left_anti")
    single = kept.join(small_side(repeated, _BROADCAST_ROWS), "doc_id", "left_anti")
    several = kept.join(small_side(repeated, _BROADCAST_ROWS), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    nameless = docs.where(F.col("doc_id").isNull()).dropDuplicates(["text"])
    return single.unionByName(several).unionByName(nameless).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark, told by text, so that rows without an id count too."""
    key = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    texts = docs.select(key.alias("doc_id"), "text")
    leaks = contained_items(texts, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("_leak")).distinct()
    leaks = small_side(cut_lineage(leaks), _BROADCAST_ROWS)
    return docs.join(leaks, key == leaks["_leak"], "left_anti")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark; n_chars follows the text."""
    masked = docs.withColumn("text", redacted(F.col("text")))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 ids."""
    small_batches(spark)
    return pack_documents(docs, tokenizer_path(), words_kept=PACKING_WORDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secrets", mask_secrets),
    ("packing", pack),
]

# Learned scores and packing have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid4()}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
