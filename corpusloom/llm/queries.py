"""One query per operator of this folder: the operator over its whole table, and digests of its results."""

from __future__ import annotations

from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.chat_format import chat_digest, format_chats, read_chats
from corpusloom.llm.common import in_fold, one_label, table
from corpusloom.llm.decontamination import contained_items
from corpusloom.llm.lexical_search import search_documents
from corpusloom.llm.lm_scoring import score_texts
from corpusloom.llm.ngram_join import similar_documents
from corpusloom.llm.oracles import ORACLES
from corpusloom.llm.packing import pack_documents, packed_digest
from corpusloom.llm.quality_gam import score_quality
from corpusloom.llm.quality_rules import quality_rules
from corpusloom.llm.secret_scan import KINDS, find_secrets, spans_text
from corpusloom.llm.sharding import shard_documents
from corpusloom.llm.token_files import read_token_files, write_token_files
from corpusloom.llm.toxicity import learn_toxicity, score_toxicity
from corpusloom.llm.whitening import whiten
from corpusloom.session import shared_folder

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def op1_quality_rules(spark, sf_dir) -> DataFrame:
    judged, _ = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged


def op2_ngram_jaccard_join(spark, sf_dir) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"))


def op3_secret_scans(spark, sf_dir) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] < KINDS.index("entropy"))
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"),
    )


def op4_toxicity(spark, sf_dir) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), in_fold("doc_id", 4, 2)
    model = learn_toxicity(docs, one_label(table(spark, sf_dir, "labels"), "toxic", ~held_out))
    return score_toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_token_files(spark, sf_dir) -> DataFrame:
    folder = f"{shared_folder(spark)}/tokens-{uuid4()}"
    write_token_files(table(spark, sf_dir, "documents"), tokenizer_path(), folder)
    read = read_token_files(spark, folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_chat_formatting(spark, sf_dir) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    formatted = format_chats(turns.unionByName(extra))
    folder = f"{shared_folder(spark)}/chats-{uuid4()}"
    formatted.write.parquet(folder)
    return chat_digest(read_chats(spark.read.schema(formatted.schema).parquet(folder)))


def op7_benchmark_decontamination(spark, sf_dir) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_packing(spark, sf_dir) -> DataFrame:
    # Alone on its executors, the packing has memory for more words than as a stage of the pipeline.
    return packed_digest(pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), words_kept=800_000))


def op9_sharding(spark, sf_dir) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_quality_classifier(spark, sf_dir) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), in_fold("doc_id", 3, 1)
    known = one_label(table(spark, sf_dir, "labels"), "quality", ~held_out)
    scored, _ = score_quality(docs, known)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op11_embedding_whitening(spark, sf_dir) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_lexical_search(spark, sf_dir) -> DataFrame:
    return search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_lm_scoring(spark, sf_dir) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), in_fold("doc_id", 7, 2))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_ngram_jaccard_join, op3_secret_scans, op4_toxicity, op5_token_files, op6_chat_formatting,
        op7_benchmark_decontamination, op8_packing, op9_sharding, op10_quality_classifier,
        op11_embedding_whitening, op12_lexical_search, op13_lm_scoring,
    )
}

__all__ = ["ORACLES", "QUERIES"]
