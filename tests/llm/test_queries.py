"""Queries and pipeline on the smallest tables; those with SQL against it."""

import importlib.util
import os
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from check_oracles import TABLES, canonical
from corpusloom.llm.queries import ORACLES, QUERIES
from llm.test_toxicity import toxic_docs

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no benchmark tables here")
spec = importlib.util.spec_from_file_location("corpus_pipeline", Path(__file__).parents[2] / "corpus_pipeline.py")
pipeline = importlib.util.module_from_spec(spec)
spec.loader.exec_module(pipeline)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    ours, theirs = QUERIES[name](spark, FOLDER).toPandas(), con.execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns) and len(ours) == len(theirs) > 0
    assert canonical(ours).tolist() == canonical(theirs).tolist()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op11_embedding_whitening"}))
def test_one_row_per_document(spark, name):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id")
    found = QUERIES[name](spark, FOLDER)
    if name == "op8_packing":
        found = found.where("start = 0")
    assert found.select("doc_id").exceptAll(docs).isEmpty() and found.count() == docs.count()


def test_scores_on_rows_held_out(spark):
    folder = "/root/testdata/sf0.01"
    for name, label in (("op4_toxicity", "toxic"), ("op10_quality_classifier", "quality")):
        labels = spark.read.parquet(f"{folder}/labels.parquet")
        rows = QUERIES[name](spark, folder).join(labels, "doc_id").where("held_out").toPandas()
        folds = [zlib.crc32(str(i).encode()) % (4 if label == "toxic" else 3) for i in rows["doc_id"]]
        assert set(folds) == {2 if label == "toxic" else 1}
        ranks, hit = rows["score"].rank().to_numpy(), rows[label].to_numpy() == 1
        area = (ranks[hit].sum() - hit.sum() * (hit.sum() + 1) / 2) / (hit.sum() * (~hit).sum())
        assert area > 0.8, (name, area)


def test_stages_take_effect(spark, make_docs, odd_rows, tmp_path):
    item = " ".join(f"question{k}" for k in range(30))
    rows = odd_rows + [(60, item + " and more"), (61, "password = hunter2hunter2 " + " ".join(f"w{k}" for k in range(60)))]
    folder = str(tmp_path)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(9, 0), (8, 0), (10, 1)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = make_docs(rows)
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "near_copies", "decontamination", "secrets", "packing"]
    stages = dict(pipeline.STAGES)

    def ids(df):
        assert df.columns == docs.columns
        return sorted(str(r["doc_id"]) for r in df.collect())

    every = sorted(str(i) for i, _ in rows)
    gone = ["2", "2", "3"]
    assert ids(stages["near_copies"](spark, docs, folder)) == sorted(x for x in every if x not in gone)
    assert ids(stages["decontamination"](spark, docs, folder)) == sorted(x for x in every if x != "60")
    masked = stages["secrets"](spark, docs, folder)
    assert ids(masked) == every
    row = masked.where("doc_id = 61").first()
    assert row["text"].startswith("[SECRET] w0 ") and row["n_chars"] == len(row["text"])
    assert masked.where("doc_id <> 61").select("doc_id", "text").exceptAll(docs.select("doc_id", "text")).isEmpty()
    assert ids(stages["toxicity"](spark, docs, folder)) == every
    marked = make_docs(toxic_docs(600))
    spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(0, 600)], "doc_id long, toxic int").write.parquet(f"{folder}/more/labels.parquet")
    kept = stages["toxicity"](spark, marked, f"{folder}/more")
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i in range(600) if i % 6}
    for name, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0, name


def test_pipeline_packs_what_is_kept(spark):
    packed = pipeline.run(spark, FOLDER)
    lengths = packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).toPandas()["n"].to_numpy()
    assert (np.log2(lengths) % 1 == 0).all() and packed.select("doc_id").distinct().count() > 100
