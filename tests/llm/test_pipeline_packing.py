import numpy as np
import pyarrow as pa
import pytest
from pyspark.util import PythonEvalType

import corpus_pipeline
from corpusloom.llm.packing import pack_documents
from corpusloom.llm.queries import tokenizer_path
from corpusloom.llm.token_ids import WORDS_KEPT
from corpusloom.llm.toxicity import ToxicityModel
from corpusloom.session import small_batches
from tests.llm.conftest import prose

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
SMALL = "/root/testdata/sf0.001"


def test_packing_in_the_pipeline_keeps_fewer_words_and_packs_the_same(spark, monkeypatch):
    kept = []

    def noting(docs, *args, **named):
        kept.append(named.get("words_kept", WORDS_KEPT))
        return pack_documents(docs, *args, **named)

    monkeypatch.setattr(corpus_pipeline, "pack_documents", noting)
    docs = spark.createDataFrame([(i, prose(i, 40 * i)) for i in range(60)], "doc_id long, text string").coalesce(1)
    ours = corpus_pipeline.pack(spark, docs, "").collect()
    assert kept[0] <= WORDS_KEPT // 4
    assert sorted(ours) == sorted(pack_documents(docs, tokenizer_path()).collect())


@pytest.fixture
def wide_batches(spark):
    """Spark's own batches of 10,000 rows, and again afterwards what the session had."""
    before = spark.conf.get(BATCH)
    spark.conf.set(BATCH, 10_000)
    yield
    spark.conf.set(BATCH, before)


def rows_per_batch(spark, rows):
    def count(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    return [row["n"] for row in spark.range(0, rows, 1, 1).mapInArrow(count, "n long").collect()]


@pytest.mark.parametrize("stage", ["toxicity", "near_copies", "packing"])
def test_stages_give_python_workers_small_batches(spark, wide_batches, stage):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    dict(corpus_pipeline.STAGES)[stage](spark, docs, SMALL)
    assert max(rows_per_batch(spark, 5_000)) <= 1_024


@pytest.mark.parametrize("asked, most", [(0, 1_024), (-1, 1_024), (10_000, 1_024), (100, 100)])
def test_small_batches_lose_no_row_and_keep_smaller_ones(spark, wide_batches, asked, most):
    spark.conf.set(BATCH, asked)
    small_batches(spark)
    seen = rows_per_batch(spark, 5_000)
    assert sum(seen) == 5_000 and max(seen) == most


def test_toxicity_never_makes_a_series_of_a_whole_batch(spark):
    model = ToxicityModel(np.array([5]), np.array([1.0]), 0.0)
    docs = spark.createDataFrame([(prose(1, 50),)], "text string")
    plan = docs.select(model.column("text"))._jdf.queryExecution().executedPlan().toString()
    assert f", {PythonEvalType.SQL_SCALAR_ARROW_ITER_UDF}" in plan.split("ArrowEvalPython", 1)[1]
