import numpy as np
from pyspark.sql import functions as F

from corpusloom.llm.common import bounded_sample, in_fold, one_label
from corpusloom.llm.toxicity import fit_logistic, gram_buckets, learn_toxicity, score_toxicity
from llm.conftest import prose


def toxic_docs(n=800):
    rows = []
    for i in range(n):
        words = prose(i, 100).split()
        if i % 6 == 0:
            words.insert(i % 100, ["grumblot", "zonkwit", "fizzlork"][i % 3])
        rows.append((i, " ".join(words)))
    return rows


def test_held_out_accuracy(spark, make_docs):
    docs = make_docs(toxic_docs())
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(800)], "doc_id long, toxic int")
    model = learn_toxicity(docs, one_label(labels, "toxic", ~in_fold("doc_id", 4, 2)))
    scored = score_toxicity(docs, model).join(labels, "doc_id").withColumn("held", in_fold("doc_id", 4, 2)).where("held")
    assert scored.count() > 150 and scored.where("predicted <> toxic").count() <= 3


def test_odd_rows_and_empty_tables(spark, make_docs, odd_rows):
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, label int")
    docs = make_docs(odd_rows)
    for learn in (labels, labels.limit(0), labels.where("label = 1")):
        scored = score_toxicity(docs, learn_toxicity(docs, learn))
        assert scored.count() == len(odd_rows) and scored.where("score is null or score not between 0 and 1").count() == 0
    assert score_toxicity(docs.limit(0), learn_toxicity(docs.limit(0), labels)).count() == 0
    empty = score_toxicity(docs, learn_toxicity(docs, labels)).where("doc_id in (4, 5, 6)").select("score").distinct()
    assert empty.count() == 1


def test_grams_cover_the_whole_text_and_every_code_point():
    assert len(gram_buckets("")) == 0 and len(gram_buckets(None)) == 0
    long = "x" * 200_000 + "grumblot"
    assert set(gram_buckets("grumblot")[1:4]) <= set(gram_buckets(long))
    assert len(gram_buckets("aé😀b")) == 3 + 2 + 1


def test_logistic_separates():
    rows = [np.array([0]), np.array([1]), np.array([0, 1]), np.array([], int)] * 50
    weights, intercept = fit_logistic(rows, np.array([1.0, -1.0]), np.array([1.0, 0, 1, 0] * 50), steps=500)
    assert weights[0] > 0 and intercept + weights[0] > 0 > intercept


def test_sample_is_bounded_and_stable(spark):
    rows = spark.range(50_000).withColumnRenamed("id", "doc_id")
    picked = bounded_sample(rows, 5_000)
    assert 4_500 < picked.count() < 6_000 and picked.exceptAll(bounded_sample(rows.repartition(7), 5_000)).isEmpty()
    assert bounded_sample(rows, 50_000).count() == 50_000
    assert rows.where(F.expr("true") & in_fold(F.lit(None), 4, 0)).isEmpty()


def test_an_id_of_many_rows_teaches_once(spark, make_docs):
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(300)], "doc_id long, label int")
    rows = toxic_docs(300)
    once, often = (learn_toxicity(make_docs(r), labels) for r in (rows, rows + [rows[6]] * 900 + [(6, "zz " * 50)] * 300))
    assert once.buckets.tolist() == often.buckets.tolist() and once.intercept == often.intercept
