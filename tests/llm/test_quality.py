import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusloom.llm.common import one_label
from corpusloom.llm.quality_gam import fit_gam, score_quality
from corpusloom.llm.quality_rules import learn_rules, quality_rules
from corpusloom.llm.text_stats import COUNTS
from llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 0)], "doc_id long, quality int").withColumn("label", F.lit("x"))


def labelled(spark, make_docs, n=600):
    rows = [(i, prose(i, 60 + i % 50) if i % 5 else " ".join(w + "##" for w in prose(i, 70).split())) for i in range(n)]
    return make_docs(rows), spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(n)], "doc_id long, quality int")


def test_counts_match_brute_force(spark, make_docs, odd_rows, labels):
    loops = [(20, "a b c a b c d\nx y\nx y\n\nq"), (21, "a a a a a"), (22, "a b c\n" * 30), (23, "a b"), (24, "x\ry\vz\fw # <>")]
    rows = odd_rows + loops
    judged, _ = quality_rules(make_docs(rows), labels)
    got = sorted(tuple(r) for r in judged.select(F.coalesce("doc_id", F.lit(-1)), *COUNTS, "base_failed").collect())
    want = []
    for i, text in rows:
        c = counts(text)
        want.append((-1 if i is None else i, *c, c[0] < 50 or 100 * c[4] > 50 * c[0]))
    assert got == sorted(want)


def test_rules_find_the_planted_mark(spark, make_docs):
    docs, labels = labelled(spark, make_docs)
    judged, rules = quality_rules(docs, labels)
    wrong = judged.join(labels, "doc_id").where((F.col("rule") == 0) != (F.col("quality") == 1)).count()
    assert wrong == 0 and len(rules.rules) == 1 and "symbols >=" in str(rules)


def test_rules_in_order_with_conjunctions(spark):
    rng = np.random.default_rng(1)
    x, y = rng.random(4000), rng.random(4000)
    bad = ((x > 0.7) & (y < 0.3)) | (x < 0.1)
    rows = spark.createDataFrame(pd.DataFrame({"doc_id": range(4000), "x": x, "y": y, "label": (~bad).astype(int)}))
    rules = learn_rules(rows, ["x", "y"])
    wrong = rows.where((rules.rule_number() == 0) != (F.col("label") == 1)).count()
    assert len(rules.rules) >= 2 and any(len(r) > 1 for r in rules.rules) and wrong < 80


def test_no_labels_and_no_rows(spark, make_docs, odd_rows, labels):
    docs = make_docs(odd_rows)
    judged, rules = quality_rules(docs, labels.limit(0))
    assert not rules.rules and judged.where("kept = base_failed").count() == 0 and judged.count() == len(odd_rows)
    assert quality_rules(docs.limit(0), labels)[0].count() == 0
    scored, _ = score_quality(docs, one_label(labels, "quality", F.lit(True)).limit(0))
    assert scored.count() == len(odd_rows) and scored.where("score not between 0 and 1 or score is null").count() == 0
    assert score_quality(docs.limit(0), one_label(labels, "quality", F.lit(True)))[0].count() == 0


def test_one_label_takes_the_larger(labels):
    assert [tuple(r) for r in one_label(labels, "quality", F.lit(True)).collect()] == [(2, 1)]


def test_gam_held_out(spark, make_docs):
    docs, labels = labelled(spark, make_docs)
    learn = labels.where("doc_id % 3 <> 1").withColumnRenamed("quality", "label")
    scored, _ = score_quality(docs, learn)
    held = scored.join(labels, "doc_id").where("doc_id % 3 = 1")
    assert held.where("predicted <> quality").count() == 0 and held.count() == 200


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(2)
    values = pd.DataFrame(rng.random((4000, 3)), columns=["a", "b", "c"])
    labels = ((values["a"] > 0.5) ^ (values["b"] > 0.5)).astype(int)
    model = fit_gam(values[:3000], labels[:3000])
    right = (model.probability(values[3000:]) > 0.5) == labels[3000:]
    assert (0, 1) in model.pairs and right.mean() > 0.9
