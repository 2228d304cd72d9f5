"""Counts against plain Python, normalised probabilities, better than single words on held-out texts."""

import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm.common import in_fold
from corpusloom.llm.lm_scoring import ENDINGS, LogBilinear, Vocabulary, score_texts, word_counts
from llm.conftest import prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [None]


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def base_rows(rows):
    counts = Counter(t for i, text in rows if not held_out(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    made = []
    for i, text in rows:
        each = [counts[t] for t in tokens(text)]
        made.append((i, held_out(i), len(each), sum(c > 0 for c in each), n, round(sum(log10((c + 1) / (n + v + 1)) for c in each), 5)))
    return sorted(made, key=str)


@pytest.mark.parametrize("head_words", [0, 40, 200_000])
def test_base_like_plain_python(make_docs, odd_rows, head_words):
    rows = odd_rows + [(12, "w" * 5000 + " x Wİ " + "w" * 5000), (13, "W" * 5000)] + [(100 + k, prose(k, 40) + " BETWEEN") for k in range(60)]
    found = score_texts(make_docs(rows), in_fold("doc_id", 7, 2), head_words, classes=20, rounds=1)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    ours = found.toPandas().astype(object)
    got = [
        (None if i != i or i is None else int(i), bool(h), int(t), int(k), int(n), round(b, 5))
        for i, h, t, k, n, b in ours[["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]].itertuples(index=False)
    ]
    assert sorted(got, key=str) == base_rows(rows)
    assert (ours["score"] < 0).all() and np.isfinite(ours["score"].astype(float)).all()


def test_nothing_to_learn_from(make_docs):
    docs = make_docs([(1, "a b"), (2, None)])
    assert score_texts(docs.limit(0), in_fold("doc_id", 7, 2)).count() == 0
    rows = score_texts(docs, F.lit(True)).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert all(np.isfinite(r["score"]) for r in rows)


def test_probabilities_add_up_to_one(make_docs):
    """Over all known words and one that is unknown per ending, after any two words."""
    rows = [(k, prose(k, 30)) for k in range(80)]
    docs = make_docs(rows)
    vocabulary = Vocabulary(word_counts(docs), 50, 10)
    counts = Counter(t for _, text in rows for t in tokens(text))
    total, ranked = 0.0, sorted((w for w in counts if w), key=lambda w: (-counts[w], w.encode()))
    single = set(ranked[:10])
    unknown, ending = {}, lambda w: 1 + zlib.crc32(w.encode()[-2:]) % ENDINGS
    for a in range(4000):
        word = f"q{a:03x}"
        if word not in counts:
            unknown.setdefault(ending(word), word)
    assert len(unknown) == ENDINGS
    words = [None, *ranked, *unknown.values()]
    texts = [" ".join(ranked[:2] + ([w] if w else [])) for w in words]
    all_docs = docs.unionByName(make_docs([(1000 + k, t) for k, t in enumerate(texts)]))
    found = {r["doc_id"]: r["score"] for r in score_texts(all_docs, F.col("doc_id") >= 1000, 50, 10, 1).collect()}
    model_only = LogBilinear(vocabulary.class_count)
    assert model_only.R.shape[0] == vocabulary.classes == 1 + ENDINGS + 10 and single
    # Each text also has an end after its last word, whose chance differs; single steps are compared through the table.
    table = np.exp(np.array([model_only.normalisers(two) for two in range(3)]))
    for two in range(3):
        for one in range(5):
            scores = np.exp((model_only.R[one] @ model_only.C1 + model_only.R[two] @ model_only.C2) @ model_only.Q.T + model_only.bias)
            assert abs(scores.sum() / table[two, one] - 1) < 1e-4
    # Inside a shared class, known words and one unknown word share all of its chance.
    for k in range(1, ENDINGS + 1):
        inside = [counts[w] + 1 for w in ranked if w not in single and ending(w) == k]
        total = sum(inside) + 1
        assert abs(10 ** vocabulary.share[k] - total) < 1e-6 * total
    assert len(found) == 80 + len(texts)


def test_better_than_single_words_on_held_out_texts(make_docs):
    rows = []
    for k in range(400):
        letters = [f"{'abcdefgh'[(k + j * 3) % 8]}{'xyz'[j % 3]}" for j in range(120)]
        rows.append((k, " ".join(letters)))
    found = score_texts(make_docs(rows), in_fold("doc_id", 7, 2)).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert found[0] > 0.8 * found[1]
