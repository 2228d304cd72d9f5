"""Ranked search against every document scored one by one."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from corpusloom.llm.lexical_search import Trie, search_documents, terms_of
from llm.conftest import prose

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [x.translate(LOWER) for x in TERM.findall(text or "")]


def one_by_one(docs, items):
    """(item, rank, doc, score) by the formula, each document against each item."""
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(x for _, c in held for x in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    rows = set()
    for item, wanted in asked.items():
        scored = []
        for doc, counts in held:
            m = 10 + 90 * sum(counts.values()) * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1))) * (10**9 * counts[x] // (1000 * counts[x] + 8 * m)) for x in wanted if counts[x])
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        rows |= {(item, k, None if missing else doc, -score) for k, (score, missing, doc) in enumerate(sorted(scored)[:10], 1)}
    return rows


def found_rows(df):
    return {tuple(row) for row in df.collect()}


def test_terms_are_the_patterns():
    text = "".join(map(chr, range(0x250))) + " Straße İx x y \U0001f600 ΑΣ"
    assert [t.decode() for t in terms_of(text.encode())] == terms(text)


def test_like_one_by_one(spark, make_docs, odd_rows):
    rng = random.Random(8)
    docs = odd_rows + [(100 + k, prose(k % 90, rng.randint(1, 60))) for k in range(700)]
    docs += [(2000 + k, "copy of one text, the same") for k in range(300)]
    items = [(k, prose(k, 25)) for k in range(40)] + [
        (50, None), (51, ""), (52, "copy same"), (53, "nowhere"), (54, prose(200, 5000)), (7, "two"), (7, prose(3, 9)), (None, "one"), (3, prose(3, 25)),
    ]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("own")).repartition(3)
    want = one_by_one(docs, items)
    found = search_documents(make_docs(docs), asked)
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and found_rows(found) == want
    assert found_rows(search_documents(make_docs(docs), asked, block_terms=60)) == want


def test_nothing_to_search(spark, make_docs):
    items = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    docs = make_docs([(1, "one two"), (2, None)])
    assert found_rows(search_documents(docs, items)) == one_by_one([(1, "one two"), (2, None)], [(1, "one two")])
    assert search_documents(docs.limit(0), items).count() == 0
    assert search_documents(docs, items.limit(0)).count() == 0
    assert search_documents(make_docs([(1, "!?"), (2, None)]), items).count() == 0


def test_small_leaves_and_bounds():
    rng = np.random.default_rng(5)
    for leaf in (1, 3, 64):
        lists = [np.sort(rng.choice(30, rng.integers(0, 8), replace=False)) for _ in range(400)]
        lists += [lists[5]] * 50
        starts = np.r_[0, np.cumsum([len(x) for x in lists])].astype(np.int64)
        ranks, m = np.concatenate(lists).astype(np.int64), rng.integers(10, 40, len(lists))
        tf = rng.integers(1, 4, len(ranks))
        trie = Trie(list(range(len(lists))), m, starts, ranks, tf, 30, leaf)
        for node, below in enumerate(trie.children):
            for child in below:
                assert (trie.most[node] >= trie.most[child]).all() and trie.least[node] <= trie.least[child]
        for _ in range(20):
            wanted = rng.choice(30, 6, replace=False)
            weights = rng.integers(0, 900, 6)
            scores = {}
            for doc, (a, b) in enumerate(zip(starts, starts[1:])):
                there = dict(zip(ranks[a:b].tolist(), tf[a:b].tolist()))
                scores[doc] = sum(int(w) * (10**9 * there[t] // (1000 * there[t] + 8 * int(m[doc]))) for t, w in zip(wanted.tolist(), weights) if t in there)
            want = sorted((-s, False, d) for d, s in scores.items() if s > 0)[:10]
            assert trie.search(wanted, weights, [], np.full(30, -1)) == want
