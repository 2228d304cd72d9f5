import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from corpusloom.llm import ngram_join
from corpusloom.llm.components import smallest_members
from corpusloom.llm.decontamination import contained_items
from corpusloom.llm.ngram_join import runs_for, similar_documents
from llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs(text, short=True):
    words = WORD.findall(text or "")
    if len(words) < 5:
        return {tuple(words)} if words and short else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_similar(rows):
    sets, parent = [runs(t) for _, t in rows], list(range(len(rows)))
    links = [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and shared >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    least = defaultdict(lambda: None)
    for at, (i, _) in enumerate(rows):
        if i is not None:
            least[find(at)] = i if least[find(at)] is None else min(i, least[find(at)])
    return sorted(((i, least[find(at)] if i is not None or links[at] else None, links[at]) for at, (i, _) in enumerate(rows)), key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def edited(text, changes, seed):
    rng, words = random.Random(seed), text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"edit{rng.random()}"
    return " ".join(words)


def test_similar_like_brute_force(make_docs, odd_rows):
    rows = list(odd_rows)
    for group in range(25):
        text = prose(100 + group, 40 + 10 * group)
        rows += [(1000 + 20 * group + k, edited(text, k, group * 50 + k)) for k in range(6)]
    assert got(similar_documents(make_docs(rows))) == brute_similar(rows)


@pytest.mark.parametrize("leaf", [4, 16])
def test_large_buckets_are_split_and_blocked(make_docs, monkeypatch, leaf):
    monkeypatch.setattr(ngram_join, "LEAF", leaf)
    base, passage = prose(7, 150), prose(8, 40)
    rows = [(k, edited(base, k % 5, k)) for k in range(60)]  # one dense group, most pairs linked
    rows += [(100 + k, passage + " " + prose(900 + k, 30)) for k in range(60)]  # a frequent passage, no pair linked
    rows += [(200 + k, base) for k in range(10)]
    assert got(similar_documents(make_docs(rows))) == brute_similar(rows)


def pairs_at_the_threshold(pairs):
    """Twice ``pairs`` sets of 90 words, 2k and 2k + 1 at 0.8 exactly; other pairs share words that a fifth of all sets hold."""
    rng, pool = random.Random(11), [f"common{n}" for n in range(400)]
    for k in range(pairs):
        core = rng.sample(pool, 80)
        for side in range(2):
            yield 2 * k + side, " ".join(core + [f"own{k}x{side}x{n}" for n in range(10)])


def test_runs_do_not_share_their_splits(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LEAF", 32)
    number, pairs = runs_for(0.8, 0.9999), 4_000
    seeds, rows = ngram_join.seeds_of(number), []
    for at, text in pairs_at_the_threshold(pairs):
        words = ngram_join.shingle_set(text, ngram_join._WordHashes(), 1)
        rows.append((at.to_bytes(4, "big"), ngram_join.min_hashes(words, seeds).tolist()))
    classes = spark.createDataFrame(rows, "key binary, marks array<long>")
    met = defaultdict(set)
    for row in ngram_join._leaves(classes, number).select("key", "leaf").collect():
        met[int.from_bytes(row["key"], "big")].add(row["leaf"])
    missed = sum(not met[2 * k] & met[2 * k + 1] for k in range(pairs))
    assert missed <= 2  # 0.4 expected at most; 6 while runs shared their splits


def test_runs_reach_the_target():
    assert runs_for(0.8, 0.9999) == 6 and runs_for(0.8, 0.9) < runs_for(0.8, 0.99) < runs_for(0.5, 0.99)


def test_no_documents(make_docs):
    assert similar_documents(make_docs([(1, "x")]).limit(0)).count() == 0


def test_intersections_in_slices():
    rng = np.random.default_rng(3)
    left, right = ([np.unique(rng.integers(0, 30_000, 3_000).astype(np.uint64)) for _ in range(5)] for _ in range(2))
    want = [[len(np.intersect1d(a, b)) for b in right] for a in left]
    assert ngram_join._shared_counts(left, right).tolist() == want


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1, i) for i in range(2, 50)]
    edges = spark.createDataFrame(chain + star + [(7, 7), (300, 299), (299, 300)], "u long, v long")
    found = {r["u"]: r["v"] for r in smallest_members(edges).collect()}
    want = {i: 100 for i in range(101, 161)} | {i: 1 for i in range(2, 50)} | {300: 299}
    assert found == want


def brute_leaks(docs, items):
    out = []
    for i, text in docs:
        for item, question in items:
            asked = runs(question, short=False)
            shared = len(asked & runs(text, short=False))
            if asked and shared >= math.ceil(0.8 * len(asked) - 1e-9):
                out.append((i, item, shared, len(asked), shared / len(asked)))
    return sorted(set(out), key=str)


def test_leaks_like_brute_force(spark, make_docs, odd_rows):
    items = [(k, prose(500 + k, 5 + 4 * k)) for k in range(20)] + [(90, None), (91, ""), (92, "one two"), (93, prose(500, 5)), (None, prose(1, 40))]
    docs = list(odd_rows)
    for k in range(20):
        question = prose(500 + k, 5 + 4 * k)
        docs.append((200 + k, prose(k, 400) + "\n" + question + "\n" + prose(k + 50, 900)))
        docs.append((300 + k, prose(k + 70, 50) + " " + edited(question, 1 + k // 8, k) + " " + prose(k + 80, 20)))
        docs.append((400 + k, question.upper()))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = got(contained_items(make_docs(docs), benchmark))
    assert found == brute_leaks(docs, items) and len(found) > 20
    assert got(contained_items(make_docs(docs), benchmark, block_shingles=100)) == found
    assert contained_items(make_docs(docs), benchmark.limit(0)).count() == 0
    assert contained_items(make_docs(docs).limit(0), benchmark).count() == 0


def test_items_without_an_id_and_with_repeated_ids(spark, make_docs):
    items = [(None, prose(601, 40)), (None, prose(602, 40)), (7, prose(603, 40)), (7, prose(604, 40)), (7, prose(604, 40)), (8, prose(605, 40))]
    docs = [(k, prose(k, 100) + " " + prose(601 + k, 40) + " " + prose(k + 50, 100)) for k in range(5)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = got(contained_items(make_docs(docs), benchmark))
    assert found == brute_leaks(docs, items) and [row[:2] for row in found] == [(0, None), (1, None), (2, 7), (3, 7), (4, 8)]
    assert got(contained_items(make_docs(docs), benchmark, block_shingles=40)) == found
