import math
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.sentences import dedup_text, merge_summaries
from corpusloom.operators import similar_sets
from corpusloom.operators.similar_sets import OPEN, first_distinct, refined, words_to_share
from corpusloom.session import stored
from tests import brute_force


def test_dedup_matches_brute_force(evaluate):
    rng = random.Random(1)
    texts = []
    for _ in range(150):
        items = brute_force.random_sentences(rng, rng.randint(0, 25), rng.choice([4, 8, 30]))
        texts.append("".join(item + rng.choice([". ", "! ", "?\n", ".. "]) for item in items))
    assert evaluate(texts, dedup_text) == [brute_force.dedup(text) for text in texts]


def test_dedup_is_a_fixed_point(evaluate):
    rng = random.Random(2)
    texts = [". ".join(brute_force.random_sentences(rng, 30, 6)) for _ in range(50)]
    once = evaluate(texts, dedup_text)
    assert evaluate(once, dedup_text) == once


def test_threshold_is_strict(evaluate):
    seven_of_ten = "aaa bbb ccc ddd eee fff ggg hhh. aaa bbb ccc ddd eee fff ggg iii jjj"
    assert evaluate([seven_of_ten], dedup_text) == [seven_of_ten + "."]
    assert evaluate(["The cost is 3.5 million dollars! short. ok", "", None], dedup_text) == [
        "The cost is 3. 5 million dollars.", "", "",
    ]


def test_merge_summaries(evaluate):
    lists = [
        ["One sentence of text here.", "Error: failed to do the thing", "one sentence of text here! Another one follows it"],
        ["Error: the only summary failed"],
        ["Error: the first summary failed", "Error: the second summary failed"],
        [],
        None,
        ["", "A good sentence stands alone."],
    ]
    assert evaluate(lists, merge_summaries, "array<string>") == [
        "One sentence of text here. Another one follows it.",
        "Error: the only summary failed.",
        "",
        "",
        "",
        "A good sentence stands alone.",
    ]


def test_distributed_greedy_matches_brute_force(spark):
    """Many keys, copies and near copies, signatures of more items than a bucket."""
    rng = random.Random(3)
    rows, expected = [], set()
    for key, (count, vocabulary) in {"a": (400, 5), "b": (300, 12), "c": (300, 400), "d": (1, 3)}.items():
        items = brute_force.random_sentences(rng, count, vocabulary)
        if key == "c":
            base = " ".join(f"unique{i}" for i in range(60))
            items += [base + f" tail{i}" for i in range(30)]
            items += [" ".join(f"unique{i}" for i in range(n)) for n in (27, 28, 29, 38, 40, 41, 45, 58)]
        rows += [(key, at, item) for at, item in enumerate(items)]
        kept = []
        for at, item in enumerate(items):
            if not any(brute_force.similar(item, items[other]) for other in kept):
                kept.append(at)
        expected |= {(key, at) for at in kept}
    df = spark.createDataFrame(rows, "key string, at int, text string").repartition(4)
    items = df.select("key", "at", F.split(F.lower("text"), " ").alias("words"))
    for bucket in (2, 64):
        found = {(row["key"], row["at"]) for row in first_distinct(items, bucket).collect()}
        assert found == expected


def _stores(monkeypatch):
    made = []
    monkeypatch.setattr(similar_sets, "stored", lambda df, name: made.append(name) or stored(df, name))
    return made


def test_common_phrases_cost_no_rounds(spark, monkeypatch):
    made, rounds = _stores(monkeypatch), {}
    for n in (100, 1000):
        own = [F.concat(F.lit(f"{k}:"), (F.xxhash64("id", F.lit(k)) % 50_000).cast("string")) for k in range(8)]
        words = F.array(F.lit("internationalisation"), F.lit("acknowledgements"), *own)
        items = spark.range(n).select(F.lit("a").alias("key"), F.col("id").alias("at"), words.alias("words"))
        made.clear()
        assert similar_sets.first_distinct(items).count() == n
        rounds[n] = len(made)
    assert rounds[1000] <= rounds[100] + 4


def _kept(sets):
    """The fold, with kept sets listed by their words."""
    kept = []
    for at, words in enumerate(sets):
        if not any(len(words & sets[other]) / len(words | sets[other]) > 0.7 for other in kept):
            kept.append(at)
    return kept


@pytest.mark.parametrize("kind", ["common words alone", "one template", "alike throughout", "long and alike"])
def test_rounds_do_not_follow_the_number_of_sentences(spark, monkeypatch, kind):
    made, rounds = _stores(monkeypatch), {}
    for n in (200, 1600):
        rng = random.Random(n)
        if kind == "common words alone":
            sets = [frozenset(rng.choices([f"w{i}" for i in range(60)], k=rng.randint(7, 12))) for _ in range(n)]
        elif kind == "one template":  # seven shared words of ten: no two are similar
            sets = [frozenset([f"shared{i}" for i in range(7)] + [f"{i}x{rng.random()}" for i in range(3)]) for _ in range(n)]
        elif kind == "long and alike":
            sets = [frozenset([f"shared{i}" for i in range(50)] + [f"x{k % 300}y{i}" for i in range(k % 17)]) for k in range(n // 4)]
        else:
            sets = [frozenset([f"shared{i}" for i in range(9)] + [f"x{k}"]) for k in range(n)]
        rows = [("a", at, sorted(words)) for at, words in enumerate(sets)]
        items = spark.createDataFrame(rows, "key string, at int, words array<string>")
        made.clear()
        found = sorted(row["at"] for row in similar_sets.first_distinct(items).collect())
        assert found == _kept(sets)
        rounds[n] = len(made)
    assert rounds[1600] <= rounds[200] + 12, rounds


def test_signatures_bring_all_similar_sets_together():
    """Whatever is refined, two sets above the threshold still share a signature."""
    rng = random.Random(9)
    for _ in range(300):
        a = frozenset(rng.sample(range(60), rng.randint(2, 30)))
        b = frozenset(rng.sample(sorted(a), max(1, len(a) - rng.randint(0, 4)))) | frozenset(rng.sample(range(60, 90), rng.randint(0, 3)))
        if len(a & b) / len(a | b) <= 0.7:
            continue
        assert len(a & b) >= words_to_share(len(a), len(b))
        order = sorted(a | b, key=lambda word: (word * 7919) % 97)
        ordered = [[str(word) for word in order if word in each] for each in (a, b)]
        level = []
        for words in ordered:
            head = len(words) - math.ceil(0.7 * len(words)) + 2
            level.append([(f"{words[i]},{words[j]}".encode(), j, 2, None, None, OPEN) for i in range(head) for j in range(i + 1, min(head, len(words)))])
        while True:
            shared = {row[0] for row in level[0]} & {row[0] for row in level[1]}
            assert shared
            states = {row[5] for rows in level for row in rows if row[0] in shared}
            if OPEN not in states:
                break
            level = [[made for row in rows if row[5] == OPEN for made in refined(words, *row[:5])] + [row for row in rows if row[5]] for words, rows in zip(ordered, level)]
