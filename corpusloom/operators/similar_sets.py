"""Greedy removal of similar word sets across many tasks.

Meaning: go through the items of a key in order and keep one unless it is too
similar to a kept one. One task could do this for a small key; this module does the
same for keys of any size.

Equal sets collapse to their first item. Similar sets share words among the first few
of each, rarest first, so items meet only under signatures made of such words. A
signature of many items is refined: first by the sizes of both sets, which says how
many words they must share and so how far into each set the signature may reach, then
by further shared words. What is refined to the number of words that must be shared
holds only sets alike to each other; there the first one settles all others, without
pairs. Long sets have too many signatures for that: in a bucket of them items meet its
earliest undecided ones only, four times as many every round.

What is found is settled by priority: every round, all items that have met all earlier
ones and have no earlier undecided neighbour stay, and their neighbours go.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from hashlib import blake2b
from itertools import combinations
from math import ceil, comb, floor

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.fixed_values import JACCARD_THRESHOLD
from corpusloom.functions.similarity import jaccard
from corpusloom.session import stored

# Up to here two shared words make a first signature, beyond it one (pairs would be many).
_PAIR_SIZE = 40
BUCKET = 64
_THRESHOLD = Fraction(str(JACCARD_THRESHOLD))
# Words are added to a signature only while a set makes at most so many of them.
_COMBINATIONS = 64
OPEN, ALIKE, STUCK = 0, 1, 2
_STORED_EVERY = 3


def words_to_share(a: int, b: int) -> int:
    """Fewest words two sets of these sizes share above the threshold."""
    return floor(_THRESHOLD * (a + b) / (1 + _THRESHOLD)) + 1


def _rarest_first(sets: DataFrame) -> DataFrame:
    """(key, at, ordered) of (key, at, words): words by how many sets of the key hold them, ties by length and name."""
    each = sets.select("key", "at", F.explode("words").alias("word"))
    # Stored before the join, so that Spark can split the rows of a common word.
    held = stored(each.groupBy("key", "word").agg(F.count("*").alias("held")), "held-words")
    ranked = F.array_sort(F.collect_list(F.struct("held", (-F.length("word")).alias("size"), "word")))
    ordered = F.transform(ranked, lambda item: item["word"])
    return each.join(held, ["key", "word"]).groupBy("key", "at").agg(ordered.alias("ordered"))


def _longest_first(sets: DataFrame) -> DataFrame:
    """(key, at, ordered) of (key, at, words): words by length and name, which needs no count."""
    ranked = F.array_sort(F.transform("words", lambda word: F.struct((-F.length(word)).alias("size"), word.alias("word"))))
    return sets.select("key", "at", F.transform(ranked, lambda item: item["word"]).alias("ordered"))


def _first_signatures(ordered: Column) -> Column:
    """Signatures of a word array, each with the place of its last word and the number of its words.

    With at least ``o`` shared words, the first ``size - o + k`` words of both sets
    have ``k`` of them in common.
    """
    size = F.size(ordered)
    least = F.ceil(size * F.lit(JACCARD_THRESHOLD)).cast("int")
    head = F.slice(ordered, 1, size - least + 2)

    def signature(hashed: Column, last: Column, k: int) -> Column:
        return F.struct(hashed.alias("signature"), last.cast("int").alias("last"), F.lit(k).alias("k"))

    pairs = F.flatten(
        F.transform(
            head,
            lambda left, at: F.transform(
                F.slice(head, at + 2, F.size(head)), lambda right, on: signature(F.xxhash64(left, right), at + on + 1, 2)
            ),
        )
    )
    singles = F.transform(F.slice(ordered, 1, size - least + 1), lambda word, at: signature(F.xxhash64(word), at, 1))
    nothing = F.array().cast("array<struct<signature:bigint,last:int,k:int>>")
    return F.concat(
        F.when((size > 1) & (size <= _PAIR_SIZE), pairs).otherwise(nothing),
        F.when(size > _PAIR_SIZE * JACCARD_THRESHOLD, singles).otherwise(nothing),
    )


def _at_once(low: int, high: int, k: int) -> bool:
    """Whether all words that are missing from a signature can be added in one step."""
    must = words_to_share(low, high)
    return comb(high - k, must - k) <= _COMBINATIONS


def _state(low: int, high: int, k: int) -> int:
    """What can be done with a bucket of this signature; it depends on nothing else, so that both sets do the same."""
    must = words_to_share(low, high)
    if k == must:
        return ALIKE
    one_more = comb(high - must + k + 1, k + 1) <= _COMBINATIONS
    return OPEN if one_more or _at_once(low, high, k) else STUCK


def refined(ordered: list[str], signature: bytes, last: int, k: int, low: int | None, high: int | None) -> list[tuple]:
    """(signature, last, k, low, high, state, upper) of the finer signatures of one set.

    ``low`` and ``high`` are the sizes of two sets that may meet, ``upper`` tells a set
    of the larger one; a signature without them is refined by them, others by one word,
    or by all that are missing.
    """
    size = len(ordered)

    def hashed(*parts) -> bytes:
        return blake2b("\0".join(map(str, parts)).encode(), key=signature, digest_size=16).digest()

    if low is None:
        made = []
        for other in range(ceil(_THRESHOLD * size), floor(size / _THRESHOLD) + 1):
            must = words_to_share(size, other)
            if k <= must <= min(size, other) and last < size - must + k:
                a, b = min(size, other), max(size, other)
                made.append((hashed(a, b), last, k, a, b, _state(a, b, k), a < size))
        return made
    must, upper = words_to_share(low, high), low < size
    if _at_once(low, high, k):
        chosen = combinations(range(last + 1, size), must - k)
        return [(hashed(*(ordered[i] for i in each)), each[-1], must, low, high, ALIKE, upper) for each in chosen]
    return [(hashed(ordered[i]), i, k + 1, low, high, _state(low, high, k + 1), upper) for i in range(last + 1, size - must + k + 1)]


_SIGNED = "signature binary, last int, k int, low int, high int, state int, upper boolean"


def _refined_udf() -> Column:
    @F.pandas_udf(f"array<struct<{', '.join(':'.join(field.split()) for field in _SIGNED.split(', '))}>>")
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            rows = zip(*(column.tolist() for column in columns))
            yield pd.Series([
                refined(list(ordered), signature, last, k, *((None, None) if low != low or low is None else (int(low), int(high))))
                for ordered, signature, last, k, low, high in rows
            ])

    return run("ordered", "signature", "last", "k", "low", "high")


def _meetings(sets: DataFrame, bucket: int, refine: bool = True) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """Rows (key, signature, at, upper) of signatures that 2 to ``bucket`` items share, of larger ones alike throughout, and of others.

    Nothing unless ``refine``, if some signature has more items.
    """
    first = sets.select("key", "at", F.explode(_first_signatures(F.col("ordered"))).alias("s")).select("key", "at", "s.*")
    none = F.lit(None).cast("int")
    level = first.withColumns({"low": none, "high": none, "state": F.lit(OPEN), "upper": F.lit(False)})
    found = []
    while True:
        # Stored, so that the rows of a common signature can be split in the joins with it.
        counts = level.groupBy("key", "signature", "k").agg(F.count("*").alias("n"), F.max("state").alias("kind"))
        counts = stored(counts.where(F.col("n") > 1), "signatures")
        known = level.join(counts, ["key", "signature", "k"])
        named = known if found else known.withColumn("signature", F.col("signature").cast("string").cast("binary"))
        found.append(named.select("key", "signature", "at", "upper", F.when(F.col("n") <= bucket, F.lit(-1)).otherwise(F.col("kind")).alias("kind")))
        if counts.where((F.col("n") > bucket) & (F.col("kind") == OPEN)).isEmpty():
            break
        if not refine:
            return None
        many = named.where((F.col("n") > bucket) & (F.col("kind") == OPEN)).join(sets, ["key", "at"])
        finer = many.select("key", "at", F.explode(_refined_udf()).alias("s")).select("key", "at", "s.*")
        level = stored(finer, "finer-signatures")
    if len(found) == 1:  # nothing was refined
        return found[0].drop("kind"), *(found[0].limit(0).drop("kind") for _ in range(2))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    small, alike, stuck = (rows.where(F.col("kind") == kind).drop("kind") for kind in (-1, ALIKE, STUCK))
    return small, stored(alike, "crowds"), stored(stuck, "crowds")


def _stars(crowds: DataFrame) -> DataFrame:
    """(key, at, leader) with the earliest items of each bucket of alike sets.

    Sets of its smaller size are alike to all of the bucket, those of its larger size
    to them alone.
    """
    upper = F.col("upper")
    leads = crowds.groupBy("key", "signature").agg(
        F.min(F.when(~upper, F.col("at"))).alias("_low"), F.min(F.when(upper, F.col("at"))).alias("_high")
    )
    leaders = F.array("_low", F.when(~upper, F.col("_high")))
    met = crowds.join(leads, ["key", "signature"]).select("key", "at", F.explode(leaders).alias("leader"))
    return met.where(F.col("leader") < F.col("at"))


def _close(met: DataFrame, sets: DataFrame) -> DataFrame:
    """(key, at, leader): the pairs of ``met`` that are similar; pairs that meet often are compared once."""
    words = sets.select("key", F.col("at").alias("leader"), F.col("ordered").alias("leader_words"))
    pairs = met.select("key", "at", "leader").distinct().join(sets, ["key", "at"]).join(words, ["key", "leader"])
    return pairs.where(jaccard("ordered", "leader_words") > JACCARD_THRESHOLD).select("key", "at", "leader")


def _edges(sets: DataFrame, small: DataFrame) -> DataFrame:
    """(key, at, leader): similar pairs among items that meet in small buckets, the earlier as leader."""
    other = small.select("key", "signature", F.col("at").alias("leader"))
    return _close(small.join(other, ["key", "signature"]).where(F.col("leader") < F.col("at")), sets)


def _fronts(stuck: DataFrame, sets: DataFrame, leaders: int) -> tuple[DataFrame, DataFrame]:
    """(edges with the first ``leaders`` of each bucket, (key, leader) of items that have not met all before them)."""
    earliest = Window.partitionBy("key", "signature").orderBy("at")
    front = stored(stuck.withColumn("rank", F.row_number().over(earliest)).where(F.col("rank") <= leaders).drop("rank"), "fronts")
    met = stuck.join(front.withColumnRenamed("at", "leader"), ["key", "signature"]).where(F.col("leader") < F.col("at"))
    outside = stuck.join(front, ["key", "signature", "at"], "left_anti").select("key", F.col("at").alias("leader")).distinct()
    return stored(_close(met, sets), "similar-sets"), stored(outside, "uninformed")


def first_distinct(items: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(key, at) of the kept items of (key, at, words), ``at`` being unique and ordered per key."""
    sets = items.select("key", "at", F.array_sort(F.array_distinct("words")).alias("words"))
    sets = stored(sets.groupBy("key", "words").agg(F.min("at").alias("at")), "word-sets")
    # Rare words first needs two shuffles more; it pays only where an order without counts brings many together.
    ranked = _longest_first(sets)
    meetings = _meetings(ranked, bucket, refine=False)
    if meetings is None:
        ranked = stored(_rarest_first(sets), "ranked-words")
        meetings = _meetings(ranked, bucket)
    small, crowds, stuck = meetings
    edges = stored(_edges(ranked, small), "similar-sets")
    gone, rounds, leaders, has_stuck = None, 0, bucket, not stuck.isEmpty()
    while True:
        near = edges.unionByName(_stars(crowds))
        waiting = near.select("key", F.col("at").alias("leader"))
        if has_stuck:
            close, outside = _fronts(stuck, ranked, leaders)
            near, waiting = near.unionByName(close), waiting.unionByName(close.select("key", F.col("at").alias("leader"))).unionByName(outside)
        settled = near.select("key", "leader").distinct().join(waiting.distinct(), ["key", "leader"], "left_anti")
        fallen = stored(near.join(settled, ["key", "leader"], "left_semi").select("key", "at").distinct(), "fallen")
        if fallen.isEmpty() and not (has_stuck and not outside.isEmpty()):
            break
        gone = fallen if gone is None else gone.unionByName(fallen)
        crowds, stuck = (rows.join(fallen, ["key", "at"], "left_anti") for rows in (crowds, stuck))
        edges = edges.join(fallen, ["key", "at"], "left_anti")
        edges = edges.join(fallen.withColumnRenamed("at", "leader"), ["key", "leader"], "left_anti").select("key", "at", "leader")
        rounds, leaders = rounds + 1, leaders * 4
        if rounds % _STORED_EVERY == 0:  # plans do not grow with the rounds
            edges, crowds, stuck = stored(edges, "similar-sets"), stored(crowds, "crowds"), stored(stuck, "crowds")
    kept = sets.select("key", "at")
    return kept if gone is None else kept.join(gone, ["key", "at"], "left_anti")
