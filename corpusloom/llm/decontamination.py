"""Benchmark decontamination: short test items inside long documents.

A document's own MinHash says little about a passage of forty words in it (the
Jaccard similarity falls with the document's length), so containment is searched
from the item's side. Items are partitioned by size, in powers of two, and each
partition has a length of sketch: the bottom hashes of an item's shingles, one
more than an item of that partition may miss. A document that contains the item
to the asked share then holds at least one hash of its sketch, whatever its own
length, and is verified by exact containment of the word shingles themselves.
"""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.once import let
from corpusloom.llm.common import small_side, whole_text, words_of
from corpusloom.session import cut_lineage

WIDTH = 5
THRESHOLD = 0.8
# Item shingles per block: what is broadcast stays below some 64 MB; more items make more blocks.
BLOCK_SHINGLES = 500_000
_BROADCAST_ROWS = 500_000


def shingles_of(text: Column, width: int = WIDTH) -> Column:
    """Distinct runs of ``width`` words; a text with fewer words has none."""

    def runs(words: Column) -> Column:
        n = F.size(words) - (width - 1)
        each = F.transform(words, lambda word, at: F.concat_ws(" ", *[F.get(words, at + i) for i in range(width)]))
        return F.when(n < 1, F.array().cast("array<string>")).otherwise(F.array_distinct(F.slice(each, F.lit(1), n)))

    return let(words_of(whole_text(text)), runs)


def _hashed_shingles(text: Column, width: int) -> Column:
    """Hashes of the runs, from the words without building the runs' texts; equal runs, equal hashes."""

    def runs(words: Column) -> Column:
        n = F.greatest(F.size(words) - (width - 1), F.lit(0))
        each = F.transform(words, lambda word, at: F.xxhash64(*[F.get(words, at + i) for i in range(width)]))
        return F.array_distinct(F.slice(each, F.lit(1), n))

    return let(words_of(whole_text(text)), runs)


def _sketches(items: DataFrame, width: int, threshold: float) -> DataFrame:
    """(item_id, _item, size, least, shingles, sketch) of items that have a shingle."""
    made = items.select(
        "item_id", "_item", shingles_of(F.col("_text"), width).alias("shingles"),
        _hashed_shingles(F.col("_text"), width).alias("hashes"),
    )
    made = made.withColumn("size", F.size("shingles")).where(F.col("size") > 0)
    largest_of_partition = F.pow(F.lit(2), F.floor(F.log2("size")) + 1) - 1
    length = F.floor(largest_of_partition * F.lit(1 - threshold) + F.lit(1e-9)).cast("int") + 1
    least = F.ceil(F.col("size") * F.lit(threshold) - F.lit(1e-9)).cast("int")
    return made.select(
        "item_id", "_item", "size", least.alias("least"), "shingles", F.slice(F.sort_array("hashes"), F.lit(1), length).alias("sketch")
    )


def _search(keyed: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """Verified rows of one block of items."""
    probes = items.select("_item", "least", F.explode("sketch").alias("h"))
    held = keyed.select("_k1", "_k2", _hashed_shingles(F.col("_text"), width).alias("hashes"))
    held = held.select("_k1", "_k2", F.size("hashes").alias("n"), F.explode("hashes").alias("h"))
    met = held.join(F.broadcast(probes), "h").where(F.col("n") >= F.col("least"))
    candidates = cut_lineage(met.select("_k1", "_k2", "_item").distinct())

    wanted = cut_lineage(candidates.select("_k1", "_k2").distinct())
    texts = keyed.join(small_side(wanted, _BROADCAST_ROWS), ["_k1", "_k2"], "left_semi")
    parts = texts.select("doc_id", "_k1", "_k2", F.explode(shingles_of(F.col("_text"), width)).alias("shingle"))
    known = items.select("item_id", "_item", "size", "least", F.explode("shingles").alias("shingle"))
    # Repeated rows have equal keys and equal shingles: each shingle counts once per key.
    found = parts.join(F.broadcast(known), "shingle")
    shared = found.groupBy("doc_id", "_k1", "_k2", "item_id", "_item", "size", "least").agg(F.count_distinct("shingle").alias("shared"))
    verified = shared.where(F.col("shared") >= F.col("least"))
    return verified.join(candidates, ["_k1", "_k2", "_item"], "left_semi")


def contained_items(
    docs: DataFrame, items: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, block_shingles: int = BLOCK_SHINGLES
) -> DataFrame:
    """(doc_id, item_id, shared, size, containment): items whose shingles a document holds to at least ``threshold``.

    ``docs`` is (doc_id, text), ``items`` (item_id, text); other columns are ignored.
    Missing texts are empty; a text of fewer than ``width`` words has no shingle, so it
    neither contains nor is contained. A row without an id is searched like any other.
    Equal (doc_id, text) rows give one result, and so do equal (item_id, text) items;
    other texts under the same id, or without one, are items of their own, each with
    its own result. No hits or empty tables give no rows.
    """
    text = whole_text("text")
    keyed = docs.select(
        "doc_id", text.alias("_text"),
        F.xxhash64(F.col("doc_id"), text, F.lit(1)).alias("_k1"), F.xxhash64(F.lit(2), text, F.col("doc_id")).alias("_k2"),
    )
    each_item = items.select("item_id", text.alias("_text")).distinct()
    inner = F.sha2(F.concat_ws(" ", F.coalesce(F.col("item_id").cast("string"), F.lit("-")), "_text"), 256)
    sketched = cut_lineage(_sketches(each_item.withColumn("_item", inner), width, threshold))
    total = sketched.agg(F.sum("size")).collect()[0][0] or 0
    blocks = max(1, ceil(total / block_shingles))
    place = F.pmod(F.xxhash64("_item", F.lit(5)), F.lit(blocks))
    each = [_search(keyed, sketched.where(place == block) if blocks > 1 else sketched, width) for block in range(blocks)]
    found = reduce(DataFrame.unionByName, each)
    return found.select(
        "doc_id", "item_id", F.col("shared").cast("long"), F.col("size").cast("long"),
        (F.col("shared") / F.col("size")).alias("containment"),
    )
