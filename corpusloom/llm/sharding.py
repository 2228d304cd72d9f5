"""Shards balanced in bytes, tokens and rows at once: vector bin packing of groups of equal texts.

Groups are far too many to place one by one, so light ones are gathered into a
fixed number of cells by hash; only groups heavier than a fixed share of the
corpus stand alone, and there can be no more of them than that share allows. The
driver therefore packs a bounded number of vectors at any data size: heaviest
first, each into the shard whose residual capacity has the largest dot product
with it. A group heavier than a quarter of a shard is split by its row ids.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import WORD, whole_text
from corpusloom.session import cut_lineage

CELLS = 8192
_ALONE = 64  # a group over 1 / (shards * this) of any total stands alone
_SPLIT = 16  # a group over 1 / (shards * this) of any total is split
_BLOCK_ROWS = 2_000
MEASURES = ["size", "tokens", "one"]


def pack_vectors(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each row of ``vectors``, by the dot product with the residual capacity; deterministic."""
    totals = np.maximum(vectors.sum(axis=0), 1e-12)
    shares = vectors / totals * shards
    residual = np.ones((shards, vectors.shape[1]))
    place = np.zeros(len(vectors), dtype=np.int32)
    for at in np.lexsort((np.arange(len(vectors)), -shares.sum(axis=1))):
        shard = int(np.argmax(residual @ shares[at]))
        place[at] = shard
        residual[shard] -= shares[at]
    return place


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """(doc_id, size, tokens, text_crc32, shard, slot), one row per input row; law: near-equal bytes.

    ``size`` is the UTF-8 bytes of the text plus 1, ``tokens`` its words. Equal texts
    share a shard unless their group is split. A missing text counts as empty, rows
    without an id are placed like others, repeated rows each get a slot, other columns
    are ignored, and an empty table gives no rows. Slots are gapless from 0 per shard.
    """
    text = whole_text("text")
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.regexp_count(text, F.lit(f"{WORD}+")).cast("long").alias("tokens"), F.lit(1).cast("long").alias("one"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text.cast("binary")).alias("key"),
        F.monotonically_increasing_id().alias("lot"),
    )
    rows = cut_lineage(rows)
    totals = rows.agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in MEASURES]).collect()[0]

    groups = rows.groupBy("key").agg(*[F.sum(m).alias(m) for m in MEASURES])
    share = F.greatest(*[F.col(m) / F.lit(max(totals[m], 1)) for m in MEASURES]) * shards
    heavy = groups.where(share * _ALONE > 1).select("key", F.ceil(share * _SPLIT).cast("int").alias("parts"))
    # By lot, as rows of a group may share an id or have none.
    salted = F.concat_ws("/", "key", F.pmod(F.xxhash64("lot"), F.col("parts")).cast("string"))
    cell = F.when(F.col("parts").isNull(), F.pmod(F.xxhash64("key"), F.lit(CELLS)).cast("string")).otherwise(salted)
    # At most 3 * shards * _ALONE keys are heavy, so both broadcasts are bounded.
    placed = rows.join(F.broadcast(heavy), "key", "left").withColumn("cell", cell)
    cells = placed.groupBy("cell").agg(*[F.sum(m).alias(m) for m in MEASURES]).orderBy("cell").collect()
    vectors = np.array([[float(c[m]) for m in MEASURES] for c in cells]).reshape(len(cells), len(MEASURES))
    place = pack_vectors(vectors, shards)
    where = docs.sparkSession.createDataFrame(
        [(c["cell"], int(p)) for c, p in zip(cells, place)], "cell string, shard int"
    )
    placed = placed.join(F.broadcast(where), "cell")

    # Slots: numbers inside blocks of a shard, plus the rows of the blocks before.
    blocks = max(16, totals["one"] // (shards * _BLOCK_ROWS))
    placed = placed.select("doc_id", "size", "tokens", "text_crc32", "shard", F.pmod(F.xxhash64("doc_id", "text_crc32", F.rand(3)), F.lit(blocks)).alias("block"))
    placed = cut_lineage(placed)
    counts = placed.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "block").orderBy("doc_id")) - 1
    numbered = placed.withColumn("inside", inside).join(offsets, ["shard", "block"])
    return numbered.select(
        "doc_id", "size", "tokens", "text_crc32", "shard", (F.col("before") + F.col("inside")).cast("long").alias("slot")
    )
