"""Token ids as a table of compressed blocks.

Each document's ids are one zstandard frame of their own, made with a dictionary
that all frames share; short documents, whose frames would otherwise hardly
shrink, gain most. A row of the table is a block of frames of consecutive
documents: ids of the documents, end of each frame, number of tokens of each, the
hash of the dictionary, and the frames end to end. One document is read from one
row and one slice; counts and places are read without touching frames. Spark
writes and commits the rows, so any store it can write to will do, and a lost
executor costs a retried task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import slices, small_side, whole_text
from corpusloom.llm.token_ids import text_ids, utf8, with_end

END_ID = 1
DICTIONARY_BYTES = 64 * 1024
SAMPLE_DOCUMENTS = 2_000  # the dictionary is trained on about so many documents ...
SAMPLE_CHARS = 20_000  # ... of at most so many characters, 40 MB of text at most
BLOCK_BYTES = 1 << 20
LEVEL = 3
WORDS_KEPT = 800_000
_BROADCAST_BLOCKS = 500_000


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> bytes:
    """A zstandard dictionary from the serialized ids of a random sample of all short documents; few give raw content.

    The sample is bounded and decides how small the frames get, nothing else.
    """
    share = SAMPLE_DOCUMENTS / max(docs.count(), SAMPLE_DOCUMENTS)
    chosen = docs.where((F.length("text") <= SAMPLE_CHARS) & (F.rand(5) < share)).select("text")
    short = chosen.limit(2 * SAMPLE_DOCUMENTS).collect()  # a bound the sample does not come near
    encoded = text_ids(tokenizer).batch([row["text"].encode() for row in short])
    samples = [with_end(ids, end_id).tobytes() for ids in encoded]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few or too short samples to find common strings
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    if not data:
        return None
    made = zstandard.ZstdCompressionDict(data)
    made.precompute_compress(level=LEVEL)  # else every frame would digest it anew
    return made


def _frames(tokenizer: str, dictionary: bytes, end_id: int):
    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_ids(tokenizer, WORDS_KEPT)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary))
        for batch in slices(batches):
            counts, frames = [], []
            for ids in encoder.batch(utf8(batch.column(1))):
                ids = with_end(ids, end_id)
                counts.append(len(ids))
                frames.append(packer.compress(ids.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(frames, pa.binary())], ["doc_id", "n_tokens", "frame"]
            )

    return compress


def _blocks(digest: str, width: int):
    """Frames of sorted documents to blocks; the shard is the task's place in the order."""
    names = ["shard", "block", "dictionary", "id_bytes", "doc_ids", "ends", "counts", "frames"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block = TaskContext.get().partitionId(), 0
        docs, ends, counts, frames, size = [], [], [], [], 0

        def row() -> pa.RecordBatch:
            values = [[shard], [block], [digest], [width], [docs], [ends], [counts], [b"".join(frames)]]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.list_(kind), pa.list_(pa.int64()),
                     pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)

        kind = pa.int64()
        for batch in slices(batches):
            kind = batch.column(0).type
            for doc, count, frame in zip(*(batch.column(i).to_pylist() for i in range(3))):
                docs.append(doc)
                counts.append(count)
                frames.append(frame)
                size += len(frame)
                ends.append(size)
                if size >= BLOCK_BYTES:
                    yield row()
                    block, docs, ends, counts, frames, size = block + 1, [], [], [], [], 0
        if docs:
            yield row()

    return pack


def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID) -> str:
    """Write ids of (doc_id, text) in ascending order of doc_id under ``folder``; returns the folder.

    Missing texts are empty (one end id); missing ids come first; rows with one id
    stay each a document; other columns are ignored; an empty table writes no block.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", whole_text("text").alias("text"))
    kind = rows.schema["doc_id"].dataType
    dictionary = train_dictionary(rows, tokenizer, end_id)
    digest = hashlib.sha256(dictionary).hexdigest()
    width = text_ids(tokenizer).dtype.itemsize
    framed = T.StructType([rows.schema["doc_id"], T.StructField("n_tokens", T.LongType()), T.StructField("frame", T.BinaryType())])
    # Encoded once and stored: the range sort below looks at its input twice.
    made = rows.mapInArrow(_frames(tokenizer, dictionary, end_id), framed).withColumn("row", F.monotonically_increasing_id())
    made.write.option("compression", "none").parquet(f"{folder}/frames")
    frames = spark.read.schema(made.schema).parquet(f"{folder}/frames")
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The row's number deals out rows that share an id, or have none, whatever they hold.
    order = ["doc_id", "n_tokens", "row"]
    ordered = frames.repartitionByRange(shards, *order).sortWithinPartitions(*order).drop("row")
    layout = T.StructType(
        [
            T.StructField("shard", T.IntegerType()), T.StructField("block", T.IntegerType()),
            T.StructField("dictionary", T.StringType()), T.StructField("id_bytes", T.IntegerType()),
            T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("ends", T.ArrayType(T.LongType())),
            T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("frames", T.BinaryType()),
        ]
    )
    ordered.mapInArrow(_blocks(digest, width), layout).write.option("compression", "none").parquet(f"{folder}/blocks")
    stored = spark.createDataFrame([(digest, bytearray(dictionary))], "dictionary string, bytes binary")
    stored.coalesce(1).write.parquet(f"{folder}/dictionary")
    return folder


def _shared_dictionary(spark: SparkSession, folder: str) -> tuple[str, bytes]:
    row = spark.read.parquet(f"{folder}/dictionary").collect()[0]
    data = bytes(row["bytes"])
    if hashlib.sha256(data).hexdigest() != row["dictionary"]:
        raise ValueError(f"the dictionary under {folder} does not have the hash it is stored with")
    return row["dictionary"], data


def _decoded(digest: str, dictionary: bytes):
    """The ids of each document of a block, as numpy arrays."""

    def each(row: dict) -> Iterator[tuple[object, np.ndarray]]:
        if row["dictionary"] != digest:
            raise ValueError(f"block {row['shard']}/{row['block']} was written with another dictionary")
        reader = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
        begin = 0
        for doc, end, count in zip(row["doc_ids"], row["ends"], row["counts"]):
            ids = np.frombuffer(reader.decompress(row["frames"][begin:end]), f"<u{row['id_bytes']}")
            if len(ids) != count:
                raise ValueError(f"document {doc} has {len(ids)} ids, its index says {count}")
            yield doc, ids
            begin = end

    return each


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ids as little-endian unsigned 32-bit bytes, start counts all ids before."""
    digest, dictionary = _shared_dictionary(spark, folder)
    blocks = spark.read.parquet(f"{folder}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType
    layout = T.StructType(
        [
            T.StructField("doc_id", kind), T.StructField("shard", T.IntegerType()), T.StructField("block", T.IntegerType()),
            T.StructField("within", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
        ]
    )
    each = _decoded(digest, dictionary)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            doc_kind = batch.schema.field("doc_ids").type.value_type
            for row in batch.to_pylist():
                docs, within, counts, ids, at = [], [], [], [], 0
                for doc, one in each(row):
                    docs.append(doc)
                    within.append(at)
                    counts.append(len(one))
                    ids.append(one.astype("<u4").tobytes())
                    at += len(one)
                n = len(docs)
                values = [docs, [row["shard"]] * n, [row["block"]] * n, within, counts, ids]
                kinds = [doc_kind, pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], layout.names)

    totals = blocks.select("shard", "block", F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b).alias("total"))
    shard_totals = totals.groupBy("shard").agg(F.sum("total").alias("total"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard, not per document.
    shards = shard_totals.select(
        "shard", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before_shard")
    )
    in_shard = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    places = totals.select("shard", "block", F.coalesce(F.sum("total").over(in_shard), F.lit(0)).alias("before_block"))
    places = places.join(shards, "shard")
    start = (F.col("before_shard") + F.col("before_block") + F.col("within")).cast("long")
    documents = blocks.mapInArrow(decode, layout)
    documents = documents.join(small_side(places, _BROADCAST_BLOCKS), ["shard", "block"])
    return documents.select("doc_id", start.alias("start"), "n_tokens", "ids")


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[np.ndarray]:
    """Ids of the documents with this id: the index finds the rows, only their frames are decompressed."""
    digest, dictionary = _shared_dictionary(spark, folder)
    place = F.transform("doc_ids", lambda d: d == doc_id)
    rows = spark.read.parquet(f"{folder}/blocks").where(F.array_contains("doc_ids", doc_id))
    numbered = rows.select("*", F.posexplode(place).alias("at", "hit")).where("hit")
    begin = F.when(F.col("at") == 0, F.lit(0)).otherwise(F.get("ends", F.col("at") - 1)).cast("int")
    length = (F.get("ends", "at") - begin).cast("int")
    one = numbered.select("dictionary", "id_bytes", F.substring("frames", begin + 1, length).alias("frame"))
    reader = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
    found = one.collect()
    if any(row["dictionary"] != digest for row in found):
        raise ValueError("a block was written with another dictionary")
    return [np.frombuffer(reader.decompress(bytes(row["frame"])), f"<u{row['id_bytes']}") for row in found]
