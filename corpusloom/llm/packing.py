"""Sequence packing by minimum bin slack.

Each task streams its documents through a window of pieces. A sequence takes the
longest piece left and then, by a bitset subset-sum over the multiset of lengths
left, those that fill it closest to capacity; going back through the bitsets gives
the count of each length. If the best sum leaves a gap, one piece is cut to fill
it. What is left at the end of a task goes into sequences of a power of two, so no
sequence is padded. Nothing is shuffled, and a task holds one window of pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import slices, whole_text
from corpusloom.llm.token_ids import WORDS_KEPT, text_ids, utf8, with_end

CAPACITY = 4096
END_ID = 2
WINDOW_TOKENS = 2_000_000
_KEPT_TOKENS = 250_000  # stay in the window, so that the next sequences have a choice of lengths


def closest_multiset(counts: dict[int, int], target: int) -> dict[int, int]:
    """Counts of the lengths whose sum is the largest up to ``target``, within ``counts``."""
    reach, trail, mask = 1, [], (1 << (target + 1)) - 1
    for length in sorted((x for x in counts if 0 < x <= target), reverse=True):
        left, take = min(counts[length], target // length), 1
        while left and not reach >> target & 1:
            take = min(take, left)
            trail.append((length, take, reach))
            reach |= reach << (length * take) & mask
            left, take = left - take, take * 2
        if reach >> target & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(trail):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= length * take
    return chosen


class Window:
    """Pieces (document number, start, ids) by length, and the sequences made of them."""

    def __init__(self, capacity: int):
        self.capacity, self.pieces, self.counts, self.tokens = capacity, {}, {}, 0

    def add(self, piece: tuple[int, int, np.ndarray]) -> None:
        n = len(piece[2])
        self.pieces.setdefault(n, []).append(piece)
        self.counts[n] = self.counts.get(n, 0) + 1
        self.tokens += n

    def take(self, length: int) -> tuple[int, int, np.ndarray]:
        piece = self.pieces[length].pop()
        self.counts[length] -= 1
        if not self.counts[length]:
            del self.counts[length], self.pieces[length]
        self.tokens -= length
        return piece

    def sequence(self, capacity: int) -> list[tuple[int, int, np.ndarray]]:
        """Pieces that fill ``capacity`` exactly; there must be as many tokens."""
        longest = max((n for n in self.counts if n <= capacity), default=0)
        filled = [self.take(longest)] if longest else []
        gap = capacity - longest
        if gap:
            for length, n in closest_multiset(self.counts, gap).items():
                filled.extend(self.take(length) for _ in range(n))
                gap -= length * n
        if gap:
            doc, start, ids = self.take(min(n for n in self.counts if n > gap))
            filled.append((doc, start, ids[:gap]))
            self.add((doc, start + gap, ids[gap:]))
        return filled

    def sequences(self, keep: int) -> Iterator[list[tuple[int, int, np.ndarray]]]:
        while self.tokens >= max(self.capacity, keep):
            yield self.sequence(self.capacity)

    def rest(self) -> Iterator[list[tuple[int, int, np.ndarray]]]:
        """All that is left: full sequences, then one per power of two in the number of tokens left."""
        yield from self.sequences(0)
        while self.tokens:
            yield self.sequence(1 << (self.tokens.bit_length() - 1))


def _packer(tokenizer: str, capacity: int, end_id: int, names: list[str], words_kept: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, window = text_ids(tokenizer, words_kept), Window(capacity)
        number, documents, kind = TaskContext.get().partitionId() << 40, {}, None
        made, held = [[] for _ in names], 0

        def flush() -> pa.RecordBatch:
            nonlocal made, held
            kinds = [kind, *[pa.int64()] * 5, pa.binary()]
            batch = pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(made, kinds)], names)
            made, held = [[] for _ in names], 0
            return batch

        def put(sequence) -> None:
            nonlocal number, held
            offset = 0
            for at, start, ids in sequence:
                entry = documents[at]
                values = (entry[0], start, len(ids), entry[1], number, offset, ids.astype("<u4").tobytes())
                for column, value in zip(made, values):
                    column.append(value)
                offset += len(ids)
                entry[2] -= len(ids)
                if not entry[2]:
                    del documents[at]
            number, held = number + 1, held + offset

        seen = 0
        for batch in slices(batches):
            kind = batch.column(0).type
            ids_of = encoder.batch(utf8(batch.column(1)))
            for doc, ids in zip(batch.column(0).to_pylist(), ids_of):
                ids = with_end(ids, end_id)
                documents[seen] = [doc, len(ids), len(ids)]
                for start in range(0, len(ids), capacity):
                    window.add((seen, start, ids[start : start + capacity]))
                seen += 1
                if window.tokens >= WINDOW_TOKENS:
                    for sequence in window.sequences(_KEPT_TOKENS):
                        put(sequence)
                        if held >= _KEPT_TOKENS:
                            yield flush()
        for sequence in window.rest():
            put(sequence)
            if held >= _KEPT_TOKENS:
                yield flush()
        if held:
            yield flush()

    return pack


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, words_kept: int = WORDS_KEPT
) -> DataFrame:
    """Pieces of (doc_id, text) in sequences: (doc_id, start, length, doc_tokens, sequence_id, offset, ids).

    Every id of a document, its end id included, is in exactly one piece; ``ids`` are
    little-endian unsigned 32-bit. Missing and empty texts are one end id; missing
    ids and repeated rows are documents like others; other columns are ignored; an
    empty table gives no rows. Sequences hold ``capacity`` ids, the last few of a task
    a smaller power of two each (``capacity`` must be one itself). ``words_kept`` trades
    a worker's memory for time and changes no result.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    rows = docs.select("doc_id", whole_text("text").alias("text"))
    names = ["start", "length", "doc_tokens", "sequence_id", "offset"]
    layout = T.StructType(
        [rows.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in names], T.StructField("ids", T.BinaryType())]
    )
    return rows.mapInArrow(_packer(tokenizer, capacity, end_id, layout.names, words_kept), layout)


def packed_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
