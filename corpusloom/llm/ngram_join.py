"""N-gram Jaccard self-join by chosen paths.

Texts with equal sets of word shingles are one class. A run picks one shared
shingle per set by MinHash, so that sets with similarity s meet with probability
s; the runs repeat until the chance to miss a pair at the threshold is below one
minus the target recall. Buckets that are too large are split again, and again,
on four further sampled shingles each, drawn for that run and level alone, unless
their sets are so alike that a split would not part them. Leaves are brute-forced in blocks: pairs of blocks are
tasks, each pair of sets is counted in the first leaf its sets share, and a leaf
whose members all share an earlier one is left out. Tasks give back sums and a
forest, never pairs, so rows grow with the sets and not with pairs of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import slices, small_side, whole_text, worker_state
from corpusloom.llm.components import smallest_members
from corpusloom.session import cut_lineage

WIDTH = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.9999
LEAF = 256
CHILDREN = 4
LEVELS = 2
_WORDS_KEPT = 250_000
_SLICE_TOKENS = 200_000
_BROADCAST_ROWS = 300_000
_BROADCAST_SETS = 100_000


class _WordHashes(dict):
    """Hash of a word, kept per worker; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORDS_KEPT:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text: str | None, hashes: dict, width: int = WIDTH) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of ``width`` words; a shorter text with words is one run, none without."""
    words = (text or "").encode().split()  # at exactly the six ASCII white-space bytes
    if not words:
        return np.zeros(0, np.uint64)
    one = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    span = min(width, len(words))
    runs = one[: len(words) - span + 1] + np.uint64(span)
    for at in range(1, span):
        runs = (runs ^ (runs >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25) + one[at : len(words) - span + 1 + at]
    runs = (runs ^ (runs >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(runs ^ (runs >> np.uint64(32)))


def min_hashes(runs: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    out = np.empty(len(seeds), np.uint64)
    for at, seed in enumerate(seeds):
        mixed = (runs ^ seed) * np.uint64(0x94D049BB133111EB)
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xD6E8FEB86659FD93)
        out[at] = (mixed ^ (mixed >> np.uint64(32))).min()
    return out.view(np.int64)


def _seeds(n: int) -> np.ndarray:
    return np.random.default_rng(20).integers(1, 2**63, n, dtype=np.uint64)


def runs_for(threshold: float, recall: float) -> int:
    """Runs after which a pair at the threshold has met with at least the asked probability, splits included."""
    meets = threshold * (1 - (1 - threshold) ** CHILDREN) ** LEVELS
    return max(1, ceil(log(1 - recall) / log(1 - meets)))


def seeds_of(runs: int) -> np.ndarray:
    """One seed per run, then each run's own CHILDREN per level: runs that shared them would miss the same pairs."""
    return _seeds(runs * (1 + LEVELS * CHILDREN))


def _signer(width: int, seeds: np.ndarray):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = worker_state("word_hashes", _WordHashes)
        for batch in slices(batches):
            keys, marks = [], []
            for text in batch.column(3).to_pylist():
                runs = shingle_set(text, hashes, width)
                keys.append(xxhash.xxh128_digest(runs.tobytes()) if len(runs) else None)
                marks.append(min_hashes(runs, seeds) if len(runs) else None)
            columns = [*batch.columns[:3], pa.array(keys, pa.binary()), pa.array(marks, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "t1", "t2", "key", "marks"])

    return sign


def _shingler(width: int):
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = worker_state("word_hashes", _WordHashes)
        for batch in slices(batches):
            at = batch.schema.names.index("_text")
            sets = [shingle_set(text, hashes, width).tobytes() for text in batch.column(at).to_pylist()]
            names = [name for name in batch.schema.names if name != "_text"]
            columns = [batch.column(batch.schema.names.index(name)) for name in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sets, pa.binary())], [*names, "runs"])

    return shingle


def _leaves(classes: DataFrame, runs: int) -> DataFrame:
    """(key, order, leaf, n): the leaves of each class, in order of their paths; buckets of one class are gone."""
    own = LEVELS * CHILDREN
    starts = F.transform(
        F.sequence(F.lit(0), F.lit(runs - 1)),
        lambda r: F.struct(
            (r * 100).alias("order"), F.xxhash64(r, F.get("marks", r)).alias("bucket"),
            F.slice("marks", r * own + (runs + 1), F.lit(own)).alias("marks"),
        ),
    )
    rows = classes.select("key", F.explode(starts).alias("b")).select("key", "b.marks", "b.order", "b.bucket")
    done = None
    for level in range(LEVELS + 1):
        # Stored before the join, so that Spark can split the rows of a large bucket over tasks.
        sizes = cut_lineage(rows.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > 1))
        rows = cut_lineage(rows.join(sizes, "bucket"))
        large = rows.where(F.col("n") > LEAF)
        if level == LEVELS or large.isEmpty():
            return rows_of(rows, done)
        first, unit = level * CHILDREN, 10 ** (1 - level)
        paths = F.transform(
            F.sequence(F.lit(0), F.lit(CHILDREN - 1)),
            lambda c: F.struct(
                (F.col("order") + (c + 1) * F.lit(unit)).alias("order"),
                F.xxhash64("bucket", c, F.get("marks", c + first)).alias("bucket"),
            ),
        )
        below = large.select("key", "marks", F.col("bucket").alias("parent"), "n", F.explode(paths).alias("b"))
        below = below.select("key", "marks", "parent", "n", "b.order", "b.bucket")
        # Chance that two members go the same way; splitting pays if all ways together make fewer meetings.
        counted = below.groupBy("parent", "n", "bucket").agg(F.count("*").alias("m"))
        alike = F.sum(F.col("m").cast("double") * F.col("m")) / (F.first("n").cast("double") * F.first("n"))
        split = cut_lineage(counted.groupBy("parent").agg(alike.alias("alike")).where(F.col("alike") < 1).select("parent"))
        kept = rows.join(split.withColumnRenamed("parent", "bucket"), "bucket", "left_anti")
        done = rows_of(kept, done)
        rows = below.join(split, "parent", "left_semi").select("key", "marks", "order", "bucket")
    return done


def rows_of(rows: DataFrame, done: DataFrame | None) -> DataFrame:
    found = rows.select("key", "order", F.col("bucket").alias("leaf"), "n")
    return found if done is None else done.unionByName(found)


def _needed(leaves: DataFrame) -> DataFrame:
    """(key, met, todo): all leaves of a class, and those where some pair has not met before."""
    met = leaves.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("order", "leaf", "n"))).alias("met"))
    each = met.select("key", "met", F.explode("met").alias("at"))
    earlier = F.explode(F.filter("met", lambda m: m["order"] < F.col("at.order")))
    shared = each.select(F.col("at.leaf").alias("leaf"), F.col("at.n").alias("n"), earlier.alias("e"))
    known = shared.groupBy("leaf", "n", "e.leaf").agg(F.count("*").alias("members")).where(F.col("members") == F.col("n"))
    known = known.toDF("leaf", "n", "earlier", "members").select("leaf").distinct()
    known = small_side(cut_lineage(known), _BROADCAST_ROWS)
    left = each.select("key", "met", "at", F.col("at.leaf").alias("leaf")).join(known, "leaf", "left_anti")
    return left.groupBy("key").agg(F.first("met").alias("met"), F.collect_list("at").alias("todo"))


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set on the left with every one on the right.

    The sets are sorted, so equal ranges of hashes are cut out of all of them in turn
    and memory stays bounded whatever their sizes.
    """
    sets = left + right
    out = np.zeros((len(left), len(right)), np.float32)
    parts = 1 << max(0, (sum(map(len, sets)) // _SLICE_TOKENS).bit_length())
    edges = [np.uint64(k * (2**64 // parts)) for k in range(1, parts)]
    cuts = [np.concatenate(([0], np.searchsorted(one, edges), [len(one)])) for one in sets]
    for part in range(parts):
        cut = [one[c[part] : c[part + 1]] for one, c in zip(sets, cuts)]
        owner = np.repeat(np.arange(len(sets)), [len(one) for one in cut])
        _, column, times = np.unique(np.concatenate(cut), return_inverse=True, return_counts=True)
        keep = times[column] > 1
        number = np.cumsum(times > 1) - 1
        column, owner = number[column[keep]], owner[keep]
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        width = 4096
        for begin in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            a, b = np.searchsorted(column, (begin, begin + width))
            block = np.zeros((len(sets), width), np.float32)
            block[owner[a:b], column[a:b] - begin] = 1
            out += block[: len(left)] @ block[len(left) :].T
    return np.rint(out).astype(np.int64)


def _met_before(left: list, right: list, order: int) -> np.ndarray:
    """Which pairs share an earlier leaf."""
    met = np.zeros((len(left), len(right)), bool)
    orders = sorted({m["order"] for rows in (left, right) for row in rows for m in row["met"] if m["order"] < order})
    for one in orders:
        a, b = ([next((m["leaf"] for m in row["met"] if m["order"] == one), None) for row in rows] for rows in (left, right))
        names = {leaf: i for i, leaf in enumerate({*a, *b} - {None})}
        at, bt = (np.array([names.get(leaf, -1) for leaf in side]) for side in (a, b))
        met |= (at[:, None] == bt[None, :]) & (at >= 0)[:, None]
    return met


def _verifier(threshold: float):
    names = ["key", "links", "root"]

    def verify(group: pa.Table) -> pa.Table:
        # The sets stay in the Arrow buffers.
        buffers = [one.as_buffer() for one in group.column("runs")]
        rows = {(row["side"], row["key"]): row | {"runs": b} for row, b in zip(group.drop_columns("runs").to_pylist(), buffers)}
        rows = [rows[at] for at in sorted(rows)]
        same = rows[0]["i"] == rows[0]["j"]
        left = [row for row in rows if row["side"] == rows[0]["i"]]
        right = left if same else [row for row in rows if row["side"] == rows[0]["j"]]
        if not left or not right or (same and len(left) < 2):
            return pa.table({n: pa.array([], k) for n, k in zip(names, (pa.binary(), pa.int64(), pa.binary()))})
        sets = [[np.frombuffer(row["runs"], np.uint64) for row in side] for side in (left, right)]
        sizes = [np.array([len(s) for s in side]) for side in sets]
        a, b = sizes[0][:, None], sizes[1][None, :]
        possible = (np.minimum(a, b) >= threshold * np.maximum(a, b) - 1e-9) & ~_met_before(left, right, rows[0]["order"])
        if same:
            possible &= np.triu(np.ones_like(possible), 1)
        if possible.sum() <= 32:
            shared = np.zeros(possible.shape, np.int64)
            for x, y in np.argwhere(possible):
                shared[x, y] = len(np.intersect1d(sets[0][x], sets[1][y], assume_unique=True))
        else:
            shared = _shared_counts(*sets)
        linked = possible & (shared >= threshold * (a + b - shared) - 1e-9)
        weights = [np.array([row["weight"] for row in side]) for side in (left, right)]
        keys = [row["key"] for row in left] + ([] if same else [row["key"] for row in right])
        x, y = np.nonzero(linked)
        links = np.zeros(len(keys), np.int64)
        shift = 0 if same else len(left)
        np.add.at(links, x, weights[1][y])
        np.add.at(links, y + shift, weights[0][x])
        # Keys are sorted within a side, so compare them by rank.
        rank = np.empty(len(keys), np.int64)
        rank[sorted(range(len(keys)), key=keys.__getitem__)] = np.arange(len(keys))
        root, y = rank.copy(), y + shift
        while len(x):
            least = np.minimum(root[x], root[y])
            if (root[x] == least).all() and (root[y] == least).all():
                break
            np.minimum.at(root, x, least)
            np.minimum.at(root, y, least)
        by_rank = sorted(keys)
        hit = np.flatnonzero(links)
        return pa.table(
            {
                "key": pa.array([keys[i] for i in hit], pa.binary()), "links": pa.array(links[hit]),
                "root": pa.array([by_rank[root[i]] for i in hit], pa.binary()),
            }
        )

    return verify


def similar_documents(
    docs: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, recall: float = TARGET_RECALL
) -> DataFrame:
    """(doc_id, class_id, n_links), one row per row of (doc_id, text).

    ``n_links`` is the number of other rows whose shingle set has at least the
    threshold's Jaccard similarity, equal sets included; ``class_id`` the smallest id
    in the row's connected component. A text without words (missing, empty) is linked to nothing
    and its own class; a text of fewer than ``width`` words is one shingle. Rows without an
    id are compared like others (and have no say in ``class_id``); repeated rows are
    copies; other columns are ignored; an empty table gives no rows.
    """
    runs = runs_for(threshold, recall)
    seeds = seeds_of(runs)
    text = whole_text("text")
    rows = docs.select("doc_id", F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(3), text).alias("t2"), text.alias("_text"))
    id_field = rows.schema["doc_id"]
    signed = T.StructType(
        [id_field, T.StructField("t1", T.LongType()), T.StructField("t2", T.LongType()),
         T.StructField("key", T.BinaryType()), T.StructField("marks", T.ArrayType(T.LongType()))]
    )
    marked = cut_lineage(rows.mapInArrow(_signer(width, seeds), signed))
    classes = marked.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("weight"), F.first("marks").alias("marks"),
        F.min(F.struct("doc_id", "t1", "t2")).alias("one"),
    )
    classes = cut_lineage(classes)

    needed = _needed(cut_lineage(_leaves(classes, runs)))
    needed = cut_lineage(needed.join(classes.select("key", "weight", "one"), "key"))
    needed = needed.select(F.col("one.doc_id").alias("_id"), F.col("one.t1").alias("_t1"), F.col("one.t2").alias("_t2"),
                           "key", "weight", "met", "todo")
    needed_side = small_side(needed, _BROADCAST_SETS)
    same_row = rows["doc_id"].eqNullSafe(F.col("_id")) & (F.col("t1") == F.col("_t1")) & (F.col("t2") == F.col("_t2"))
    wanted = rows.join(needed_side, same_row).select("key", "weight", "met", "todo", "_text")
    with_runs = T.StructType([*wanted.drop("_text").schema.fields, T.StructField("runs", T.BinaryType())])
    sets = wanted.mapInArrow(_shingler(width), with_runs)

    at = sets.select("key", "weight", "met", "runs", F.explode("todo").alias("at"))
    blocks = F.ceil(F.col("at.n") / F.lit(LEAF)).cast("int")
    at = at.select(
        "key", "weight", "met", "runs", F.col("at.leaf").alias("leaf"), F.col("at.order").alias("order"),
        F.pmod(F.xxhash64("key", "at.leaf"), blocks).cast("int").alias("side"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"),
    )
    at = at.withColumns({"i": F.least("side", "other"), "j": F.greatest("side", "other")}).drop("other")
    found = at.groupBy("leaf", "i", "j").applyInArrow(_verifier(threshold), "key binary, links long, root binary")
    found = cut_lineage(found)

    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    members = smallest_members(found.select(F.col("key").alias("u"), F.col("root").alias("v")))
    linked = links.join(members.select(F.col("u").alias("key"), F.col("v").alias("root")), "key", "left")
    touched = classes.join(linked, "key", "left").where((F.col("weight") > 1) | F.col("links").isNotNull())
    touched = touched.select("key", F.coalesce("root", "key").alias("root"), "first_id",
                             (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    touched = cut_lineage(touched)
    smallest = touched.groupBy("root").agg(F.min("first_id").alias("class_id"))
    answer = cut_lineage(touched.join(smallest, "root").select("key", "class_id", "n_links"))
    told = marked.select("doc_id", "key").join(small_side(answer, _BROADCAST_ROWS), "key", "left")
    return told.select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    )
