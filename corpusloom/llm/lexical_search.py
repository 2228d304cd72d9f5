"""Ranked lexical search: the ten best documents of each item, through document FP-trees.

A document is restricted to the terms that items ask for, in order of falling document
frequency, so that documents share paths of a trie. Each node knows the largest count
of every term and the smallest length measure below it. These bound the scores of its
documents from above; per item a depth-first walk takes the most promising child first
and leaves out subtrees whose bound is below the tenth score found so far.

At scale: texts are read once per block of items, and the restricted documents stored.
Each task builds tries over bounded chunks of its own documents, no document moves, and
a task tells ten rows per item at most. Items come in blocks of bounded size.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import slices, stored
from corpusloom.llm.token_ids import utf8
from corpusloom.session import spread

TOP = 10
BLOCK_TERMS = 200_000  # about so many (item, term) pairs are searched for in one pass
CHUNK = 10_000  # documents of a trie
LEAF = 64  # documents of a leaf, more where a trie's tables would outgrow _CELLS
_CELLS = 1 << 24
_ALONE = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
# A to Z become a to z, bytes of no term a space.
_TERMS = bytes(b if b in _ALONE else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of all that is not ASCII, A to Z in lower case."""
    return (text or b"").translate(_TERMS).split()


def _item_terms(batches):
    for part in slices(batches):
        found = [list(dict.fromkeys(terms_of(text))) for text in utf8(part["text"])]
        yield pa.RecordBatch.from_arrays([part["item_id"], pa.array(found, pa.list_(pa.binary()))], names=["item_id", "terms"])


def _blocks(items: DataFrame, block_terms: int):
    """Lists of (item_id, terms) that together hold all items, by hash of the id; each is collected alone."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    found = rows.mapInArrow(_item_terms, "item_id bigint, terms array<binary>").select("item_id", F.explode("terms").alias("term"))
    pairs = stored(found.distinct(), "item-terms")
    blocks = -(-pairs.count() // block_terms)
    for block in range(blocks):
        chosen = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        terms = {}
        for row in chosen.collect():
            terms.setdefault(row["item_id"], []).append(bytes(row["term"]))
        if terms:
            yield [(item, sorted(words)) for item, words in terms.items()]


def _restricted(docs: DataFrame, index: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, times) of all documents with a term: those asked for, as numbers, and how often each is there."""
    shipped = docs.sparkSession.sparkContext.broadcast(index)  # bounded by the block

    def run(batches):
        get = shipped.value.get
        for part in slices(batches):
            lengths, terms, times = [], [], []
            for text in utf8(part["text"]):
                words = terms_of(text)
                counts = Counter(map(get, words))
                counts.pop(None, None)
                lengths.append(len(words))
                terms.append(list(counts))
                times.append(list(counts.values()))
            made = [part["doc_id"], pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(made, names=["doc_id", "n", "terms", "times"])

    rows = spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return rows.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, times array<int>").where("n > 0")


def _gains(weights, tf, m):
    """The integer score of each term; grows with tf and falls with m."""
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Trie:
    """Documents of a chunk in order of their term paths, and the nodes over them.

    Of documents alike in all terms, counts and length only the ten with the smallest
    ids are held, as no other can be among ten best.
    """

    def __init__(self, ids: list, m: np.ndarray, starts: np.ndarray, ranks: np.ndarray, tf: np.ndarray, width: int, leaf: int = LEAF):
        lengths = np.diff(starts)
        order = np.lexsort((ranks, np.repeat(np.arange(len(ids)), lengths)))
        ranks, tf = ranks[order], tf[order]
        paths, counts = ranks.astype(">u4").tobytes(), tf.astype(">u4").tobytes()
        places = (4 * starts).tolist()
        keys = [(paths[a:b], counts[a:b], size) for a, b, size in zip(places, places[1:], m.tolist())]
        chosen, alike, before = [], 0, None
        for i in sorted(range(len(ids)), key=lambda i: (keys[i], ids[i] is None, ids[i] or 0)):
            alike = alike + 1 if keys[i] == before else 0
            before = keys[i]
            if alike < TOP and lengths[i]:
                chosen.append(i)
        self.ids, self.paths = [ids[i] for i in chosen], [keys[i][0] for i in chosen]
        chosen = np.array(chosen, np.int64)
        lengths = lengths[chosen]
        self.m, self.starts = m[chosen], np.r_[0, np.cumsum(lengths)]
        taken = np.repeat(starts[:-1][chosen] - self.starts[:-1], lengths) + np.arange(self.starts[-1])
        self.ranks, self.tf, self.owner = ranks[taken], tf[taken], np.repeat(np.arange(len(chosen)), lengths)
        self.leaf, self.width = max(leaf, -(-4 * len(chosen) * width // _CELLS)), width
        self.spans, self.children, self.most, self.least = [], [], [], []
        if len(chosen):
            self._grow()
            self.most, self.least = np.array(self.most), np.array(self.least)

    def _split(self, lo: int, hi: int) -> list[tuple[int, int]]:
        """Ranges of the children of a range: one per next term after the shared path, small ones side by side put together."""
        first, last = self.paths[lo], self.paths[hi - 1]
        depth = next((d for d in range(0, len(first), 4) if first[d : d + 4] != last[d : d + 4]), len(first)) // 4
        begins, ends = self.starts[lo:hi], self.starts[lo + 1 : hi + 1]
        there = begins + depth < ends
        following = np.where(there, self.ranks[np.minimum(begins + depth, len(self.ranks) - 1)], -1)
        cuts = [lo, *(np.flatnonzero(following[1:] != following[:-1]) + lo + 1).tolist(), hi]
        if len(cuts) == 2:  # one path throughout: only counts and lengths differ
            cuts = [*range(lo, hi, self.leaf), hi]
        made, begin = [], lo
        for a, b in zip(cuts, cuts[1:]):
            if b - a >= self.leaf and begin < a:
                made.append((begin, a))
                begin = a
            if b - begin >= self.leaf or b == hi:
                made.append((begin, b))
                begin = b
        return made

    def _grow(self) -> None:
        """Nodes in depth-first order, so that children have larger numbers than their parent."""
        waiting = [(0, len(self.ids), -1)]
        while waiting:
            lo, hi, parent = waiting.pop()
            node = len(self.spans)
            self.spans.append((lo, hi))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            parts = self._split(lo, hi) if hi - lo > self.leaf else []
            waiting += [(a, b, node) for a, b in parts if len(parts) > 1]
        self.most = [None] * len(self.spans)
        self.least = [0] * len(self.spans)
        for node in reversed(range(len(self.spans))):
            lo, hi = self.spans[node]
            self.least[node] = int(self.m[lo:hi].min())
            below = self.children[node] = np.array(self.children[node], np.int64)
            if len(below):
                self.most[node] = np.maximum.reduce([self.most[c] for c in below.tolist()])
            else:
                top = np.zeros(self.width, np.int32)
                a, b = self.starts[lo], self.starts[hi]
                np.maximum.at(top, self.ranks[a:b], self.tf[a:b].astype(np.int32))
                self.most[node] = top

    def _bounds(self, nodes: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return _gains(weights, self.most[nodes[:, None], terms].astype(np.int64), self.least[nodes][:, None]).sum(axis=1)

    def _leaf_scores(self, node: int, place: np.ndarray, weights: np.ndarray) -> tuple[int, np.ndarray]:
        lo, hi = self.spans[node]
        a, b = self.starts[lo], self.starts[hi]
        at = place[self.ranks[a:b]]
        hit = np.flatnonzero(at >= 0) + a
        scores = np.zeros(hi - lo, np.int64)
        owner = self.owner[hit]
        np.add.at(scores, owner - lo, _gains(weights[at[hit - a]], self.tf[hit], self.m[owner]))
        return lo, scores

    def search(self, terms: np.ndarray, weights: np.ndarray, best: list, place: np.ndarray) -> list:
        """``best`` with this trie's documents: at most ten (-score, id is missing, id), sorted."""
        if not self.ids:
            return best
        place[terms] = np.arange(len(terms))
        waiting = [(0, int(self._bounds(np.array([0]), terms, weights)[0]))]
        while waiting:
            node, bound = waiting.pop()
            floor = -best[-1][0] if len(best) == TOP else 1
            if bound < floor:
                continue
            below = self.children[node]
            if len(below):
                bounds = self._bounds(below, terms, weights)
                for i in np.argsort(bounds, kind="stable").tolist():
                    if bounds[i] >= floor:
                        waiting.append((int(below[i]), int(bounds[i])))
                continue
            lo, scores = self._leaf_scores(node, place, weights)
            for i in np.flatnonzero(scores >= floor).tolist():
                doc = self.ids[lo + i]
                best.append((-int(scores[i]), doc is None, doc or 0))
            best.sort()
            del best[TOP:]
        place[terms] = -1
        return best


def _searched(vectors: DataFrame, block: list, rank: np.ndarray, weight: np.ndarray, index: dict, documents: int, words: int) -> DataFrame:
    """(item_id, doc_id, score): each task's ten best documents of each item of the block."""
    items = [(item, np.array([index[term] for term in terms])) for item, terms in block]
    shipped = vectors.sparkSession.sparkContext.broadcast((items, rank, weight))

    def run(batches):
        items, rank, weight = shipped.value
        asked = [(item, rank[numbers], weight[numbers]) for item, numbers in items]
        best, place = [[] for _ in asked], np.full(len(rank), -1, np.int64)
        for part in slices(batches, CHUNK):
            lists, m = part["terms"], 10 + (90 * part["n"].to_numpy() * documents) // words
            starts = lists.offsets.to_numpy().astype(np.int64)
            ranks = rank[lists.values.to_numpy()[starts[0] : starts[-1]]]
            times = part["times"]
            tf = times.values.to_numpy()[times.offsets[0].as_py() : times.offsets[-1].as_py()].astype(np.int64)
            trie = Trie(part["doc_id"].to_pylist(), m, starts - starts[0], ranks, tf, len(rank))
            best = [trie.search(terms, weights, found, place) for (_, terms, weights), found in zip(asked, best)]
        rows = [(item, None if missing else doc, -score) for (item, _, _), found in zip(asked, best) for score, missing, doc in found]
        columns = list(zip(*rows)) if rows else [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item_id", "doc_id", "score"])

    return vectors.mapInArrow(run, "item_id bigint, doc_id bigint, score bigint")


def search_documents(docs: DataFrame, items: DataFrame, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ten best documents of each item with a score above 0.

    Rows of ``items`` that share an id are one item with the terms of all of them; rows
    without an id are one such item. Missing and empty texts have no terms. Every row
    of ``docs`` is a document, also one that repeats an id or a text; equal scores go by
    ascending id, missing ids last. Whole texts count, of any length. Other columns are
    not read. Without items, or documents with terms, there are no rows.
    """
    spark = docs.sparkSession
    found = spark.createDataFrame([], "item_id bigint, doc_id bigint, score bigint")
    for block in _blocks(items, block_terms):
        index = {term: at for at, term in enumerate(sorted({term for _, terms in block for term in terms}))}
        vectors = stored(_restricted(docs, index), "term-vectors")
        documents, words = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not documents:
            break
        df = np.zeros(len(index), np.int64)
        for row in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[row["term"]] = row["count"]
        rank = np.empty(len(index), np.int64)
        rank[np.lexsort((np.arange(len(df)), -df))] = np.arange(len(df))
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
        found = found.unionByName(_searched(vectors, block, rank, weight, index, documents, words))
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    return ranked.select("item_id", "rank", "doc_id", "score")
