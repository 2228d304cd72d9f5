"""A log-bilinear language model of words, trained with noise-contrastive estimation over all training texts.

Tokens are words, A to Z in lower case, and one end per text. The most frequent
words are classes of their own, the others share classes by their last two bytes;
inside a shared class a word has its smoothed share of the class's counts. The model
gives P(class | two classes before) as a softmax over all classes; the normaliser of
every pair of classes is computed once, by matrix products.

At scale: counts are summed in Spark. Words beyond a bounded head, each of which is
rarer than all words of the head, are joined with their counts. Each task trains on its
share of the texts, and the parameters, whose size is fixed, are averaged.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import folded, slices, stored
from corpusloom.llm.token_ids import utf8
from corpusloom.session import spread

HEAD_WORDS = 200_000  # words of at most 33 bytes that each task holds
CLASSES = 960  # words that are a class each
ENDINGS = 63  # classes that the other words share
DIMENSIONS = 24
ROUNDS = 2
NOISE = 32  # noise words that a batch shares
BATCH = 4096
_BUFFER = 64 * BATCH
_BLOCK = 256  # rows of a matrix product; larger ones would start threads beyond the task's own
_RATE = 0.1
_WORDS_HELD = 500_000
_LONG = 32
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
END = b""  # no word is empty


def words_of_text(text: bytes | None) -> list[bytes]:
    """Words of a text in UTF-8; splits at exactly the six ASCII white-space bytes."""
    return (text or b"").translate(_LOWER).split()


def _key(word: bytes) -> bytes:
    """A word of up to 32 bytes, or 33 bytes that stand for a longer one."""
    return word if len(word) <= _LONG else b"\0" + sha256(word).digest()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, c) of a task's texts, added up as far as memory allows."""

    def told(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(map(_key, counts), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "c"]
        )

    counts = Counter()
    for part in slices(batches):
        for text in utf8(part["text"]):
            counts.update(words_of_text(text))
        counts[END] += part.num_rows
        if len(counts) > _WORDS_HELD:
            yield told(counts)
            counts = Counter()
    yield told(counts)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c): counts of all tokens of a column ``text``, stored; the end's word is empty."""
    made = spread(texts.select("text")).mapInArrow(_counts, "word binary, c bigint")
    return stored(made.groupBy("word").agg(F.sum("c").alias("c")), "word-counts")


def _band(c: str) -> Column:
    """Sixteenths of powers of two: few bands, by which a bounded head is told without a sort."""
    return F.floor(F.log2(F.col(c).cast("double")) * 16).cast("int")


def _ending(word: str | bytes) -> Column | int:
    if isinstance(word, bytes):
        return 1 + zlib.crc32(word[-2:]) % ENDINGS
    last = F.when(F.length(word) > 2, F.substring(word, -2, 2)).otherwise(F.col(word))
    return (1 + F.crc32(last) % ENDINGS).cast("int")


class Vocabulary:
    """Counts as the model needs them: the head in memory, the others in a table, and totals of the classes."""

    def __init__(self, counts: DataFrame, head_words: int = HEAD_WORDS, classes: int = CLASSES):
        words = counts.where(F.length("word") > 0)
        bands = sorted(words.groupBy(_band("c").alias("band")).count().collect(), reverse=True)
        least, held = 1 << 30, 0
        for band, n in bands:
            if held + n > head_words:
                break
            least, held = band, held + n
        self.tail = words.where(_band("c") < least)
        found = words.where(_band("c") >= least).collect()  # at most head_words rows of 33 bytes
        head = sorted(((bytes(r["word"]), r["c"]) for r in found), key=lambda pair: (-pair[1], pair[0]))
        ends = counts.where(F.length("word") == 0).agg(F.sum("c")).first()[0] or 0
        totals = counts.agg(F.sum("c"), F.count("*")).first()
        self.tokens, self.distinct = totals[0] or 0, totals[1]
        own = head[:classes]
        self.index = {END: 0} | {word: at for at, (word, _) in enumerate(head, 1)}
        self.count = np.array([ends] + [c for _, c in head], np.int64)
        first = 1 + ENDINGS
        self.classes = first + len(own)
        self.class_of = np.array([0, *range(first, self.classes), *(_ending(w) for w, _ in head[classes:])], np.int16)
        # Totals of the shared classes: all words by ending, less those with a class of their own.
        sums = words.groupBy(_ending("word").alias("k")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()
        self.class_count, kinds = np.zeros(self.classes, np.int64), np.zeros(self.classes, np.int64)
        for row in sums:
            self.class_count[row["k"]], kinds[row["k"]] = row["c"], row["n"]
        for at, (word, c) in enumerate(own):
            self.class_count[_ending(word)] -= c
            kinds[_ending(word)] -= 1
            self.class_count[first + at] = c
        self.class_count[0] = ends
        # log10 of what a count plus one is divided by inside its class; a class of one word needs none.
        self.share = np.zeros(self.classes)
        self.share[1:first] = np.log10(self.class_count[1:first] + kinds[1:first] + 1)

    def shipped(self) -> tuple:
        return self.index, self.class_of, np.log10(self.count + 1.0), self.share, self.count > 0


def _indexed(texts: list[bytes | None], index: dict) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(place in the head or -1 per token, tokens per text, tokens outside the head in order)."""
    tokens, lengths = [], []
    for text in texts:
        words = words_of_text(text)
        tokens += words
        tokens.append(END)
        lengths.append(len(words) + 1)
    at = np.array(list(map(index.get, tokens, repeat(-1))), np.int32)
    missing = [_key(tokens[i]) for i in np.flatnonzero(at < 0).tolist()]
    long = [i for i, word in zip(np.flatnonzero(at < 0).tolist(), missing) if len(word) > _LONG]
    for i in long:  # a long word may be in the head under its key
        at[i] = index.get(_key(tokens[i]), -1)
    if long:
        missing = [_key(tokens[i]) for i in np.flatnonzero(at < 0).tolist()]
    return at, np.array(lengths), missing


def _classes(at: np.ndarray, missing: list[bytes], class_of: np.ndarray) -> np.ndarray:
    found = class_of[at]
    if missing:
        found[at < 0] = [1 + zlib.crc32(word[-2:]) % ENDINGS for word in missing]
    return found


def _contexts(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class before each token and the one before that; before a text there are ends."""
    one, two = np.zeros_like(classes), np.zeros_like(classes)
    one[1:], two[2:] = classes[:-1], classes[:-2]
    two[one == 0] = 0
    return one, two


class LogBilinear:
    """Parameters: word vectors R (context) and Q (target), a matrix per place of the context, biases."""

    NAMES = ("R", "Q", "C1", "C2", "bias")

    def __init__(self, counts: np.ndarray, dimensions: int = DIMENSIONS):
        rng, k = np.random.default_rng(13), len(counts)
        share = (counts + 1.0) / (counts + 1.0).sum()
        self.noise = share
        self.R = rng.normal(0, 0.1, (k, dimensions)).astype(np.float32)
        self.Q = rng.normal(0, 0.1, (k, dimensions)).astype(np.float32)
        self.C1, self.C2 = (np.eye(dimensions, dtype=np.float32) * w for w in (1.0, 0.5))
        self.bias = np.log(share).astype(np.float32)

    def packed(self) -> bytes:
        return np.concatenate([getattr(self, name).ravel() for name in self.NAMES]).astype(np.float32).tobytes()

    def unpack(self, flat: np.ndarray) -> None:
        at = 0
        for name in self.NAMES:
            shape = getattr(self, name).shape
            size = int(np.prod(shape))
            setattr(self, name, flat[at : at + size].reshape(shape).astype(np.float32))
            at += size

    def start(self, seed: int) -> None:
        self.rng = np.random.default_rng(seed)
        self.limits = np.cumsum(self.noise)
        self.log_noise = np.log(self.noise * NOISE).astype(np.float32)
        self.squares = {name: np.full_like(getattr(self, name), 1e-6) for name in self.NAMES}

    def learn(self, one: np.ndarray, two: np.ndarray, target: np.ndarray) -> None:
        """One step of noise-contrastive estimation; the batch shares its noise words."""
        near, far, q_target = self.R[one], self.R[two], self.Q[target]
        guess = _product(near, self.C1) + _product(far, self.C2)
        drawn = np.minimum(np.searchsorted(self.limits, self.rng.random(NOISE)), len(self.limits) - 1)
        q_noise = self.Q[drawn]
        offset = self.bias - self.log_noise
        true = np.einsum("ij,ij->i", guess, q_target) + offset[target]
        false = _product(guess, q_noise.T) + offset[drawn]
        g_true = -1 / (1 + np.exp(true))  # sigmoid less 1
        g_false = 1 / (1 + np.exp(-false))
        g_guess = g_true[:, None] * q_target + _product(g_false, q_noise)
        steps = {name: np.zeros_like(getattr(self, name)) for name in ("R", "Q", "bias")}
        _add_rows(steps["Q"], target, g_true[:, None] * guess)
        np.add.at(steps["Q"], drawn, _summed(g_false, guess))
        steps["bias"] += np.bincount(target, g_true, len(self.bias)).astype(np.float32)
        np.add.at(steps["bias"], drawn, g_false.sum(0))
        _add_rows(steps["R"], one, _product(g_guess, self.C1.T))
        _add_rows(steps["R"], two, _product(g_guess, self.C2.T))
        steps["C1"], steps["C2"] = _summed(near, g_guess), _summed(far, g_guess)
        for name, step in steps.items():
            step /= len(target)
            self.squares[name] += step * step
            getattr(self, name)[...] -= _RATE * step / np.sqrt(self.squares[name])

    def normalisers(self, two: int) -> np.ndarray:
        """Natural logarithms of the normaliser after (any class, class ``two`` before it)."""
        scores = (self.R @ self.C1 + self.R[two] @ self.C2) @ self.Q.T + self.bias
        top = scores.max(axis=1, keepdims=True)
        return (top + np.log(np.exp(scores - top).sum(axis=1, keepdims=True)))[:, 0]


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b for a long a, block by block."""
    whole = len(a) - len(a) % _BLOCK
    blocks = (a[:whole].reshape(-1, _BLOCK, a.shape[1]) @ b).reshape(whole, b.shape[1])
    return np.concatenate([blocks, a[whole:] @ b]) if whole < len(a) else blocks


def _summed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a.T @ b for long a and b, block by block."""
    whole = len(a) - len(a) % _BLOCK
    blocks = a[:whole].reshape(-1, _BLOCK, a.shape[1]).transpose(0, 2, 1) @ b[:whole].reshape(-1, _BLOCK, b.shape[1])
    return blocks.sum(axis=0) + a[whole:].T @ b[whole:]


def _add_rows(into: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    order = np.argsort(rows, kind="stable")
    sorted_rows = rows[order]
    begins = np.flatnonzero(np.r_[True, sorted_rows[1:] != sorted_rows[:-1]])
    into[sorted_rows[begins]] += np.add.reduceat(values[order], begins, axis=0)


def _average(states: Iterator[tuple[int, bytes]]) -> tuple[int, bytes]:
    """Parameters averaged by the tokens they were learned from."""
    n, total = 0, None
    for tokens, state in states:
        flat = np.frombuffer(state, np.float32).astype(np.float64) * tokens
        n, total = n + tokens, flat if total is None else total + flat
    return n, (total / max(n, 1)).astype(np.float32).tobytes() if n else b""


def train(texts: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> LogBilinear:
    """The model of the class after two classes, over all texts; each round averages what the tasks learned."""
    context = texts.sparkSession.sparkContext
    model = LogBilinear(vocabulary.class_count)
    if not vocabulary.tokens:
        return model
    index = context.broadcast(vocabulary.shipped())  # bounded by the head
    rows = spread(texts.select("text"))
    for turn in range(rounds):
        counts, begun = vocabulary.class_count, np.frombuffer(model.packed(), np.float32)

        def learn(batches, counts=counts, begun=begun, turn=turn):
            places, class_of = index.value[0], index.value[1]
            local, seen, held, waiting = LogBilinear(counts), 0, [], 0
            local.unpack(begun.copy())
            local.start(turn)

            def use(held):
                one, two, target = (np.concatenate(part) for part in zip(*held))
                order = local.rng.permutation(len(target))
                for at in range(0, len(target), BATCH):
                    part = order[at : at + BATCH]
                    local.learn(one[part], two[part], target[part])

            for part in slices(batches):
                at, _, missing = _indexed(utf8(part["text"]), places)
                classes = _classes(at, missing, class_of)
                held.append((*_contexts(classes), classes))
                seen, waiting = seen + len(classes), waiting + len(classes)
                if waiting >= _BUFFER:
                    use(held)
                    held, waiting = [], 0
            if held:
                use(held)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([local.packed()], pa.binary())], names=["n", "state"])

        learned = folded(rows.mapInArrow(learn, "n bigint, state binary"), _average)
        if learned[0]:
            model.unpack(np.frombuffer(learned[1], np.float32))
    index.unpersist()
    return model


def _normaliser_table(spark, model: LogBilinear) -> np.ndarray:
    """log Z of every pair of classes, a row per class two before; its size is fixed by the classes."""
    k, counts, flat = len(model.bias), np.zeros(len(model.bias)), np.frombuffer(model.packed(), np.float32)

    def run(batches):
        local = LogBilinear(counts)
        local.unpack(flat.copy())
        for batch in batches:
            for two in batch["id"].to_pylist():
                made = local.normalisers(two).astype(np.float32).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([two], pa.int64()), pa.array([made], pa.binary())], names=["id", "z"])

    table = np.zeros((k, k), np.float32)
    for row in spark.range(0, k, 1, 24).mapInArrow(run, "id bigint, z binary").collect():
        table[row["id"]] = np.frombuffer(row["z"], np.float32)
    return table


_SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, counts double, model double, words array<binary>, times array<int>"


def score_texts(docs: DataFrame, held_out: Column, head_words: int = HEAD_WORDS, classes: int = CLASSES, rounds: int = ROUNDS) -> DataFrame:
    """Base and model log10 probabilities of every text; the model learns from the rows that are not held out.

    One row per row of ``docs``: (doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score). A missing text is empty, which is one end. Rows that repeat an
    id or a text are each counted and scored; a missing id is as any other. Without
    training texts every count is 0 and the model is that of the empty counts. A text
    of any length is read whole. Columns other than doc_id and text are not read.
    """
    spark, context = docs.sparkSession, docs.sparkSession.sparkContext
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    training = rows.where(~F.col("held_out"))
    vocabulary = Vocabulary(word_counts(training), head_words, classes)
    model = train(training, vocabulary, rounds)
    shipped = context.broadcast(
        (*vocabulary.shipped(), _normaliser_table(spark, model), model.R @ model.C1, model.R @ model.C2, model.Q, model.bias)
    )

    def run(batches):
        places, class_of, log_count, share, known, table, near, far, q, bias = shipped.value
        for part in slices(batches):
            at, lengths, missing = _indexed(utf8(part["text"]), places)
            target = _classes(at, missing, class_of)
            one, two = _contexts(target)
            there = at >= 0
            counts = np.where(there, log_count[at], 0.0)
            natural = np.empty(len(target))
            for begin in range(0, len(target), 1 << 16):
                piece = slice(begin, begin + (1 << 16))
                a, b, t = one[piece], two[piece], target[piece]
                natural[piece] = np.einsum("ij,ij->i", near[a] + far[b], q[t]) + bias[t] - table[b, a]
            # Inside a shared class a word has its share of the counts.
            shared = (target > 0) & (target <= ENDINGS)
            scores = natural / np.log(10) + np.where(shared, counts - share[target], 0.0)
            begins = np.r_[0, np.cumsum(lengths)[:-1]]
            owner = np.repeat(np.arange(len(lengths)), lengths)[~there].tolist()
            tails = [Counter() for _ in lengths]
            for doc, word in zip(owner, missing):
                tails[doc][word] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    part["doc_id"], part["held_out"], pa.array(lengths, pa.int64()),
                    pa.array(np.add.reduceat(there & known[at], begins, dtype=np.int64)),
                    pa.array(np.add.reduceat(counts, begins)), pa.array(np.add.reduceat(scores, begins)),
                    pa.array([list(t) for t in tails], pa.list_(pa.binary())), pa.array([list(t.values()) for t in tails], pa.list_(pa.int32())),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "counts", "model", "words", "times"],
            )

    scored = spread(rows).mapInArrow(run, _SCORED).withColumn("row", F.monotonically_increasing_id())
    scored = stored(scored, "lm-scores")
    # Words outside the head: each is rarer than every word of the head, so no key is hot.
    rare = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", "x.words", "x.times")
    told = rare.join(vocabulary.tail.withColumnRenamed("word", "words"), "words").groupBy("row").agg(
        F.sum("times").alias("_known"), F.sum(F.col("times") * F.log10(F.col("c") + F.lit(1.0))).alias("_counts")
    )
    whole = scored.drop("words", "times").join(told, "row", "left")
    more = F.coalesce("_counts", F.lit(0.0))
    size = float(np.log10(vocabulary.tokens + vocabulary.distinct + 1))
    return whole.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("counts") + more - F.col("n_tokens") * F.lit(size)).alias("base_score"), (F.col("model") + more).alias("score"),
    )
