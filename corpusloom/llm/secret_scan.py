"""Secret scan: fixed patterns, and sliding-window entropy over candidate strings.

Everything is a Spark expression within one row. A pattern's matches and the
pieces between them, laid end to end, are the text, so lengths give positions.
Entropy: a window slides over each long run of token characters; one count goes
up and one goes down per step, and the sum of c * log2(c) follows in whole
micro-bits, so the result does not depend on the order of additions.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.once import let
from corpusloom.llm.common import whole_text

# Kind, pattern, group whose length counts, least length.
PATTERNS = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
]
KINDS = [kind for kind, *_ in PATTERNS] + ["entropy"]

WINDOW = 24
CANDIDATE = r"[A-Za-z0-9+/_=-]{24,}"
# Pieces of a candidate that are judged by their own characters, and what a narrower pattern before has told already.
RUNS = [
    (r"[0-9a-f]{24,}", None),
    (r"[0-9A-F]{24,}", None),
    (r"[A-Z0-9]{24,}", r"^[0-9A-F]+$"),
    (CANDIDATE, r"^([0-9a-f]+|[A-Z0-9]+)$"),
]
# Character classes in order: (pattern of a whole piece, least bits per character; None: never a secret).
CLASSES = [
    (r"^[0-9]+$", None),
    (r"^[A-Za-z+/_=-]+$", None),
    (r"^([0-9a-f]+|[0-9A-F]+)$", 3.0),
    (r"^[A-Z0-9=]+$", 3.7),
    (r"^[A-Za-z0-9+/_=-]+$", 4.0),
]
# Whole candidates that look random and are not secret.
ALLOWED = [
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    r"^sha(256|384|512)-",
]
# Strings that stand in for a secret, and their length: only windows that overlap them are let off.
ALLOWED_INSIDE = [
    *[(f"(?i:{word})", len(word)) for word in "example placeholder changeme dummy sample abcdefghij".split()],
    (r"(.)\1{7}", 8),
    ("0123456789", 10),
]
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MARK = "[SECRET]"

_PART = 64
_BLOCK = 4096
_STARTS = 1024
# A window's counts, at most 24 each, lie in twelve places of five bits per number.
_BITS, _COUNTS = 5, 12


def _micro_bits(count: int) -> int:
    return round(count * log2(count) * 1e6) if count else 0


def _running(values: Column, combine, zero: int) -> Column:
    """For each whole number what those before it make together.

    A fold copies what it holds in each step, so lists grow in parts of a fixed size only.
    """

    def scan(part: Column, first: Column) -> Column:
        begin = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
        step = lambda state, v: F.struct(
            combine(state["at"], v).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out")
        )
        return F.aggregate(part, begin, step, lambda state: state["out"])

    def over(parts: Column) -> Column:
        totals = F.transform(parts, lambda part: F.aggregate(part, F.lit(zero), combine))
        return F.flatten(F.zip_with(parts, scan(totals, F.lit(zero)), scan))

    def cut(all_values: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor(F.greatest(F.size(all_values) - 1, F.lit(0)) / _PART).cast("int"))
        return let(F.transform(numbers, lambda k: F.slice(all_values, k * _PART + 1, F.lit(_PART))), over)

    return let(values, cut)


def _placed(text: Column, pattern: str) -> Column:
    """Start and text of each match, leftmost and not overlapping; code points."""

    def place(pairs: Column) -> Column:
        before = _running(F.transform(pairs, lambda p: p["gap"] + F.length(p["text"])), lambda a, b: a + b, 0)
        return F.zip_with(pairs, before, lambda p, at: F.struct((at + p["gap"]).alias("start"), p["text"].alias("text")))

    def pair(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
        pairs = F.zip_with(found, gaps, lambda m, g: F.struct(m.alias("text"), F.length(g).alias("gap")))
        none = F.array().cast("array<struct<start:int,text:string>>")
        return F.when(F.size(found) > 0, let(pairs, place)).otherwise(none)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), pair)


def _merged(spans: Column, gap: int) -> Column:
    """Spans (start, end) in order, those joined that lie less than ``gap`` apart."""

    def join(ordered: Column) -> Column:
        before = _running(F.transform(ordered, lambda s: s["end"]), lambda a, b: F.greatest(a, b), -_BLOCK)
        placed = F.zip_with(ordered, before, lambda s, end: F.struct(s["start"].alias("start"), end.alias("before")))
        heads = F.filter(placed, lambda s: s["start"] - s["before"] >= gap)
        last = F.array_max(F.transform(ordered, lambda s: s["end"]))

        def close(found: Column) -> Column:
            return F.transform(
                found,
                lambda s, k: F.struct(s["start"].alias("start"), F.coalesce(F.get(found, k + 1)["before"], last).alias("end")),
            )

        return let(heads, close)

    return let(F.sort_array(spans), join)


def _pattern_spans(text: Column, kind: int) -> Column:
    _, pattern, group, least = PATTERNS[kind]
    lengths = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda m: F.length(m))
    with_length = F.zip_with(
        _placed(text, pattern), lengths, lambda m, n: F.struct(m["start"].alias("start"), m["text"].alias("text"), n.alias("n"))
    )
    long_enough = F.filter(with_length, lambda m: m["n"] >= least)
    return F.transform(
        long_enough,
        lambda m: F.struct(m["start"].alias("start"), (m["start"] + F.length(m["text"])).alias("end"), F.lit(kind).alias("kind")),
    )


def _least_bits(piece: Column) -> Column:
    """Entropy that makes the piece's windows suspicious; null for classes that never are."""
    chosen = F.when(F.lit(False), F.lit(None).cast("double"))
    for pattern, bits in CLASSES:
        chosen = chosen.when(piece.rlike(pattern), F.lit(bits).cast("double"))
    return chosen


def _windows(piece: Column, offset: Column, bits: Column) -> Column:
    """Spans of the windows whose entropy reaches ``bits``, by incremental counts; blocks of starts are counted apart."""
    table = F.array(*[F.lit(_micro_bits(c)) for c in range(WINDOW + 2)])
    most = F.floor((F.lit(log2(WINDOW)) - bits) * WINDOW * 1e6).cast("int")

    def place(char: Column) -> Column:
        at = F.call_function("instr", F.lit(SYMBOLS), char) - 1
        return F.struct(F.floor(at / _COUNTS).cast("int").alias("number"), (at % _COUNTS * _BITS).alias("bit"))

    def one(symbol: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), symbol["bit"])

    def count(counts: Column, symbol: Column) -> Column:
        return F.call_function("shiftright", F.get(counts, symbol["number"]), symbol["bit"]).bitwiseAND(2**_BITS - 1).cast("int")

    def slide(places: Column, offset: Column) -> Column:
        none, zero = F.lit(None).cast("int"), F.lit(0).cast("long")
        begin = F.struct(
            F.array_repeat(zero, -(-len(SYMBOLS) // _COUNTS)).alias("counts"), F.lit(0).alias("sum"),
            none.alias("start"), none.alias("end"), F.array().cast("array<struct<start:int,end:int>>").alias("out"),
        )

        def last(state: Column) -> Column:
            whole = F.struct((state["start"] + offset).alias("start"), (state["end"] + offset).alias("end"))
            return F.when(state["end"].isNull(), state["out"]).otherwise(F.concat(state["out"], F.array(whole)))

        def step(state: Column, at: Column) -> Column:
            enters, leaves = F.get(places, at), F.get(places, at - WINDOW)
            up = count(state["counts"], enters)
            # The entering character counts before the leaving one is taken away.
            down = count(state["counts"], leaves) + (leaves == enters).cast("int")
            change = F.get(table, up + 1) - F.get(table, up)
            change = change + F.coalesce(F.get(table, down - 1) - F.get(table, down), F.lit(0))
            counts = F.transform(
                state["counts"],
                lambda c, k: c
                + F.when(k == enters["number"], one(enters)).otherwise(zero)
                - F.when(k == leaves["number"], one(leaves)).otherwise(zero),
            )

            def advance(total: Column) -> Column:
                high = (at >= WINDOW - 1) & (total <= most)
                left = at - (WINDOW - 1)
                fresh = high & ~F.coalesce(left <= state["end"], F.lit(False))
                return F.struct(
                    counts.alias("counts"), total.alias("sum"),
                    F.when(fresh, left).otherwise(state["start"]).alias("start"),
                    F.when(high, at + 1).otherwise(state["end"]).alias("end"),
                    F.when(fresh, last(state)).otherwise(state["out"]).alias("out"),
                )

            return let(state["sum"] + change, advance)

        return F.aggregate(F.sequence(F.lit(0), F.size(places) - 1), begin, step, last)

    blocks = F.regexp_extract_all(piece, F.lit(f"(?=(.{{1,{_STARTS + WINDOW - 1}}})).{{1,{_STARTS}}}"), F.lit(1))
    counted = F.transform(
        blocks,
        lambda block, k: let(F.transform(F.split(block, ""), place), lambda places: slide(places, offset + k * _STARTS)),
    )
    return F.flatten(counted)


def _entropy_spans(text: Column) -> Column:
    """Spans (start, end) of suspicious windows in the pieces of candidates, allowed strings being blanked."""
    none = F.array().cast("array<struct<start:int,end:int>>")

    def pieces(blanked: Column) -> Column:
        found = []
        for pattern, told in RUNS:
            placed = _placed(blanked, pattern)
            found.append(F.filter(placed, lambda p: ~p["text"].rlike(told)) if told else placed)
        return F.concat(*found)

    def of(match: Column) -> Column:
        blanked, allowed = match["text"], _least_bits(match["text"]).isNull()
        for pattern in ALLOWED:
            allowed = allowed | match["text"].rlike(pattern)
        for pattern, length in ALLOWED_INSIDE:
            blanked = F.regexp_replace(blanked, pattern, " " * length)

        def judge(piece: Column) -> Column:
            windows = lambda bits: F.when(bits.isNull(), none).otherwise(_windows(piece["text"], piece["start"] + match["start"], bits))
            return let(_least_bits(piece["text"]), windows)

        return F.when(allowed, none).otherwise(let(blanked, lambda b: F.flatten(F.transform(pieces(b), judge))))

    def joined(spans: Column) -> Column:
        kind = F.lit(KINDS.index("entropy"))
        return F.transform(_merged(spans, 1), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), kind.alias("kind")))

    return joined(F.flatten(F.transform(_placed(text, CANDIDATE), of)))


def secret_spans(text: Column) -> Column:
    """All spans of one whole text: array of (start, end, kind), by start, then kind; code points, end exclusive.

    ``kind`` counts in ``KINDS``. A missing text is an empty one; an empty text has no spans.
    A candidate may join a name to its value by = or _ or /, so its runs of narrower
    classes are judged too, each by its own; of kind entropy, spans that overlap or touch
    are one. A long candidate is counted in blocks of windows.
    """

    def scan(whole: Column) -> Column:
        every = F.concat(*[_pattern_spans(whole, kind) for kind in range(len(PATTERNS))], _entropy_spans(whole))
        by_place = F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
        return F.transform(
            F.sort_array(by_place),
            lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
        )

    return let(whole_text(text), scan)


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    written = F.transform(
        spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(written, ",")


def redacted(text: Column) -> Column:
    """The text with every run of overlapping spans replaced by a mark; null and clean texts stay as they are."""

    def cut(spans: Column) -> Column:
        def rebuild(merged: Column) -> Column:
            # A piece is cut from its own blocks, as a cut counts characters from the start of what it is given.
            def between(blocks: Column, start: Column, end: Column) -> Column:
                first = F.floor(start / _BLOCK).cast("int")
                own = F.slice(blocks, first + 1, F.floor(end / _BLOCK).cast("int") - first + 1)
                return F.substring(F.array_join(own, ""), start - first * _BLOCK + 1, end - start)

            def pieces(blocks: Column) -> Column:
                def piece(span: Column, at: Column) -> Column:
                    before = F.coalesce(F.get(merged, at - 1)["end"], F.lit(0))
                    return F.concat(between(blocks, before, span["start"]), F.lit(MARK))

                rest = between(blocks, F.get(merged, F.size(merged) - 1)["end"], F.length(text))
                return F.concat(F.array_join(F.transform(merged, piece), ""), rest)

            return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0)), pieces)

        places = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
        return F.when(F.size(spans) == 0, text).otherwise(let(_merged(places, 0), rebuild))

    return let(secret_spans(text), cut)


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and spans of (doc_id, text), one row per input row; missing ids stay, repeated rows are each scanned.

    Other columns are ignored; an empty table gives no rows.
    """
    return docs.select("doc_id", secret_spans(F.col("text")).alias("spans"))
