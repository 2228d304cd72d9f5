"""Counts and ratios of a whole text, as Spark columns.

Everything is computed inside one row with array functions: no explode, no
shuffle, no Python. Repeated windows are found by sorting the hashes of a text's
own windows (64 bits), so the cost is n log n in the words of a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.once import let
from corpusloom.llm.common import SPACE, WORD, whole_text, words_of

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = [
    "word_length", "symbols", "duplicate_lines", "repeated_words", "capitals", "digits", "exclamations", "stops",
    "distinct_words", "line_words", "words_log2",
]
WINDOW = 3


def _repeat_words(words: Column) -> Column:
    """Words inside windows that occur at least twice in the text."""
    n = F.size(words)
    hashes = F.slice(
        F.transform(words, lambda word, at: F.xxhash64(word, F.get(words, at + 1), F.get(words, at + 2))),
        F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(0)),
    )

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, at: F.struct(h.alias("h"), at.alias("at"))))
        twice = let(
            placed,
            lambda p: F.filter(p, lambda x, i: (x["h"] == F.get(p, i - 1)["h"]) | (x["h"] == F.get(p, i + 1)["h"])),
        )
        starts = F.sort_array(F.transform(twice, lambda x: x["at"]))
        total = let(
            starts,
            lambda s: F.aggregate(
                F.transform(s, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(s, i + 1) - x, F.lit(WINDOW)))),
                F.lit(0), lambda a, b: a + b,
            ),
        )
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(total)

    return F.when(n < WINDOW, F.lit(0)).otherwise(let(hashes, covered))


def _counts(text: Column, words: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    n = F.size(words).cast("long")
    return let(
        lines,
        lambda found: F.struct(
            n.alias("n_words"),
            (F.length(text) - F.regexp_count(text, F.lit(SPACE))).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
            F.size(found).cast("long").alias("n_lines"),
            F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
            F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
            F.regexp_count(text, F.lit(r"[0-9]")).cast("long").alias("n_digits"),
            F.regexp_count(text, F.lit(r"[!?]")).cast("long").alias("n_exclamations"),
            F.regexp_count(text, F.lit(r"[.,;:]")).cast("long").alias("n_stops"),
        ),
    )


def text_counts(text: Column) -> Column:
    """A struct of counts of one whole text; a missing text counts as an empty one."""
    return let(whole_text(text), lambda whole: let(words_of(whole), lambda words: _counts(whole, words)))


def with_features(docs: DataFrame) -> DataFrame:
    """doc_id, the counts and the ratios (doubles) of (doc_id, text); other columns are not looked at.

    A text without words has 0 in every ratio.
    """
    c = F.col("_counts")
    rows = docs.select("doc_id", text_counts(F.col("text")).alias("_counts"))
    n = F.greatest(c["n_words"], F.lit(1)).cast("double")
    lines = F.greatest(c["n_lines"], F.lit(1)).cast("double")
    chars = F.greatest(c["word_chars"], F.lit(1)).cast("double")
    ratios = {
        "word_length": c["word_chars"] / n, "symbols": c["n_symbols"] / n, "duplicate_lines": c["n_dup_lines"] / lines,
        "repeated_words": c["n_repeat_words"] / n, "capitals": c["n_capitals"] / chars, "digits": c["n_digits"] / chars,
        "exclamations": c["n_exclamations"] / n, "stops": c["n_stops"] / n, "distinct_words": c["n_distinct"] / n,
        "line_words": c["n_words"] / lines, "words_log2": F.log2(n),
    }
    return rows.select("doc_id", *[c[x].alias(x) for x in COUNTS], *[v.alias(k) for k, v in ratios.items()])
