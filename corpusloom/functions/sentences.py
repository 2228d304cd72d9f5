"""Fuzzy removal of repeated sentences inside one text or one list of texts."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from math import ceil

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.fixed_values import ERROR_PREFIX, JACCARD_THRESHOLD, SENTENCE_MIN_CHARS
from corpusloom.functions.slices import TEXTS, by_slices
from corpusloom.functions.text import as_col

_ENDINGS = re.compile(r"[.!?]+")


def _sentences(text: str) -> list[tuple[str, frozenset[str]]]:
    """Sentences long enough to compare, each with its set of lower-cased words."""
    found = []
    for piece in _ENDINGS.split(" ".join(text.split())):
        sentence = piece.strip()
        words = sentence.lower().split()
        if len(" ".join(words)) >= SENTENCE_MIN_CHARS:
            found.append((sentence, frozenset(words)))
    return found


def _first_distinct(sentences: list[tuple[str, frozenset[str]]]) -> list[str]:
    """Greedy pass in order: keep a sentence unless a kept one is too similar.

    Two sets above the threshold must share a word among the rarest few of each
    (prefix filter), so only kept sentences listed under such a word are compared.
    """
    frequency = Counter(word for _, words in sentences for word in words)
    listed: dict[str, list[frozenset[str]]] = defaultdict(list)
    kept = []
    for sentence, words in sentences:
        size = len(words)
        rare = sorted(words, key=lambda word: (frequency[word], word))[: size - ceil(JACCARD_THRESHOLD * size) + 1]
        for other in (other for word in rare for other in listed[word]):
            shared = len(words & other)
            if shared / (size + len(other) - shared) > JACCARD_THRESHOLD:
                break
        else:
            kept.append(sentence)
            for word in rare:
                listed[word].append(words)
    return kept


def _first_distinct_of_text(text: str | None) -> list[str]:
    return _first_distinct(_sentences(text)) if text else []


def _first_distinct_of_list(texts) -> list[str]:
    if texts is None or len(texts) == 0:
        return []
    if len(texts) == 1:
        return _first_distinct_of_text(texts[0])
    usable = (text for text in texts if text and not text.startswith(ERROR_PREFIX))
    return _first_distinct([pair for text in usable for pair in _sentences(". ".join(_first_distinct_of_text(text)))])


_text_udf = by_slices(*TEXTS, lambda: _first_distinct_of_text)
_list_udf = by_slices(*TEXTS, lambda: _first_distinct_of_list)


def distinct_sentences(text: Column | str) -> Column:
    """Kept sentences of a text, in order."""
    return _text_udf(as_col(text))


def join_sentences(sentences: Column | str) -> Column:
    sentences = as_col(sentences)
    return F.when(F.size(sentences) > 0, F.concat(F.array_join(sentences, ". "), F.lit("."))).otherwise(F.lit(""))


def dedup_text(text: Column | str) -> Column:
    """The text without sentences that nearly repeat an earlier one."""
    return join_sentences(distinct_sentences(text))


def merge_summaries(summaries: Column | str) -> Column:
    """One text from a list of summaries.

    A single summary is only de-duplicated. Of several, failed and empty ones are
    left out, each is de-duplicated, then all together. The result is a fixed
    point: a further pass of :func:`dedup_text` leaves it as it is.
    """
    return join_sentences(_list_udf(as_col(summaries)))
