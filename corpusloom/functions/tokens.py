"""Token arrays for supervised training: ids, masked labels, budgets."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.fixed_values import LABEL_IGNORE, WHITESPACE_TOKEN_BITS
from corpusloom.functions.text import WS, as_col, strip


def hashed_words(text: Column | str) -> Column:
    """Offline tokenizer: one id per word, the first bits of the word's MD5."""
    words = F.filter(F.split(strip(as_col(text)), f"{WS}+"), lambda word: word != "")
    digits = WHITESPACE_TOKEN_BITS // 4
    return F.transform(words, lambda word: F.conv(F.substring(F.md5(word), 1, digits), 16, 10).cast("int"))


@dataclass(frozen=True)
class PythonTokenizer:
    """Runs any ``encode(text) -> ids`` callable in Arrow batches.

    ``load`` builds the callable once per Python worker, so a vocabulary is
    read once and not shipped with every batch.
    """

    load: Callable[[], Callable[[str], list[int]]]

    def __call__(self, text: Column | str) -> Column:
        load, loaded = self.load, []

        @F.pandas_udf(T.ArrayType(T.IntegerType()))
        def encode(texts: pd.Series) -> pd.Series:
            if not loaded:
                loaded.append(load())
            return texts.fillna("").map(lambda value: list(loaded[0](value)))

        return encode(as_col(text))


def truncate(ids: Column | str, max_length: int) -> Column:
    return F.slice(as_col(ids), 1, max_length)


def masked_labels(ids: Column | str, prompt_length: Column | str, response_max: int | None = None) -> Column:
    """The ids with the prompt masked; with ``response_max``, only that many last ids stay."""
    ids, prompt_length = as_col(ids), as_col(prompt_length)
    first_kept = F.lit(0) if response_max is None else F.size(ids) - response_max
    return F.transform(
        ids,
        lambda token, at: F.when((at < prompt_length) | (at < first_kept), F.lit(LABEL_IGNORE)).otherwise(token),
    )


def pad(values: Column | str, length: Column | str, filler: int, side: str = "right") -> Column:
    values = as_col(values)
    fill = F.array_repeat(F.lit(filler), F.greatest(as_col(length) - F.size(values), F.lit(0)))
    return F.concat(values, fill) if side == "right" else F.concat(fill, values)


def token_budget(model_max: Column | str, input_length: Column | str, max_new: Column | str) -> tuple[Column, Column]:
    """(prompt tokens kept, new tokens allowed) for one generation call.

    A prompt that leaves no room is cut so that the new tokens fit, but never
    below half the model's window. An unknown window (null or 0) sets no limit.
    """
    model_max = F.coalesce(as_col(model_max), F.lit(0))
    input_length, max_new = as_col(input_length), as_col(max_new)
    half = F.greatest(F.lit(1), F.floor(model_max / 2).cast("int"))
    too_long = (model_max > 0) & (input_length >= model_max)
    kept = F.when(too_long, F.least(input_length, F.greatest(model_max - max_new, half))).otherwise(input_length)
    room = F.greatest(F.lit(1), model_max - kept)
    return kept, F.when(model_max > 0, F.least(max_new, room)).otherwise(max_new)
