"""Training examples to token arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom import fixed_values as fixed
from corpusloom.functions.prompts import build_prompt
from corpusloom.functions.text import non_empty
from corpusloom.functions.tokens import hashed_words, masked_labels, pad, truncate

Tokenizer = Callable[[Column], Column]


def load_examples(records: DataFrame) -> DataFrame:
    """(instruction, input, output) with '' for what is missing; other columns stay."""
    names = ("instruction", "input", "output")
    known = set(records.columns)
    return records.withColumns(
        {name: F.coalesce(F.col(name), F.lit("")) if name in known else F.lit("") for name in names}
    )


def empty_outputs(examples: DataFrame) -> DataFrame:
    return examples.agg(F.count_if(non_empty("output").isNull()).alias("empty_outputs"))


def require_outputs(examples: DataFrame) -> DataFrame:
    """Stops the job that reads the result at the first example without an output."""
    message = F.lit("Found an example with an empty 'output'. Provide targets before training.")
    guard = F.when(non_empty("output").isNull(), F.raise_error(message)).otherwise(F.col("output"))
    return examples.withColumn("output", guard.cast("string"))


def tokenize_examples(
    examples: DataFrame,
    tokenizer: Tokenizer = hashed_words,
    max_length: int = fixed.CUTOFF_LEN,
    response_max: int | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(input_ids, attention_mask, labels) per example, prompts masked in the labels.

    The prompt is tokenized by itself under the same cut, so a prompt as long as
    the cut leaves no label. ``response_max`` keeps only the last labels.
    """
    prompt = build_prompt("instruction", "input")
    tokens = examples.select(
        *keep,
        truncate(tokenizer(F.concat(prompt, F.coalesce("output", F.lit("")))), max_length).alias("input_ids"),
        F.size(truncate(tokenizer(prompt), max_length)).alias("_prompt_length"),
    )
    return tokens.select(
        *keep,
        "input_ids",
        F.transform("input_ids", lambda _: F.lit(1)).alias("attention_mask"),
        masked_labels("input_ids", "_prompt_length", response_max).alias("labels"),
    )


def pad_batches(
    tokens: DataFrame, batch_size: int = 1, idx: str = "idx", pad_id: int = 0, side: str = "right"
) -> DataFrame:
    """Pads to the longest of each batch of ``batch_size`` consecutive examples.

    Labels are padded on the right whatever the tokenizer's side. Batches are
    small and equal in size, so the window over one never grows with the data.
    """
    batch = F.floor(F.col(idx) / batch_size).cast("bigint")
    longest = F.max(F.size("input_ids")).over(Window.partitionBy("batch_id"))
    padded = tokens.withColumn("batch_id", batch).withColumn("_longest", longest)
    return padded.withColumns(
        {
            "input_ids": pad("input_ids", "_longest", pad_id, side),
            "attention_mask": pad("attention_mask", "_longest", 0, side),
            "labels": pad("labels", "_longest", fixed.LABEL_IGNORE),
        }
    ).drop("_longest")
