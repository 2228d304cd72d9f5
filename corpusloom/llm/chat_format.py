"""Chat formatting with Spark expressions only.

A conversation is ``### role: text</turn>`` per run of turns of one role, newline
after each; turns of one role in a row stand in one block, ``</part>`` between
them, so that reading back finds every turn. Inside roles and texts a backslash,
``<``, ``#``, ``:`` (roles only) and newline (roles only) are written with a
backslash and a letter; no control string can then arise from a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.once import let

OPEN, AFTER_ROLE, PART, CLOSE = "### ", ": ", "</part>", "</turn>\n"
_TEXT_ESCAPES = [("\\", "\\b"), ("<", "\\l"), ("#", "\\h")]
_ROLE_ESCAPES = [*_TEXT_ESCAPES, (":", "\\c"), ("\n", "\\n")]
LOSS_ROLE = "assistant"


def _escape(text: Column, escapes: list[tuple[str, str]]) -> Column:
    for plain, written in escapes:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def _unescape(text: Column, escapes: list[tuple[str, str]]) -> Column:
    for plain, written in reversed(escapes):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, b: a + b)


def _blocks(turns: Column) -> Column:
    """Runs of turns of one role: array of (role, parts)."""
    places = F.sequence(F.lit(0), F.size(turns) - 1)
    starts = F.filter(places, lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]))

    def cut(begins: Column) -> Column:
        def block(begin: Column, at: Column) -> Column:
            end = F.coalesce(F.get(begins, at + 1), F.size(turns))
            members = F.slice(turns, begin + 1, end - begin)
            return F.struct(F.get(turns, begin)["role"].alias("role"), F.transform(members, lambda t: t["text"]).alias("parts"))

        return F.transform(begins, block)

    return let(starts, cut)


def _written(block: Column) -> Column:
    head = F.concat(F.lit(OPEN), _escape(block["role"], _ROLE_ESCAPES), F.lit(AFTER_ROLE))
    parts = F.transform(block["parts"], lambda text: _escape(text, _TEXT_ESCAPES))
    return let(
        parts,
        lambda p: F.struct(
            F.concat(head, F.array_join(p, PART), F.lit(CLOSE)).alias("text"),
            (block["role"] == LOSS_ROLE).alias("loss"), F.length(head).alias("head"),
            F.transform(p, lambda x: F.length(x)).alias("lengths"),
        ),
    )


def _loss_spans(written: Column) -> Column:
    """Start (code points, from 0) and length of each text under the loss mask, in order."""
    empty = F.array().cast("array<struct<start:int,length:int>>")

    def step(state: Column, block: Column) -> Column:
        def part(length: Column, at: Column) -> Column:
            earlier = F.aggregate(F.slice(block["lengths"], F.lit(1), at), F.lit(0), lambda a, b: a + b + len(PART))
            return F.struct((state["at"] + block["head"] + earlier).alias("start"), length.alias("length"))

        spans = F.when(block["loss"], F.concat(state["out"], F.transform(block["lengths"], part))).otherwise(state["out"])
        return F.struct((state["at"] + F.length(block["text"])).alias("at"), spans.alias("out"))

    begin = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    return F.aggregate(written, begin, step, lambda s: s["out"])


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans), one row per conversation of (conv_id, turn, role, text).

    Turns are in order of turn, then role and text; missing texts and roles are
    empty; a missing turn number comes first; repeated rows are repeated turns; rows
    without conv_id form one conversation; other columns are ignored; an empty table
    gives no rows. A conversation is one cell, so Spark's limit of 2 GB holds for it.
    """
    one = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    gathered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("turns"))
    blocks = let(_blocks(F.col("turns")), lambda found: F.transform(found, _written))
    made = let(
        blocks,
        lambda w: F.struct(
            F.array_join(F.transform(w, lambda b: b["text"]), "").alias("formatted"), _loss_spans(w).alias("loss_spans")
        ),
    )
    return gathered.select("conv_id", made.alias("made")).select("conv_id", "made.formatted", "made.loss_spans")


def read_chats(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_texts) from the output of ``format_chats``: turns as (role, text), texts unescaped."""
    pieces = F.split("formatted", CLOSE, -1)
    blocks = F.filter(pieces, lambda p: p != "")

    def turns_of(block: Column) -> Column:
        role = F.substring_index(F.substring(block, len(OPEN) + 1, F.length(block)), AFTER_ROLE, 1)
        return let(
            role,
            lambda r: F.transform(
                F.split(F.substring(block, F.length(r) + (len(OPEN) + len(AFTER_ROLE) + 1), F.length(block)), PART, -1),
                lambda text: F.struct(
                    _unescape(r, _ROLE_ESCAPES).alias("role"), _unescape(text, _TEXT_ESCAPES).alias("text")
                ),
            ),
        )

    masked = F.transform(
        "loss_spans",
        lambda s: _unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]), _TEXT_ESCAPES),
    )
    turns = F.flatten(F.transform(blocks, turns_of))
    return formatted.select("conv_id", turns.alias("turns"), masked.alias("loss_texts"), "formatted")


def chat_digest(read: DataFrame) -> DataFrame:
    """Counts and hashes of what ``read_chats`` found."""
    per_turn = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(per_turn, "").cast("binary"), 256).alias("turns_sha256"),
        _sum(F.transform("loss_texts", lambda t: F.length(t).cast("long"))).alias("loss_chars"),
        F.sha2(F.array_join("loss_texts", "").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
