"""Title of a text, from its first lines or its first sentence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.fixed_values import TITLE_MAX, TITLE_MIN
from corpusloom.functions.once import let
from corpusloom.functions.text import WS, as_col, strip, strip_html

_NOT_A_TITLE = r"https?://|www\.|[@<>{}]"
_LINES_SEEN = 3


def _unmark(line: Column) -> Column:
    line = strip(line)
    for mark in ("#", "-", r"\*"):
        line = F.regexp_replace(line, rf"^{mark}+{WS}*", "")
    return line


def extract_title(text: Column | str, max_length: int = TITLE_MAX, html_mode: str = "regex") -> Column:
    """First title-like line of three, else the first sentence, else a cut of the text."""
    if html_mode == "regex":
        return let(F.coalesce(strip(as_col(text)), F.lit("")), lambda value: _title(value, max_length, html_mode))
    return _title(F.coalesce(strip(as_col(text)), F.lit("")), max_length, html_mode)


def _title(stripped: Column, max_length: int, html_mode: str) -> Column:
    def title_like(line: Column) -> Column:
        return (
            F.length(line).between(TITLE_MIN, max_length)
            & ~F.endswith(line, F.lit("."))
            & ~F.rlike(line, F.lit(_NOT_A_TITLE))
        )

    # Only the head of the text is split, however long the text is.
    head = F.substring_index(stripped, "\n", _LINES_SEEN)
    if html_mode == "dom":
        # A lambda cannot call Python: the three lines become three columns.
        lines = [strip(strip_html(_unmark(F.split_part(head, F.lit("\n"), F.lit(i + 1))), "dom")) for i in range(3)]
        candidates = F.filter(F.array(*lines), title_like)
    else:
        plain = F.transform(F.split(head, "\n"), lambda line: strip(strip_html(_unmark(line))))
        candidates = F.filter(plain, title_like)
    sentence = let(
        strip(F.substring_index(stripped, ".", 1)),
        lambda value: F.when(F.length(value).between(TITLE_MIN, max_length), value),
    )
    cut = F.concat(strip(F.substring(stripped, 1, max_length)), F.lit("..."))
    return F.coalesce(F.get(candidates, 0), sentence, F.when(F.length(stripped) > max_length, cut), stripped)

