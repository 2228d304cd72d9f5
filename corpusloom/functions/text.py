"""Whitespace, HTML and truthiness helpers as Column expressions."""

from __future__ import annotations

from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.once import let

# Unicode whitespace; Java's \s and Spark's trim() know only part of it.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)
WS = r"[\s\x1c-\x1f\x85\p{Z}]"


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(text: Column | str) -> Column:
    """Remove Unicode whitespace from both ends (no regex, stays in codegen)."""
    return F.btrim(as_col(text), F.lit(WHITESPACE))


def non_empty(text: Column | str) -> Column:
    """The value, with '' treated as missing."""
    return F.nullif(as_col(text), F.lit(""))


def clean_text(text: Column | str) -> Column:
    """Unify line ends, squeeze blank lines and spaces, strip; null becomes ''."""
    unified = F.replace(F.replace(as_col(text), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    squeezed = F.regexp_replace(unified, rf"\n{WS}+\n+", "\n\n")
    return F.coalesce(strip(let(squeezed, _single_spaces)), F.lit(""))


def _single_spaces(text: Column) -> Column:
    """Runs of spaces and tabs as one space; the search for any is much cheaper than the regex."""
    runs = F.contains(text, F.lit("  ")) | F.contains(text, F.lit("\t"))
    return F.when(runs, F.regexp_replace(text, r"[ \t]+", " ")).otherwise(text)


class _TextNodes(HTMLParser):
    """Collects visible text nodes; every tag, comment or declaration ends one."""

    HIDDEN = {"script", "style", "template", "rt", "rp"}
    KEEP_BLANKS = {"pre", "textarea"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.nodes: list[str] = []
        self.pending: list[str] = []
        self.open: list[str] = []

    def flush(self) -> None:
        node = "".join(self.pending)
        self.pending = []
        if node and not self.HIDDEN.intersection(self.open):
            if not node.strip("\t\n\x0c\r ") and not self.KEEP_BLANKS.intersection(self.open):
                node = "\n" if "\n" in node else " "
            self.nodes.append(node)

    def handle_starttag(self, tag, attrs):
        self.flush()
        if tag in self.HIDDEN or tag in self.KEEP_BLANKS:
            self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.flush()

    def handle_endtag(self, tag):
        self.flush()
        if tag in self.open:
            del self.open[len(self.open) - 1 - self.open[::-1].index(tag) :]

    def handle_data(self, data):
        self.pending.append(data)

    def handle_entityref(self, name):
        self.pending.append(html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        code = int(name[1:], 16) if name[:1] in "xX" else int(name)
        try:
            char = bytes([code]).decode("cp1252") if 128 <= code < 160 else chr(code)
        except (ValueError, OverflowError, UnicodeDecodeError):
            char = "\N{REPLACEMENT CHARACTER}"
        self.pending.append(char)

    def handle_comment(self, data):
        self.flush()

    handle_decl = handle_pi = unknown_decl = handle_comment


def visible_text(markup: str) -> str:
    parser = _TextNodes()
    parser.feed(markup)
    parser.close()
    parser.flush()
    return "\n".join(parser.nodes)


@F.pandas_udf(T.StringType())
def _strip_html_dom(markup: pd.Series) -> pd.Series:
    return markup.map(visible_text, na_action="ignore")


def strip_html(text: Column | str, mode: str = "regex") -> Column:
    """Drop markup: ``regex`` deletes tags in the JVM, ``dom`` joins text nodes by newline."""
    if mode == "dom":
        return _strip_html_dom(as_col(text))
    return let(
        as_col(text),
        lambda value: F.when(F.contains(value, F.lit("<")), F.regexp_replace(value, "<[^>]+>", "")).otherwise(value),
    )


@F.pandas_udf(T.ArrayType(T.StringType()))
def _strip_each_dom(markups: pd.Series) -> pd.Series:
    return markups.map(lambda values: [value if value is None else visible_text(value) for value in values], na_action="ignore")


def strip_html_each(texts: Column, mode: str = "regex") -> Column:
    """``strip_html`` of every entry of an array; a lambda could not call Python."""
    return _strip_each_dom(texts) if mode == "dom" else F.transform(texts, lambda text: strip_html(text))


def clean_field(text: Column | str, html_mode: str = "regex") -> Column:
    return clean_text(strip_html(text, html_mode))
