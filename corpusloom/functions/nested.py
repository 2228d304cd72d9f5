"""Texts inside JSON values of unknown shape."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import fixed_values as fixed
from corpusloom.functions.text import as_col, strip, strip_html, visible_text

_KINDS_FIRST = set(fixed.SECTION_TEXT_KEYS)
# The parser's own limit on a string would reject texts of more than 20 million characters.
JSON_OPTIONS = {"maxStringLen": str(2**31 - 1)}


def parse_value(text: Column | str) -> Column:
    """A JSON text as a variant, null if it is none."""
    wrapped = F.concat(F.lit('{"value":'), as_col(text), F.lit("}"))
    return F.from_json(wrapped, "value variant", JSON_OPTIONS)["value"]


def is_json(text: Column | str) -> Column:
    """Whether a text is one JSON value and nothing else.

    Spark's parser stops at the end of the first value. What follows it would
    have to close both a list and an object to go unnoticed here.
    """
    text = as_col(text)
    strict = JSON_OPTIONS | {"allowSingleQuotes": "false"}
    in_list = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", strict)
    schema = "value string, malformed string"
    in_object = F.from_json(
        F.concat(F.lit('{"value":'), text, F.lit("}")), schema, strict | {"columnNameOfCorruptRecord": "malformed"}
    )
    return in_list.isNotNull() & in_object["malformed"].isNull()


def _object_response(value: Column) -> Column:
    found = F.coalesce(*[F.try_variant_get(value, path, "variant") for path in fixed.RESPONSE_PATHS])
    found = F.when(F.schema_of_variant(value) == "STRING", value).otherwise(found)
    text = F.when(F.schema_of_variant(found) == "STRING", F.try_variant_get(found, "$", "string"))
    return F.nullif(strip(text), F.lit(""))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _list_leaves(values: pd.Series) -> pd.Series:
    """Entries of a JSON list, lists inside it opened at any depth."""

    def one(value):
        leaves, waiting = [], [json.loads(value)]
        while waiting:
            node = waiting.pop()
            if isinstance(node, list):
                waiting.extend(reversed(node))
            else:
                leaves.append(json.dumps(node))
        return leaves

    return values.map(one, na_action="ignore")


def response_text(response: Column | str) -> Column:
    """Text of a model response given as JSON text, or as plain text.

    The first path present decides, even if what it holds is blank or no text.
    Of a list, the first entry that yields a text counts. Only list rows visit
    Python, which opens nested lists; the choice of text stays in the JVM.
    """
    response = as_col(response)
    value = parse_value(response)
    is_list = F.startswith(F.schema_of_variant(value), F.lit("ARRAY"))
    texts = F.transform(
        _list_leaves(F.when(is_list, response)), lambda leaf: _object_response(parse_value(leaf))
    )
    return (
        F.when(value.isNull(), F.nullif(strip(response), F.lit("")))
        .when(is_list, F.get(F.filter(texts, lambda text: text.isNotNull()), 0))
        .otherwise(_object_response(value))
    )


def harvest(value, html_mode: str) -> list[str]:
    """Texts of a parsed JSON value, well-known keys of an object before its others."""
    texts, waiting = [], [value]
    while waiting:
        node = waiting.pop()
        if isinstance(node, dict):
            first = [node[key] for key in fixed.SECTION_TEXT_KEYS if node.get(key)]
            waiting.extend(reversed(first + [item for key, item in node.items() if key not in _KINDS_FIRST]))
        elif isinstance(node, list):
            waiting.extend(reversed(node))
        elif isinstance(node, str):
            node = node.strip()
            if node[:1] in ("{", "[") and len(node) > fixed.NESTED_JSON_MIN:
                try:
                    waiting.append(json.loads(node))
                    continue
                except (ValueError, RecursionError):
                    pass
            texts.append(visible_text(node) if html_mode == "dom" else node)
    return texts


def nested_texts(json_text: Column | str, html_mode: str = "regex") -> Column:
    """Array of the non-blank texts in a JSON text, or null if it is not JSON."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def collect(values: pd.Series) -> pd.Series:
        def one(value):
            try:
                return harvest(json.loads(value), html_mode)
            except (ValueError, RecursionError):
                return None

        return values.map(one, na_action="ignore")

    texts = collect(as_col(json_text))
    if html_mode == "regex":
        texts = F.transform(texts, lambda text: strip_html(text))
    return F.filter(F.transform(texts, strip), lambda text: text != "")
