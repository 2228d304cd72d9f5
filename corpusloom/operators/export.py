"""Free-form JSON records to a flat review table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import fixed_values as fixed
from corpusloom.functions.nested import JSON_OPTIONS, is_json
from corpusloom.functions.once import let
from corpusloom.functions.text import as_col

_RESERVED = ("source_id", "original_row", "metadata")
_FIRST_HEADERS = ("source_id", "merged_output", "original_row")
_MAX_COLUMNS = 10_000


def parse_record(record: Column | str) -> Column:
    """struct(texts, kinds) of a JSON object: values as text in the object's order, value types."""
    record = as_col(record)
    typed = F.from_json(record, "map<string,variant>", JSON_OPTIONS)
    return F.struct(
        F.from_json(record, "map<string,string>", JSON_OPTIONS).alias("texts"),
        F.transform_values(typed, lambda _, value: F.schema_of_variant(value)).alias("kinds"),
    )


def is_whole(parsed: Column) -> Column:
    """Whether all fields of a parsed object are there with their kinds, whatever the session allows in a variant."""
    texts, kinds = parsed["texts"], parsed["kinds"]
    known = F.size(F.map_filter(kinds, lambda _, kind: kind.isNotNull())) == F.size(texts)
    return F.coalesce(known, F.lit(False))


def exportable(record: Column | str) -> Column:
    """Whether a line is JSON, and if it is an object, one that can be exported whole."""
    record = as_col(record)
    is_object = F.startswith(F.ltrim(record), F.lit("{"))
    return is_json(record) & (~is_object | let(parse_record(record), is_whole))


def _is_nested(kind: Column) -> Column:
    return F.rlike(kind, F.lit("^(OBJECT|ARRAY)"))


def output_field(parsed: Column, strict: bool = False) -> Column:
    """Name of the field with the output, '' if there is none.

    A well-known name wins by presence, else the first non-empty string counts.
    Merged records name theirs ``final_summary``; ``strict`` treats that as any
    other field, which picks another one where the summary is empty.
    """
    known = fixed.EXPORT_OUTPUT_KEYS if strict else [*fixed.EXPORT_OUTPUT_KEYS, "final_summary"]
    texts, kinds = parsed["texts"], parsed["kinds"]
    keys = F.map_keys(texts)
    named = F.array_intersect(F.array(*map(F.lit, known)), keys)
    others = F.filter(keys, lambda key: ~key.isin(*_RESERVED) & (kinds[key] == "STRING") & (texts[key] != ""))
    return F.coalesce(F.get(named, 0), F.get(others, 0), F.lit(""))


def _original(parsed: Column) -> Column:
    """Name of the field that holds the original row: the first unless it is empty in any way."""
    text, kind = parsed["texts"]["original_row"], parsed["kinds"]["original_row"]
    number = F.rlike(kind, F.lit("^(BIGINT|DOUBLE|DECIMAL)"))
    empty = (
        kind.isNull()
        | (kind == "VOID")
        | ((kind == "STRING") & (text == ""))
        | ((kind == "BOOLEAN") & (text == "false"))
        | (_is_nested(kind) & text.isin("{}", "[]"))
        | (number & (text.try_cast("double") == 0))
    )
    return F.when(empty, F.lit("metadata")).otherwise(F.lit("original_row"))


def flatten_record(record: Column | str, strict: bool = False) -> Column:
    """Flat string map of a JSON record.

    The original row's fields are spread and win over ``source_id`` and the
    output; other top-level scalars fill what is left. Nested values become JSON
    text, nulls ''.
    """
    return let(parse_record(record), lambda parsed: _flatten(parsed, strict))


def _flatten(parsed: Column, strict: bool) -> Column:
    texts, kinds = parsed["texts"], parsed["kinds"]
    empty = F.create_map().cast("map<string,string>")

    def build(chosen: Column) -> Column:
        field, origin = chosen["field"], chosen["origin"]
        kind, text = kinds[origin], texts[origin]
        is_object = F.startswith(kind, F.lit("OBJECT"))
        spread = F.coalesce(F.from_json(F.when(is_object, text), "map<string,string>", JSON_OPTIONS), empty)
        spread = F.transform_values(spread, lambda _, value: F.coalesce(value, F.lit("")))
        stringified = F.when(
            ~is_object & kind.isNotNull() & (kind != "VOID"), F.create_map(F.lit("original_row"), text)
        )
        original = F.when(is_object, spread).otherwise(F.coalesce(stringified, empty))
        return let(original, lambda bound: around(field, bound))

    def around(field: Column, original: Column) -> Column:
        head = F.map_filter(
            F.map_concat(
                F.when(F.map_contains_key(texts, "source_id"),
                       F.create_map(F.lit("source_id"), F.coalesce(texts["source_id"], F.lit("")))).otherwise(empty),
                F.create_map(F.lit("merged_output"), F.when(field != "", F.coalesce(texts[field], F.lit(""))).otherwise("")),
            ),
            lambda key, _: ~F.map_contains_key(original, key),
        )
        rest = F.map_filter(
            texts,
            lambda key, _: ~key.isin(*_RESERVED, "merged_output")
            & (key != field)
            & (kinds[key] != "VOID")
            & ~_is_nested(kinds[key])
            & ~F.map_contains_key(original, key),
        )
        return F.map_concat(head, original, rest)

    chosen = F.struct(output_field(parsed, strict).alias("field"), _original(parsed).alias("origin"))
    return let(chosen, build)


def header_names(flat: DataFrame, column: str = "flat") -> DataFrame:
    """Distinct keys of all flat records; combined before the shuffle."""
    return flat.select(F.explode(F.map_keys(column)).alias("header")).distinct()


def ordered_headers(names: list[str]) -> list[str]:
    first = [name for name in _FIRST_HEADERS if name in names]
    return first + sorted(set(names) - set(first))


def review_table(flat: DataFrame, headers: list[str] | None = None, column: str = "flat") -> DataFrame:
    """One string column per header; the default headers are all keys that occur.

    Only the key names come to the driver: they are the table's columns.
    """
    if headers is None:
        names = [row[0] for row in header_names(flat, column).limit(_MAX_COLUMNS + 1).collect()]
        if len(names) > _MAX_COLUMNS:
            raise ValueError(f"more than {_MAX_COLUMNS} distinct keys: name the columns to export")
        headers = ordered_headers(names)
    return flat.select(*[F.coalesce(F.col(column)[name], F.lit("")).alias(name) for name in headers])
