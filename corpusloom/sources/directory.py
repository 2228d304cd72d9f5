"""A folder of JSON, JSONL, CSV, Markdown and text files as documents."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import fixed_values as fixed
from corpusloom.functions.classify import file_stem
from corpusloom.functions.once import compute_where
from corpusloom.functions.slices import by_slices
from corpusloom.functions.text import clean_text, non_empty
from corpusloom.operators.documents import record_text
from corpusloom.operators.export import is_whole, parse_record
from corpusloom.sources.csv_rows import read_csv_rows
from corpusloom.sources.lines import file_name, read_jsonl_lenient

STRUCTURED = r"(?i)\.(json|jsonl|csv)$"


def _as_json(item: object) -> str:
    """JSON text of a value; half a surrogate pair, which UTF-8 does not have, stays an escape, as it is in a line."""
    text = json.dumps(item, ensure_ascii=False)
    try:
        text.encode()
    except UnicodeEncodeError:
        text = json.dumps(item)
    return text


def _unwrapped(text: str | None) -> dict:
    if text is None:
        return {"items": None, "error": "not valid UTF-8"}
    try:
        value = json.loads(text)
    except (ValueError, RecursionError) as failure:
        return {"items": None, "error": f"JSON parse error: {failure}"}
    if isinstance(value, dict):
        value = next((item for item in value.values() if isinstance(item, list)), [value])
    if not isinstance(value, list):
        return {"items": None, "error": "Unexpected JSON shape"}
    return {"items": [_as_json(item) for item in value], "error": None}


_unwrap = by_slices(
    T.StructType().add("items", T.ArrayType(T.StringType())).add("error", T.StringType()),
    pa.struct({"items": pa.list_(pa.string()), "error": pa.string()}),
    lambda: _unwrapped,
)


def read_json_documents(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of whole-file JSON: a list, an object's first list value, or the object.

    The result has (file, row_index, record, total), records as JSON text in file order.
    """
    files = spark.read.option("pathGlobFilter", "*.[jJ][sS][oO][nN]").text(path, wholetext=True)
    valid = F.when(F.is_valid_utf8("value"), F.col("value"))
    parsed = files.select(file_name().alias("file"), _unwrap(valid).alias("parsed"))
    records = parsed.select(
        "file",
        F.size("parsed.items").alias("total"),
        F.posexplode_outer("parsed.items").alias("row_index", "record"),
    ).where(F.col("record").isNotNull())
    rejects = parsed.where(F.col("parsed.error").isNotNull()).select("file", F.col("parsed.error").alias("error"))
    return records, rejects


def read_text_files(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(files, rejects): (file, text) of every file that is not JSON, JSONL or CSV."""
    files = spark.read.text(path, wholetext=True).where(~F.rlike("_metadata.file_name", F.lit(STRUCTURED)))
    files = files.select(file_name().alias("file"), "value")
    texts = files.where(F.is_valid_utf8("value")).select("file", F.col("value").alias("text"))
    rejects = files.where(~F.is_valid_utf8("value")).select("file", F.lit("not valid UTF-8").alias("error"))
    return texts, rejects


def _documents_of(rows: DataFrame, title: Column, text: Column) -> DataFrame:
    return compute_where(
        rows.withColumn("title", F.coalesce(title, F.lit(""))),
        ("file", "row_index", "title"),
        {"text": text},
        lambda made: F.length(made["text"]) > fixed.DOCUMENT_TEXT_MIN,
    )


def documents_of_records(records: DataFrame, html_mode: str = "regex") -> DataFrame:
    """(file, row_index, title, text) of (file, row_index, record) with records as JSON text."""
    parsed = records.select("file", "row_index", parse_record("record").alias("parsed"))
    texts, kinds = F.col("parsed.texts"), F.col("parsed.kinds")
    strings = F.map_filter(texts, lambda name, _: kinds[name] == "STRING")
    rows = parsed.where(is_whole(F.col("parsed"))).select(
        "file",
        "row_index",
        texts.alias("texts"),
        strings.alias("strings"),
        texts["sections"].alias("sections"),
        (kinds["sections"] != "STRING").alias("sections_is_json"),
    )
    title = F.coalesce(non_empty(F.col("texts")["title"]), non_empty(F.col("texts")["name"]))
    return _documents_of(rows, title, record_text("strings", "sections", "sections_is_json", html_mode))


def documents_of_rows(rows: DataFrame, html_mode: str = "regex") -> DataFrame:
    """(file, row_index, title, text) of table rows, which hold strings only."""
    fields = F.col("row")
    strings = F.map_filter(fields, lambda _, value: value.isNotNull())
    title = F.coalesce(non_empty(fields["title"]), non_empty(fields["name"]))
    text = record_text("strings", fields["sections"], F.lit(False), html_mode)
    return _documents_of(rows.withColumn("strings", strings), title, text)


def collect_documents(spark: SparkSession, path: str | list[str], html_mode: str = "regex") -> tuple[DataFrame, DataFrame]:
    """(documents, rejects) of a folder, not of the folders in it.

    Documents are (file, title, text). A file or line that cannot be read becomes
    a reject and disturbs no other.
    """
    json_records, json_rejects = read_json_documents(spark, path)
    json_lines, line_rejects = read_jsonl_lenient(spark, path, glob="*.[jJ][sS][oO][nN][lL]")
    csv_rows, csv_rejects = read_csv_rows(spark, path, trim=False)
    text_files, text_rejects = read_text_files(spark, path)

    lines = json_lines.withColumnRenamed("ordinal", "row_index")
    texts = text_files.where(F.length("text") > fixed.DOCUMENT_TEXT_MIN).select(
        "file", file_stem("file").alias("title"), clean_text("text").alias("text")
    )
    documents = texts
    for found in (
        documents_of_records(json_records, html_mode),
        documents_of_records(lines, html_mode),
        documents_of_rows(csv_rows, html_mode),
    ):
        documents = documents.unionByName(found.drop("row_index"))
    # What is valid JSON and no object, or holds a value too large for a variant, is told, not dropped.
    odd = [
        records.where(~is_whole(parse_record("record"))).select("file", F.concat(F.lit("no usable JSON object in record "), F.col("row_index").cast("string")).alias("error"))
        for records in (json_records, lines)
    ]
    bad_lines = line_rejects.select(
        "file", F.concat(F.lit("invalid JSON in line "), F.col("line_number").cast("string")).alias("error")
    )
    return documents, json_rejects.unionByName(bad_lines).unionByName(odd[0]).unionByName(odd[1]).unionByName(csv_rejects).unionByName(text_rejects)
