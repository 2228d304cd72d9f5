import json

from pyspark.sql import functions as F

from corpusloom import fixed_values as fixed
from corpusloom.operators.chunks import chunk_rows
from corpusloom.operators.documents import examples_from_documents
from corpusloom.operators.rows import chunk_source_text, map_fields, rows_to_examples
from corpusloom.sources.directory import documents_of_records, documents_of_rows


def _rows(spark, rows, name="data.csv"):
    return spark.createDataFrame(
        [(name, i, row) for i, row in enumerate(rows)], "file string, row_index int, row map<string,string>"
    )


def test_chunk_text_column_falls_through(spark):
    rows = _rows(spark, [
        {"full_text": "short", "text": "<p>long enough text</p>"},
        {"mine": "my own column text", "full_text": "the usual column"},
        {"full_text": "1234567890", "sections": "12345678901"},
        {"body": None, "text": ""},
    ])
    found = rows.select("row_index", chunk_source_text(map_fields(), "mine").alias("t")).orderBy("row_index").collect()
    assert [row["t"] for row in found] == ["long enough text", "my own column text", "12345678901", ""]


def test_chunk_rows_keep_gaps_and_lineage(spark):
    long = "A sentence of some length. " * 20
    rows = _rows(spark, [{"full_text": "too short"}, {"full_text": long, "title": "T"}, {"full_text": "just long enough"}], "my.data.csv")
    chunks = chunk_rows(rows, max_chars=250).orderBy("source_id", "chunk_index").collect()
    assert [row["source_id"] for row in chunks][-1] == "my.data_2"
    first = [row for row in chunks if row["source_id"] == "my.data_1"]
    assert len(first) == first[0]["total_chunks"] > 1
    assert [row["chunk_index"] for row in first] == list(range(len(first)))
    assert first[0]["original_row"] == {"full_text": long, "title": "T"}
    assert first[0]["prompt"] == (
        fixed.DEFAULT_INSTRUCTION + "\n\nTitle: T\n\nSource: my.data.csv\n\nText to analyze:\n" + first[0]["chunk_text"]
    )
    whole = chunk_rows(rows, max_chars=250, no_chunk=True).where("source_id = 'my.data_1'").collect()
    assert len(whole) == 1 and whole[0]["chunk_text"] == long.strip()


def test_rows_to_examples(spark):
    rows = _rows(spark, [
        {"title": "Given <i>title</i>", "full_text": "Some text that is long enough.", "output": "Result", "section": "never"},
        {"full_text": "A Title From The Text\nand then the body of it", "label": ""},
        {"text": "Alternative column text", "summary": "S", "title": "<b></b>"},
        {"title": "x", "full_text": "tiny", "text": "long enough but not looked at"},
        {"full_text": "", "content": "0123456789", "answer": "A", "title": "T"},
    ])
    found = rows_to_examples(rows, map_fields(), ("row_index",)).orderBy("row_index").collect()
    assert [(row["row_index"], row["input"], row["output"]) for row in found] == [
        (0, "Title: Given title\n\nText: Some text that is long enough.", "Result"),
        (1, "Title: A Title From The Text\n\nText: A Title From The Text\nand then the body of it", ""),
        (2, "Text: Alternative column text", "S"),
        (4, "Title: T\n\nText: 0123456789", "A"),
    ]
    only = rows_to_examples(rows, map_fields(), ("row_index",), filter_empty=True, instruction="Do it.")
    assert {(row["row_index"], row["instruction"]) for row in only.collect()} == {(i, "Do it.") for i in (0, 2, 4)}
    named = rows_to_examples(rows, map_fields(), ("row_index",), text_column="section").where("row_index = 0").first()
    assert named["input"].endswith("Some text that is long enough.")


def _texts(spark, records):
    rows = [("f.json", i, json.dumps(record)) for i, record in enumerate(records)]
    df = spark.createDataFrame(rows, "file string, row_index int, record string")
    return {row["row_index"]: (row["title"], row["text"]) for row in documents_of_records(df).collect()}


def test_record_text_steps(spark):
    nested = json.dumps({"z": "in  a nested string", "html": "<p>first</p>", "list": ["x", {"title": "t"}], "n": 1})
    long_a, long_b = "a" * 45, "b" * 45
    found = _texts(spark, [
        {"full_text": "x" * 21, "title": "T"},
        {"full_text": "x" * 20, "sections": [{"body": "Body text of the section", "title": "Head"}], "name": "N"},
        {"sections": nested},
        {"sections": json.dumps([nested])},
        {"sections": "[this is no json <b>at all</b>"},
        {"sections": "plain words are not looked at here", "other": long_a, "more": long_b, "n": 5},
        {"sections": [], "short": "s", "long": "  " + "c" * 41 + "<i></i>"},
        {"only": "short"},
        {"title": {"a": 1}, "text": "<p>" + "d" * 39 + "</p>"},
    ])
    assert found == {
        0: ("T", "x" * 21),
        1: ("N", "Head\n\nBody text of the section"),
        2: ("", "first\n\nin a nested string\n\nx\n\nt"),
        3: ("", "first\n\nin a nested string\n\nx\n\nt"),
        4: ("", "[this is no json at all"),
        5: ("", long_a),
        6: ("", "c" * 41),
    }


def test_documents_of_rows(spark):
    rows = _rows(spark, [
        {"name": "N", "full_text": None, "sections": '["one section text here", "two"]', "pad": None},
        {"title": "T", "full_text": "long enough for the first step"},
    ])
    found = {(row["title"], row["text"]) for row in documents_of_rows(rows).collect()}
    assert found == {("N", "one section text here\n\ntwo"), ("T", "long enough for the first step")}


def test_examples_from_documents(spark):
    documents = spark.createDataFrame(
        [("big_solution.txt", "big_solution", "Short text."), ("x.txt", None, "Sentence one. " * 200)],
        "file string, title string, text string",
    )
    rows = examples_from_documents(documents, max_chars=500).collect()
    one = next(row for row in rows if row["metadata"]["source_type"] == "solution")
    assert one["input"] == "Source file: big_solution.txt\nTitle: big_solution\n\nDocument:\nShort text."
    assert one["instruction"] == fixed.INSTRUCTION_BY_SOURCE_TYPE["solution"]
    assert one["output"] == "" and one["metadata"]["chunk_chars"] == 11
    rest = [row["metadata"] for row in rows if row["metadata"]["source_filename"] == "x.txt"]
    assert sorted(row["chunk_index"] for row in rest) == list(range(len(rest))) and len(rest) > 1
    assert all(row["title"] == "" and row["source_type"] == "unknown" for row in rest)


def test_chunk_text_is_evaluated_once(spark):
    """No filter that Catalyst infers or pushes may repeat the Python function."""
    rows = _rows(spark, [{"full_text": "text"}])
    plan = chunk_rows(rows).agg(F.count("*"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert plan.count("<[^>]+>") == len(fixed.CHUNK_TEXT_COLUMNS)


def test_text_nodes_of_rows_and_records(spark):
    markup = "<p>" + "long enough words " * 3 + "<b>end</b></p>"
    plain = ("long enough words " * 3).strip() + " \nend"
    rows = spark.createDataFrame([("a", 0, {"name": "n", "note": markup}), ("a", 1, {"note": None})], "file string, row_index int, row map<string,string>")
    assert [r["text"] for r in documents_of_rows(rows, "dom").collect()] == [plain]
    values = [{"note": markup}, {"sections": [{"html": markup}]}, {"sections": "[no json " + markup}]
    records = spark.createDataFrame([("a", i, json.dumps(v)) for i, v in enumerate(values)], "file string, row_index int, record string")
    found = {r["row_index"]: r["text"] for r in documents_of_records(records, "dom").collect()}
    assert found == {0: plain, 1: plain, 2: "[no json \n" + plain}
