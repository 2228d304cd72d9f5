import csv
import json

from pyspark.sql import functions as F

from corpusloom.functions.models import WordCountEmbedder, embedder_or_none
from corpusloom.functions.similarity import cosine, jaccard
from corpusloom.operators.export import flatten_record, header_names, ordered_headers, output_field, parse_record, review_table
from corpusloom.operators.review import missing_headings, review_rows, score, split_list, training_records
from corpusloom.plans.pipelines import export_review

SCHEMA = "idx bigint, instruction string, input string, output string, metadata map<string,string>"
GOOD = "SUMMARY: a\nkey lessons: b\nRecommended Actions: c"


def test_missing_headings(evaluate):
    assert evaluate([GOOD, "Summary: only", None], missing_headings) == [
        [], ["Key lessons:", "Recommended actions:"], ["Summary:", "Key lessons:", "Recommended actions:"],
    ]
    assert evaluate(["anything"], lambda c: missing_headings(c, [])) == [[]]
    assert evaluate(["a.b (c"], lambda c: missing_headings(c, ["A.B", "(C", "a+b"])) == [["a+b"]]
    assert split_list(" a, ,b,") == ["a", "b"]


def _examples(spark):
    rows = [
        (0, "i" * 3000, "x" * 2500, GOOD + "z" * 600, {"generated_by": "m", "generated_at": "now"}),
        (1, None, "same words here", "", None),
        (2, "do", "same words here", GOOD + " same words here", {}),
        (3, "do", "nothing in common", "Summary: missing the rest", {}),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_review_rows(spark):
    rows = review_rows(score(_examples(spark))).orderBy("idx").collect()
    first = rows[0]
    assert len(first["instruction"]) == 2000 and len(first["input"]) == 2000
    # Cut to 500 characters first, then the two newlines become two characters each.
    assert len(first["output_preview"]) == 502 and "\n" not in first["output_preview"]
    assert (first["generated_by"], first["generated_at"], first["note_review_status"]) == ("m", "now", "")
    assert rows[1]["missing_headings"] == "Summary:;Key lessons:;Recommended actions:"
    assert [row["embedding_similarity"] for row in rows] == [""] * 4
    assert review_rows(score(_examples(spark)), sample=2).count() == 2
    bare = score(_examples(spark).drop("metadata"))
    assert {row["generated_by"] for row in review_rows(bare).collect()} == {""}


def test_gate(spark):
    scored = score(_examples(spark), load_embedder=WordCountEmbedder)
    values = {row["idx"]: row["similarity"] for row in scored.collect()}
    assert values[1] is None and values[2] > 0.3 and abs(values[0]) < 1e-9
    assert {row["output"] for row in training_records(scored, 0.18).collect()} == {GOOD + " same words here"}
    assert training_records(score(_examples(spark))).count() == 2
    assert training_records(scored.where("idx = 2"), values[2]).count() == 1
    shown = review_rows(scored).where("idx = 2").first()["embedding_similarity"]
    assert shown == f"{values[2]:.4f}"
    record = training_records(score(_examples(spark))).where("input like 'same%'").first()
    assert record.asDict() == {"instruction": "do", "input": "same words here", "output": GOOD + " same words here", "metadata": {}}


def test_missing_embedder_disables_the_check():
    def broken():
        raise ImportError("not here")

    assert embedder_or_none(broken) is None and embedder_or_none(WordCountEmbedder) is WordCountEmbedder


def test_similarities(spark):
    df = spark.createDataFrame([([1.0, 2.0], [2.0, 4.0], ["a", "b", "a"], ["b", "c"]), ([0.0], [1.0], [], [])],
                               "a array<float>, b array<float>, x array<string>, y array<string>")
    rows = df.select(cosine("a", "b").alias("c"), jaccard("x", "y").alias("j")).collect()
    assert abs(rows[0]["c"] - 1) < 1e-12 and abs(rows[0]["j"] - 1 / 3) < 1e-12
    assert rows[1]["c"] is None and rows[1]["j"] is None
    assert df.select(cosine("a", F.array(F.lit(1.0))).alias("c")).first()["c"] is None


def _flat(spark, records, strict=False):
    df = spark.createDataFrame([(i, json.dumps(r, ensure_ascii=False)) for i, r in enumerate(records)], "i int, r string")
    return [row["f"] for row in df.select("i", flatten_record("r", strict).alias("f")).orderBy("i").collect()]


def test_flatten_precedence(spark):
    records = [
        {"source_id": "s", "output": "O", "original_row": {"a": 1, "merged_output": "won", "n": None, "deep": {"é": [1]}}, "a": "lost", "z": True, "list": [1], "none": None},
        {"source_id": "s", "note": "first text", "other": 2.5, "original_row": {}, "metadata": {"source_id": "m"}},
        {"original_row": "raw", "generated": None},
        {"source_id": None, "original_row": [1, "x"], "metadata": {"k": "ignored"}},
        {"metadata": "", "x": ""},
        {"original_row": 0, "metadata": 5, "final_summary": ""},
    ]
    assert _flat(spark, records) == [
        {"source_id": "s", "merged_output": "won", "a": "1", "n": "", "deep": '{"é":[1]}', "z": "true"},
        {"source_id": "m", "merged_output": "first text", "other": "2.5"},
        {"merged_output": "", "original_row": "raw"},
        {"source_id": "", "merged_output": "", "original_row": '[1,"x"]'},
        {"merged_output": "", "original_row": "", "x": ""},
        {"merged_output": "", "original_row": "5"},
    ]


def test_empty_merged_summary(spark):
    merged = {"source_id": "s", "total_chunks": 2, "final_summary": "", "processing_step": "merged"}
    assert _flat(spark, [merged])[0]["merged_output"] == ""
    assert _flat(spark, [merged], strict=True)[0]["merged_output"] == "merged"


def test_output_field_order(spark):
    records = [{"completion": "c", "output": "o"}, {"metadata": "m", "n": 1, "t": "text"}, {"n": 1}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "i int, r string")
    rows = df.select("i", parse_record("r").alias("p")).select("i", output_field(F.col("p")).alias("f")).orderBy("i").collect()
    assert [row["f"] for row in rows] == ["output", "t", ""]


def test_headers_and_table(spark):
    records = [{"source_id": "1", "output": "a", "zeta": 1}, {"output": "b", "alpha": "x", "original_row": "r"}]
    df = spark.createDataFrame([(json.dumps(r),) for r in records], "r string").select(flatten_record("r").alias("flat"))
    names = [row[0] for row in header_names(df).collect()]
    assert ordered_headers(names) == ["source_id", "merged_output", "original_row", "alpha", "zeta"]
    assert review_table(df).columns == ordered_headers(names)
    assert {tuple(row) for row in review_table(df).collect()} == {("1", "a", "", "", "1"), ("", "b", "r", "x", "")}
    assert [tuple(row) for row in review_table(df, ["zeta", "absent"]).orderBy("zeta").collect()] == [("", ""), ("1", "")]


def test_records_are_exported_whole_or_rejected(spark, tmp_path):
    """Whether the session lets a variant repeat a key decides which of the two, never a part."""
    lines = ['{"output":"hello","m":{"a":1,"a":2},"note":"keep"}', '{"output":"x","note":"n"}', "[1", '{"output":" y ","k":[1,{"b":2}]}']
    (tmp_path / "in.jsonl").write_text("\n".join(lines) + "\n")
    for allowed, bad in (("true", [3]), ("false", [1, 3])):
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", allowed)
        try:
            count, rejects = export_review(spark, str(tmp_path / "in.jsonl"), str(tmp_path / allowed))
            assert sorted(row["line_number"] for row in rejects.collect()) == bad and count == 4 - len(bad)
        finally:
            spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
        rows = [row for part in sorted((tmp_path / allowed).glob("part*")) for row in csv.DictReader(part.open(encoding="utf-8", newline=""))]
        want = [{"merged_output": "x", "note": "n"}, {"merged_output": " y ", "note": ""}]
        assert rows == ([{"merged_output": "hello", "note": "keep"}] if allowed == "true" else []) + want


def test_export_of_more_keys_than_a_plan_has_columns(spark, tmp_path):
    rows = [{"source_id": f"s{n}", "output": 'line "one"\ntwo', "original_row": {f"key{n}_{k}": f"{k},x" for k in range(400)}} for n in range(40)]
    (tmp_path / "in.jsonl").write_text("\n".join(map(json.dumps, rows)))
    assert export_review(spark, str(tmp_path / "in.jsonl"), str(tmp_path / "out"))[0] == 40
    found = [row for part in sorted((tmp_path / "out").glob("part*")) for row in csv.DictReader(part.open(encoding="utf-8", newline=""))]
    names = sorted(f"key{n}_{k}" for n in range(40) for k in range(400))
    assert list(found[0]) == ["source_id", "merged_output", *names] and [row["source_id"] for row in found] == [f"s{n}" for n in range(40)]
    assert found[7]["merged_output"] == 'line "one"\ntwo' and found[7]["key7_3"] == "3,x" and found[7]["key8_3"] == ""
