import json
import os
import random
import re
import sys
from functools import partial
from uuid import uuid4

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from corpusloom.functions.models import LeadGenerator, RetryingGenerator, model_name_or_default
from corpusloom.operators.generation import answers, run_statistics, summarize_chunks, summarize_hierarchically
from corpusloom.operators.groups import collect_ordered, final_prompts
from corpusloom.operators.merging import merge_results, merge_statistics, record_pieces
from corpusloom.plans.pipelines import RESULT_SCHEMA
from corpusloom.sources.sinks import write_long_records
from tests import brute_force

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _results(spark, rows):
    names = [field.name for field in spark.createDataFrame([], RESULT_SCHEMA).schema]
    full = [tuple(row.get(name) for name in names) + (at,) for at, row in enumerate(rows)]
    return spark.createDataFrame(full, RESULT_SCHEMA + ", ordinal bigint")


def _chunk(source, index, text, title="t"):
    row = (source, index, None, None, None, {"title": title})
    return {"source_id": source, "generation_step": "chunk_summary", "chunk_index": index, "chunk_summary": text, "original_chunk": row}


def _final(source, text, **more):
    return {"source_id": source, "generation_step": "final_summary", "final_summary": text, **more}


def test_merge_rules(spark):
    rows = [
        _final("both", "First final text is here.", total_chunks=2, chunk_summaries=["x"], source_metadata={"title": "m"}),
        _chunk("both", 0, "Chunk text is not used."),
        _final("both", "Last final text wins. last final text wins!", total_chunks=3, chunk_summaries=["y"], source_metadata={}),
        _chunk("chunks", 2, "Third part of the text."),
        _chunk("chunks", None, "First part of the text.", "first"),
        _chunk("chunks", 1, "Error: second part failed"),
        _final("empty", "", total_chunks=9, chunk_summaries=["z"], source_metadata={"title": "m"}),
        _chunk("empty", 0, "Error: only part failed", "own"),
        _final("bare", None, total_chunks=4),
        _chunk(None, 0, "A chunk without a source."),
        {"source_id": "other", "generation_step": "something"},
    ]
    found = {row["source_id"]: row for row in merge_results(_results(spark, rows)).collect()}
    assert set(found) == {"both", "chunks", "empty", "bare", "unknown"}
    both = found["both"]
    assert (both["final_summary"], both["total_chunks"], both["chunk_summaries"]) == ("Last final text wins.", 3, ["y"])
    assert both["source_metadata"] == {} and both["original_row"] is None and both["part"] is None
    chunks = found["chunks"]
    assert chunks["final_summary"] == "First part of the text. Third part of the text."
    assert chunks["chunk_summaries"] == ["First part of the text.", "Error: second part failed", "Third part of the text."]
    assert chunks["total_chunks"] == 3 and chunks["original_row"] == {"title": "first"}
    assert found["empty"]["final_summary"] == "Error: only part failed."
    assert found["empty"]["original_row"] == {"title": "own"}
    assert (found["bare"]["final_summary"], found["bare"]["total_chunks"]) == ("", 4)
    stats = merge_statistics(merge_results(_results(spark, rows))).first()
    assert tuple(stats) == (12, 5, 3)


def test_one_source_with_a_third_of_all_rows(spark):
    """The oversized source comes in parts; joined in order they are what one row would hold."""
    rng = random.Random(5)
    rows = []
    for n in range(300):
        source = "hot" if n % 3 == 0 else f"s{n % 60}"
        text = ". ".join(brute_force.random_sentences(rng, 3, 9)) + "."
        rows.append(_chunk(source, n, rng.choice([text, text, "Error: " + text])))
    results = _results(spark, rows).repartition(6)
    whole = {row["source_id"]: row for row in merge_results(results).collect()}
    split = merge_results(results, whole=False).collect()
    parts = sorted((row for row in split if row["part"] is not None), key=lambda row: row["part"])
    assert len(parts) == len(split) and {row["source_id"] for row in parts} == set(whole)
    for source, record in whole.items():
        mine = [row for row in parts if row["source_id"] == source]
        assert " ".join(row["final_summary"] for row in mine if row["final_summary"]) == record["final_summary"]
        assert [text for row in mine for text in row["chunk_summaries"]] == record["chunk_summaries"]
    assert merge_statistics(merge_results(results, whole=False)).first() == merge_statistics(merge_results(results)).first()


def test_records_are_written_piece_by_piece(spark, tmp_path):
    """Lines of any length, with nothing gathered: the same records as whole rows, in order of source."""
    rng = random.Random(6)
    rows = [_chunk("long", n, rng.choice(['Said "no" in part %d\\of it.', "Line\nbreak and é in part %d.", "Error: part %d failed"]) % n if n % 9 else "", "T") for n in range(400)]
    rows += [_chunk(f"s{n % 7}", n, f"Own text number {n} of the many. {n} apples and {n} pears here.") for n in range(40)]
    rows += [_chunk("failed", n, "Error: it failed") for n in range(3)] + [_final("done", "Final text of the source.", total_chunks=5, source_metadata={"a": "b"})]
    results = _results(spark, rows).repartition(5)
    parts = merge_results(results, whole=False)
    pieces = record_pieces(parts)
    write_long_records(pieces, str(tmp_path / "out"), "source_id", ["section", "part"])
    text = [p.read_text("utf-8") for p in sorted((tmp_path / "out").glob("part*"))]
    lines = [json.loads(line) for part in text for line in part.split("\n") if line]
    want = {row["source_id"]: row.asDict() for row in merge_results(results).drop("part").collect()}
    assert [line["source_id"] for line in lines] == sorted(want) and len(lines) == 10
    for line in lines:
        assert line == {k: v for k, v in want[line["source_id"]].items() if v is not None}
    written = pieces._jdf.queryExecution().executedPlan().toString()
    assert "collect_list(struct(part" not in written and "collect_list(struct(at" not in written


def test_whole_records_are_joined_parts(spark):
    """No task removes the sentences of a whole source: the record is put together from de-duplicated parts."""
    rows = [_chunk("a", n, f"Chunk number {n} of this. The same sentence every time.") for n in range(6)]
    merged = merge_results(_results(spark, rows).repartition(3))
    assert "_list_udf" not in merged._jdf.queryExecution().toString()
    [row] = merged.collect()
    assert row["part"] is None and row["total_chunks"] == 6 == len(row["chunk_summaries"])
    assert row["final_summary"].count("The same sentence every time.") == 1


def test_oversized_source_with_a_final_result(spark):
    rows = [_chunk("a", n, f"Chunk number {n} of this.") for n in range(5)] + [_final("a", "Final text of the source.", total_chunks=5)]
    [row] = merge_results(_results(spark, rows), whole=False).collect()
    assert row["final_summary"] == "Final text of the source." and row["part"] is None


def _summaries(spark, rows):
    schema = "source_id string, chunk_index int, ordinal bigint, chunk_summary string, title string, source_filename string"
    return spark.createDataFrame(rows, schema)


def test_final_prompts_whole_and_in_lines(spark):
    rows = [("s", 1, 1, "second", "T", "f.csv"), ("s", 0, 0, "Error: no", "X", "x"), ("s", None, 2, "first", "", "f.csv"), ("t", 0, 3, "only", "T", "")]
    prompts = {row["source_id"]: row["prompt"] for row in final_prompts(_summaries(spark, rows)).collect()}
    assert "Section 1: first\n\nSection 2: second\n\nUnified Summary:" in prompts["s"]
    assert "Source: f.csv\n\nSection summaries" in prompts["s"] and "Document Title" not in prompts["s"]
    assert "Document Title: T\n\nSection summaries to merge:\nSection 1: only" in prompts["t"]
    lines = final_prompts(_summaries(spark, rows), whole=False).where("source_id = 's'").orderBy("part").collect()
    opening, *sections, closing = [row["prompt"] for row in lines]
    assert opening + "\n" + "\n\n".join(sections) + "\n" + closing == prompts["s"]


def test_collect_ordered_in_parts(spark):
    rows = [("s", n // 2, n, f"text {n}", "", "") for n in range(9)]
    df = _summaries(spark, rows).repartition(4)
    [whole] = collect_ordered(df, "chunk_summary").collect()
    parts = collect_ordered(df, "chunk_summary", whole=False).orderBy("part").collect()
    assert whole["texts"] == [text for row in parts for text in row["texts"]] == [f"text {n}" for n in range(9)]


class Failing:
    def generate(self, prompt, max_new_tokens):
        if "fail" in prompt:
            raise RuntimeError("model refused")
        return prompt.split("\n")[-1][:max_new_tokens]


def _chunk_records(spark):
    rows = [
        ("a", 0, 2, "p\nfirst chunk", "c", {"title": "T"}, 0),
        ("a", 1, 2, "p\nfail", "c", {"title": "U"}, 1),
        ("b", 0, 1, "p\nfail", "c", {}, 2),
        ("c", None, 1, None, "chunk only", None, 3),
    ]
    schema = (
        "source_id string, chunk_index int, total_chunks int, prompt string, chunk_text string, "
        "original_row map<string,string>, ordinal bigint"
    )
    return spark.createDataFrame(rows, schema)


def test_hierarchical_generation(spark):
    results = summarize_hierarchically(_chunk_records(spark), Failing, max_gen=20)
    rows = results.collect()
    chunks = {(row["source_id"], row["chunk_index"]): row for row in rows if row["generation_step"] == "chunk_summary"}
    assert chunks["a", 0]["chunk_summary"] == "first chunk" and chunks["a", 0]["total_chunks"] == 2
    assert chunks["a", 1]["chunk_summary"] == "Error: model refused" and chunks["a", 1]["total_chunks"] is None
    assert chunks["c", 0]["chunk_summary"] == "chunk only"
    finals = {row["source_id"]: row for row in rows if row["generation_step"] == "final_summary"}
    assert set(finals) == {"a", "c"}
    assert finals["a"]["chunk_summaries"] == ["first chunk", "Error: model refused"]
    assert finals["a"]["total_chunks"] == 2 and finals["a"]["final_summary"] == "Unified Summary:"
    assert finals["a"]["source_metadata"] == {"title": "T", "source_filename": ""}
    assert tuple(run_statistics(results).first()) == (2, 4)
    merged = {row["source_id"] for row in merge_results(results.withColumn("ordinal", F.coalesce("ordinal", F.lit(0)))).collect()}
    assert merged == {"a", "b", "c"}


@pytest.mark.parametrize("fan_in", [2, 3, 40, 1000])
def test_every_source_gets_a_final_result_at_any_fan_in(spark, fan_in):
    rows = [(f"s{n % 11}", n // 11, 4, f"prompt {n}", f"text {n}", {"title": "T"}, n) for n in range(440)]
    schema = "source_id string, chunk_index int, total_chunks int, prompt string, chunk_text string, original_row map<string,string>, ordinal bigint"
    results = summarize_hierarchically(spark.createDataFrame(rows, schema), LeadGenerator, fan_in=fan_in)
    finals = results.where("generation_step = 'final_summary'").collect()
    assert len(finals) == 11 and {row["total_chunks"] for row in finals} == {40}
    assert all(row["final_summary"] and len(row["chunk_summaries"]) <= fan_in for row in finals)


class Sections:
    """Tells how many summaries the final prompt holds."""

    def generate(self, prompt, max_new_tokens):
        found = re.findall(r"^Section \d+: ", prompt, re.MULTILINE)
        return f"{len(found)} sections" if found else prompt


def test_number_of_chunks_changes_no_result(spark):
    """A source of 1,001 chunks keeps every summary and gets one prompt, like one of two chunks."""
    rows = [(source, n, total, f"p{n}", "c", {}, n) for source, total in (("long", 1001), ("short", 2)) for n in range(total)]
    schema = "source_id string, chunk_index int, total_chunks int, prompt string, chunk_text string, original_row map<string,string>, ordinal bigint"
    results = summarize_hierarchically(spark.createDataFrame(rows, schema), Sections)
    finals = {row["source_id"]: row for row in results.where("generation_step = 'final_summary'").collect()}
    for source, total in (("long", 1001), ("short", 2)):
        assert finals[source]["chunk_summaries"] == [f"p{n}" for n in range(total)]
        assert (finals[source]["final_summary"], finals[source]["total_chunks"]) == (f"{total} sections", total)
    merged = merge_results(results.withColumn("ordinal", F.coalesce("ordinal", F.lit(0))))
    assert {row["source_id"]: len(row["chunk_summaries"]) for row in merged.collect()} == {"long": 1001, "short": 2}


class Counted:
    """Writes every prompt it is asked to a file of its own; breaks its task at a word, if told to."""

    def __init__(self, folder, poison=None):
        self.folder, self.poison = folder, poison

    def generate(self, prompt, max_new_tokens):
        if self.poison and self.poison in prompt:
            os._exit(1)
        with open(f"{self.folder}/{uuid4()}", "w") as file:
            file.write(prompt)
        return f"answer to {prompt}"


def test_a_broken_run_goes_on_without_a_second_call(spark, tmp_path):
    rows = [(f"s{n % 9}", n, 1, f"prompt {n % 60}", "c", {"title": "T"}, n) for n in range(120)]
    schema = "source_id string, chunk_index int, total_chunks int, prompt string, chunk_text string, original_row map<string,string>, ordinal bigint"
    chunks, ledger = spark.createDataFrame(rows, schema).repartition(3), str(tmp_path / "ledger")
    first, second = tmp_path / "first", tmp_path / "second"
    first.mkdir(), second.mkdir()
    with pytest.raises(Exception, match="crashed|exited"):
        answers(chunks.select("prompt"), partial(Counted, str(first), "prompt 37"), 20, ledger)
    done = {row["text"] for row in spark.read.schema("text string").parquet(ledger).collect()}
    told = answers(chunks.select("prompt"), partial(Counted, str(second)), 20, ledger)
    assert {row["answer"]["text"] for row in told.collect()} == {f"answer to prompt {n}" for n in range(60)} and told.count() == 60
    asked = [path.read_text() for path in second.iterdir()]
    assert sorted(asked) == sorted({f"prompt {n}" for n in range(60)} - {text.removeprefix("answer to ") for text in done})
    third = tmp_path / "third"
    third.mkdir()
    results = summarize_hierarchically(chunks, partial(Counted, str(third)), 20, ledger=ledger)
    found = results.where("generation_step = 'chunk_summary'").collect()
    assert len(found) == 120 and all(row["chunk_summary"] == f"answer to {row['original_chunk']['prompt']}" for row in found)
    assert not any(path.read_text().startswith("prompt") for path in third.iterdir())


def test_generated_text_is_not_made_twice(spark):
    plan = summarize_chunks(_chunk_records(spark), LeadGenerator).where("chunk_summary <> ''")
    assert plan._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


class Flaky:
    def __init__(self, *errors):
        self.errors, self.calls = list(errors), 0

    def generate(self, prompt, max_new_tokens):
        self.calls += 1
        if self.errors:
            raise RuntimeError(self.errors.pop(0))
        return "fine"


def test_retries():
    waits = []
    flaky = Flaky("Connection lost", "timeout")
    assert RetryingGenerator(flaky, sleep=waits.append).generate("p") == "fine"
    assert flaky.calls == 3 and 1 <= waits[0] <= 2 and 2 <= waits[1] <= 3
    broken = Flaky("bad key", "bad key")
    assert RetryingGenerator(broken, sleep=waits.append).generate("p") == "Error: bad key" and broken.calls == 1
    tired = Flaky(*["timeout"] * 9)
    assert RetryingGenerator(tired, LeadGenerator(), sleep=waits.append).generate("two words", 1) == "two"
    assert tired.calls == 3
    assert RetryingGenerator(Flaky(), max_retries=0).generate("p").startswith("Error: Generation failed")


def test_model_name_order(monkeypatch):
    monkeypatch.delenv("HF_FALLBACK_MODEL", raising=False)
    assert model_name_or_default() == "gpt2"
    monkeypatch.setenv("HF_FALLBACK_MODEL", "from-env")
    assert model_name_or_default() == "from-env" and model_name_or_default("given") == "given"
