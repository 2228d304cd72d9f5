"""The commands end to end, over files."""

import csv
import json
import re

import pytest

from corpusloom.cli import run
from corpusloom.plans.pipelines import NothingToDo, prepare_chunks


def _jsonl(folder):
    return [json.loads(line) for part in sorted(folder.glob("part*")) for line in part.read_text("utf-8").splitlines()]


def _csv(folder):
    rows = []
    for part in sorted(folder.glob("part*")):
        with part.open(encoding="utf-8", newline="") as file:
            rows += list(csv.DictReader(file))
    return rows


BODY = " ".join(f"Fact number {n} about topic{n} is told here." for n in range(120))


@pytest.fixture
def inputs(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    with (folder / "notes.csv").open("w", encoding="utf-8", newline="") as file:
        writer = csv.writer(file)
        writer.writerows([["title", "full_text", "label"], ["First", BODY, "L"], ["No", "short", ""], ["", "Some text\nover lines", ""]])
    return folder


def test_prepare_generate_merge_export(spark, inputs, tmp_path, capsys):
    out = {name: tmp_path / name for name in ("chunks", "results", "merged", "review", "picked")}
    assert run(spark, ["prepare", "--input_dir", str(inputs), "--output", str(out["chunks"]), "--max_chars", "1000"]) == 0
    chunks = _jsonl(out["chunks"])
    assert {row["source_id"] for row in chunks} == {"notes_0", "notes_2"}
    assert max(len(row["chunk_text"]) for row in chunks) <= 1000 and {row["original_row"]["label"] for row in chunks} == {"L", ""}

    once = ["prepare", "--input_file", str(inputs / "notes.csv"), "--output", str(tmp_path / "once"), "--max_chars", "1000", "--row_once"]
    assert run(spark, once) == 0
    assert all((row["original_row"] is not None) == (row["chunk_index"] == 0) for row in _jsonl(tmp_path / "once"))
    assert run(spark, ["generate", "--input", str(out["chunks"]), "--output", str(out["results"]), "--max_gen", "20"]) == 0
    results = _jsonl(out["results"])
    assert sum(row["generation_step"] == "final_summary" for row in results) == 2
    assert len(results) == len(chunks) + 2
    assert all(("final_summary" in row) == (row["generation_step"] == "final_summary") for row in results)

    assert run(spark, ["merge", "--input", str(out["results"]), "--output", str(out["merged"])]) == 0
    merged = _jsonl(out["merged"])
    assert [row["source_id"] for row in merged] == ["notes_0", "notes_2"] and "part" not in merged[0]
    assert merged[0]["original_row"]["title"] == "First" and merged[0]["processing_step"] == "merged"

    assert run(spark, ["export", "-i", str(out["merged"]), "-o", str(out["review"])]) == 0
    rows = _csv(out["review"])
    assert list(rows[0])[:2] == ["source_id", "merged_output"] and len(rows) == 2
    assert rows[0]["merged_output"] == merged[0]["final_summary"] and rows[0]["label"] == "L"
    assert run(spark, ["export", "-i", str(out["merged"]), "-o", str(out["picked"]), "--output-columns", "label, nope"]) == 0
    assert _csv(out["picked"])[0] == {"label": "L", "nope": ""}
    assert "'final_summaries': 2" in capsys.readouterr().out


def test_csv_conversion(spark, inputs, tmp_path, capsys):
    source = str(inputs / "notes.csv")
    assert run(spark, ["examples", "--csv", source, "--output", str(tmp_path / "a")]) == 0
    assert {row["output"] for row in _jsonl(tmp_path / "a")} == {"L", ""}
    assert run(spark, ["examples", "--input", source, "--output", str(tmp_path / "b"), "--filter-empty", "--instruction", "Go"]) == 0
    assert [(row["instruction"], row["output"]) for row in _jsonl(tmp_path / "b")] == [("Go", "L")]
    assert "Converted 2 entries (skipped 1)" in capsys.readouterr().out
    (inputs / "none.csv").write_text("full_text\nx\n")
    assert run(spark, ["examples", "--csv", str(inputs / "none.csv"), "--output", str(tmp_path / "c")]) == 0
    assert not (tmp_path / "c").exists()
    assert run(spark, ["prepare", "--input_file", str(inputs / "none.csv"), "--output", str(tmp_path / "d")]) == 0
    assert not (tmp_path / "d").exists()


def test_folder_to_examples_and_validation(spark, inputs, tmp_path, capsys):
    (inputs / "my_solution.txt").write_text("A text about a solution, long enough.")
    (inputs / "data.json").write_text(json.dumps([{"content": "c" * 900}, 5, {"a": "k" * 31, "b": 1}, {}, {"text": 7}, {"title": "sixth"}]))
    assert run(spark, ["validate", "--input_dir", str(inputs), "--max_examples", "2"]) == 0
    shown = capsys.readouterr().out
    assert "my_solution.txt (solution_platform)" in shown and "count: 6" in shown and "a: " + "k" * 31 not in shown
    assert run(spark, ["validate", "--input_dir", str(inputs)]) == 0
    assert "a: " + "k" * 31 in capsys.readouterr().out
    assert run(spark, ["validate", "--input_dir", str(inputs / "nowhere")]) == 2
    (inputs / "broken.json").write_text("{")
    assert run(spark, ["validate", "--input_dir", str(inputs)]) == 2
    assert run(spark, ["examples", "--input_dir", str(inputs), "--output", str(tmp_path / "x")]) == 0
    rows = _jsonl(tmp_path / "x")
    assert {row["metadata"]["source_type"] for row in rows} == {"solution", "unknown"}
    assert "failed to read broken.json" in capsys.readouterr().out


def test_review_and_tokens(spark, tmp_path):
    good = "Summary: s\nKey lessons: k\nRecommended actions: r"
    examples = [
        {"instruction": "i", "input": "in", "output": good, "metadata": {"generated_by": "m", "chunk_index": 0}},
        {"instruction": "i", "input": "in", "output": "nothing"},
        {"input": None, "output": good.upper()},
        {"instruction": "i", "input": "in"},
    ]
    source = tmp_path / "in.jsonl"
    source.write_text("\n\n".join(json.dumps(row) for row in examples))
    argv = ["review", "--input", str(source), "--review", str(tmp_path / "r"), "--train", str(tmp_path / "t"), "--emb-check"]
    assert run(spark, argv) == 0
    rows = _csv(tmp_path / "r")
    assert [row["idx"] for row in rows] == ["0", "1", "2", "3"] and rows[0]["generated_by"] == "m"
    train = _jsonl(tmp_path / "t")
    assert [row["output"] for row in train] == [good, good.upper()] and train[1]["instruction"] == ""
    assert [row["metadata"] for row in train] == [{"generated_by": "m", "chunk_index": 0}, {}]
    assert run(spark, ["review", "--input", str(source), "--review", str(tmp_path / "r2"), "--train", str(tmp_path / "t2"), "--sample", "1", "--required-headings", ""]) == 0
    assert len(_csv(tmp_path / "r2")) == 1 and len(_jsonl(tmp_path / "t2")) == 3
    assert run(spark, ["tokens", "--train_file", str(tmp_path / "t"), "--output", str(tmp_path / "k"), "--cutoff_len", "16"]) == 0
    tokens = spark.read.parquet(str(tmp_path / "k")).collect()
    assert len(tokens) == 2 and all(len(row["input_ids"]) == len(row["labels"]) <= 16 for row in tokens)
    argv = ["tokens", "--train_file", str(tmp_path / "t"), "--output", str(tmp_path / "p"), "--micro_batch_size", "2"]
    assert run(spark, argv) == 0
    assert len({len(row["labels"]) for row in spark.read.parquet(str(tmp_path / "p")).collect()}) == 1
    with pytest.raises(Exception, match="empty 'output'"):
        run(spark, ["tokens", "--train_file", str(source), "--output", str(tmp_path / "k2")])


def test_merge_needs_results(spark, tmp_path):
    (tmp_path / "none.jsonl").write_text("\n")
    with pytest.raises(NothingToDo):
        run(spark, ["merge", "--input", str(tmp_path / "none.jsonl"), "--output", str(tmp_path / "m")])


def test_chunks_come_in_order_and_sources_of_equal_names_stay_apart(spark, tmp_path):
    text = "long enough to be a text of its own"
    for folder, rows in (("a", 40), ("b", 3)):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "data.csv").write_text("full_text\n" + "".join(f"{text} {n}\n" for n in range(rows)))
    assert prepare_chunks(spark, str(tmp_path / "a"), str(tmp_path / "one")) == 40
    assert [row["source_id"] for row in _jsonl(tmp_path / "one")] == [f"data_{n}" for n in range(40)]
    assert prepare_chunks(spark, [str(tmp_path / "a"), str(tmp_path / "b")], str(tmp_path / "two")) == 43
    found = [row["source_id"] for row in _jsonl(tmp_path / "two")]
    assert len(set(found)) == 43 and all(re.fullmatch(r"data@[0-9a-f]{8}_\d+", name) for name in found)
