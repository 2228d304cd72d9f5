import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from corpusloom.functions.nested import is_json, nested_texts, response_text
from corpusloom.functions.prompts import build_prompt, fallback_chunk_prompt, summarize_prompt
from corpusloom.functions.tokens import PythonTokenizer, hashed_words, token_budget
from corpusloom.operators.training import empty_outputs, load_examples, pad_batches, require_outputs, tokenize_examples
from corpusloom.plans.pipelines import write_tokens
from corpusloom.sources.sinks import RuleBroken


def characters():
    return lambda text: [ord(char) for char in text]


cloudpickle.register_pickle_by_value(sys.modules[__name__])
TOKENIZER = PythonTokenizer(characters)


def test_response_shapes(evaluate):
    responses = [
        '"  direct  "', "plain text ", '{"choices":[{"message":{"content":" chat "}}]}', '{"choices":[{"text":"old"}],"text":"no"}',
        '{"response":"r","text":"t"}', '{"generated_text":"g"}', '{"text":"t","content":"c"}', '{"content":"c"}', '{"output":"o"}',
        '{"result":"r"}', '{"response":"  ","text":"t"}', '{"response":null,"text":"t"}', '{"response":5}', "{}", "[]", '"  "', "", None,
        '[{"other":1},[[{"text":"deep"}]],"late"]', '{"choices":[],"response":"r"}', '{"choices":[{}],"output":"o"}',
        '{"choices":[{"message":{}, "text":"x"}]}', '[null,""," s "]',
    ]
    assert evaluate(responses, response_text) == [
        "direct", "plain text", "chat", "old", "r", "g", "t", "c", "o", "r", None, None, None, None, None, None, None, None,
        "deep", "r", "o", "x", "s",
    ]


def test_json_validity(evaluate):
    values = ['{"a":1}', '{"a":1}}', '{"a":1}]', "1,2", "1],[2", '1},{"x":2', '{"a":', "null", '{"a":1} {"b":2}', "{'a':1}", '{"a":1,"a":2}']
    assert evaluate(values, is_json) == [True, False, False, False, False, False, False, True, False, False, True]


def test_nested_texts(evaluate):
    deep = '{"b":"' + "x" * 50 + '","a":{"text":"<i>t</i>","title":"h"}}'
    values = [deep, '["", " ", null, 3, true, "k"]', "{bad", "5", '{"zz":"last","txt":"first","body":""}', None]
    assert evaluate(values, nested_texts) == [["x" * 50, "t", "h"], ["k"], None, [], ["first", "last"], None]
    assert evaluate(['["a &amp; b"]'], lambda c: nested_texts(c, "dom")) == [["a & b"]]


def test_prompts(spark):
    df = spark.createDataFrame([("do", "it"), (None, None)], "instruction string, input string")
    rows = df.select(build_prompt("instruction", "input").alias("p"), build_prompt("instruction", "input", "{{x}} {input}:{instruction}").alias("q")).collect()
    assert rows[0]["p"] == "### Instruction:\ndo\n\n### Input:\nit\n\n### Response:\n" and rows[0]["q"] == "{x} it:do"
    assert rows[1]["p"] == "### Instruction:\n\n\n### Input:\n\n\n### Response:\n" and rows[1]["q"] == "{x} :"
    others = df.select(fallback_chunk_prompt(F.lit(""), "input").alias("f"), summarize_prompt("input").alias("s")).first()
    assert others["f"].endswith("concisely:\n\nit") and others["s"].endswith("\n\nit\n\nSummary:")


def _examples(spark, rows):
    return spark.createDataFrame(rows, "idx int, instruction string, input string, output string")


def test_masks(spark):
    examples = _examples(spark, [(0, "a", "b", "answer"), (1, "a", "b", None)])
    prompt = len("### Instruction:\na\n\n### Input:\nb\n\n### Response:\n")
    rows = tokenize_examples(examples, TOKENIZER, keep=("idx",)).orderBy("idx").collect()
    ids = [ord(char) for char in "answer"]
    assert rows[0]["labels"] == [-100] * prompt + ids and rows[0]["input_ids"][prompt:] == ids
    assert rows[0]["attention_mask"] == [1] * (prompt + 6)
    assert rows[1]["labels"] == [-100] * prompt
    tail = tokenize_examples(examples, TOKENIZER, response_max=2, keep=("idx",)).orderBy("idx").first()
    assert tail["labels"] == [-100] * (prompt + 4) + ids[-2:]
    cut = tokenize_examples(examples, TOKENIZER, max_length=prompt + 3).first()
    assert cut["labels"] == [-100] * prompt + ids[:3]
    short = tokenize_examples(examples, TOKENIZER, max_length=10).first()
    assert short["labels"] == [-100] * 10


def test_padding(spark):
    examples = _examples(spark, [(n, "i", "x" * n, "y") for n in range(5)])
    tokens = tokenize_examples(examples, TOKENIZER, keep=("idx",))
    rows = pad_batches(tokens, 2, pad_id=7).orderBy("idx").collect()
    sizes = [len(row["input_ids"]) for row in rows]
    assert sizes == [sizes[1], sizes[1], sizes[3], sizes[3], sizes[4]] and [row["batch_id"] for row in rows] == [0, 0, 1, 1, 2]
    assert rows[0]["input_ids"][-1] == 7 and rows[0]["labels"][-1] == -100 and rows[0]["attention_mask"][-1] == 0
    left = pad_batches(tokens, 2, pad_id=7, side="left").orderBy("idx").first()
    assert left["input_ids"][0] == 7 and left["attention_mask"][0] == 0 and left["labels"][-1] == -100


def test_budget(spark):
    rows = spark.createDataFrame([(100, 50, 20), (100, 90, 20), (100, 100, 20), (100, 500, 80), (None, 9, 20), (0, 9, 20), (1, 5, 3)], "m int, n int, k int")
    kept, allowed = token_budget("m", "n", "k")
    found = [tuple(row) for row in rows.select(kept.alias("a"), allowed.alias("b")).collect()]
    assert found == [(50, 20), (90, 10), (80, 20), (50, 50), (9, 20), (9, 20), (1, 1)]


def test_hashed_words(evaluate):
    [ids] = evaluate([" one two  one "], hashed_words)
    assert len(ids) == 3 and ids[0] == ids[2] and all(0 <= value < 2**28 for value in ids)


def test_output_guards(spark):
    examples = load_examples(spark.createDataFrame([("a",), (None,)], "output string"))
    assert examples.columns == ["output", "instruction", "input"]
    assert empty_outputs(examples).first()[0] == 1
    with pytest.raises(Exception, match="empty 'output'"):
        require_outputs(examples).collect()
    assert require_outputs(examples.where("output <> ''")).count() == 1


def test_tokens_are_published_only_if_all_outputs_are_there(spark, tmp_path):
    schema = "ordinal int, instruction string, input string, output string"
    rows = [(n, "i", "in", "out" if n % 3 else [None, "", "  "][n // 3 % 3]) for n in range(30)]
    examples, folder = spark.createDataFrame(rows, schema).repartition(4), tmp_path / "tokens"
    with pytest.raises(RuleBroken, match="Found 7 examples with empty 'output'"):
        write_tokens(examples, str(folder), hashed_words, 16)
    assert list(tmp_path.iterdir()) == []
    assert write_tokens(examples.where("output <> ''"), str(folder), hashed_words, 16) == 23
    with pytest.raises(RuleBroken):
        write_tokens(examples, str(folder), hashed_words, 16)
    kept = spark.read.parquet(str(folder))
    assert kept.count() == 23 and kept.columns == ["ordinal", "input_ids", "attention_mask", "labels"]
    broken = examples.where("output = 'out'").withColumn("output", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        write_tokens(broken, str(folder), hashed_words, 16)
    assert [path.name for path in tmp_path.iterdir()] == ["tokens"] and spark.read.parquet(str(folder)).count() == 23
