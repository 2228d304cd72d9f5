import csv
import json
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from corpusloom.sources.csv_rows import read_csv_rows
from corpusloom.sources.directory import collect_documents
from corpusloom.sources.lines import parquet_ordinal, read_jsonl, read_jsonl_lenient, read_lines
from corpusloom.sources.sinks import write_jsonl, write_review_csv


def _csv(spark, path, **options):
    rows, rejects = read_csv_rows(spark, str(path), **options)
    assert rejects.count() == 0
    return [(row["file"], row["row_index"], row["row"]) for row in sorted(rows.collect(), key=lambda r: (r["file"], r["row_index"]))]


def test_csv_details(spark, tmp_path):
    (tmp_path / "a b.csv").write_bytes(
        b'\xef\xbb\xbf title , text \r\n T ,"two\r\nlines, ""quoted"" "\r\n\r\nshort\r\na,b,surplus\r\n'
    )
    (tmp_path / "LATIN.CSV").write_bytes("name;x\ncafé;1\n".replace(";", ",").encode("latin-1"))
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "other.txt").write_text("a,b\n1,2\n")
    assert _csv(spark, tmp_path) == [
        ("LATIN.CSV", 0, {"name": "café", "x": "1"}),
        ("a b.csv", 0, {"title": "T", "text": 'two\r\nlines, "quoted"'}),
        ("a b.csv", 1, {"title": "short", "text": ""}),
        ("a b.csv", 2, {"title": "a", "text": "b"}),
    ]
    raw = _csv(spark, tmp_path / "a b.csv", trim=False)
    assert raw[0][2] == {" title ": " T ", " text ": 'two\r\nlines, "quoted" '}
    assert raw[1][2] == {" title ": "short", " text ": None}


@contextmanager
def splits_of(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def plain_csv(path, encoding):
    """Rows as the csv module reads the whole file."""
    with path.open(encoding=encoding, newline="") as file:
        rows = csv.reader(file)
        names = next(rows, [])
        return [dict(zip(names, values + [None] * (len(names) - len(values)))) for values in rows if values]


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1"])
@pytest.mark.parametrize("size", [100, 1 << 10, 1 << 16])
def test_csv_bytes_read_the_same_whole_and_in_splits(spark, tmp_path, encoding, size):
    """Stray quotes, quotes inside plain fields, CR, LF, both, blank lines, a quoted header, fields over many splits."""
    pieces = ['"', "\n", "\r\n", "\r", ",", "é", '5" pipe', '"a,b"', "yy ", "", '"two\nlines"', '""', ',"', '",']
    for seed in range(4):
        rng = random.Random(seed)
        body = "".join(rng.choices(pieces, k=rng.choice([60, 8 * size]) if size < 5000 else 60_000))
        if seed % 2:  # mostly well-formed, with long quoted fields
            body = "".join(f'{n},"{"long line" + chr(10)}{"x" * rng.randint(0, 300)}{chr(10) * rng.randint(0, 5)}",é\n' for n in range(3 if size < 5000 else 600)) + body
        path = tmp_path / f"big{seed}.csv"
        path.write_bytes(('n,"quoted\n""name""",z\n' + body).encode(encoding))
    with splits_of(spark, size):
        found = _csv(spark, tmp_path, trim=False)
    for seed in range(4):
        path = tmp_path / f"big{seed}.csv"
        assert [(at, row) for file, at, row in found if file == path.name] == list(enumerate(plain_csv(path, encoding))), seed


def test_csv_record_over_many_splits(spark, tmp_path):
    """A field of many splits, and an open quote at the end with and without a line end."""
    field = "line of text\n" * 200
    for name, end in (("closed", '"\nlast,row\n'), ("open", "\n"), ("open_end", "x")):
        (tmp_path / f"{name}.csv").write_text(f'\ufeffa,b\n1,2\n3,"{field}{end}', "utf-8")
    with splits_of(spark, 100):
        found = _csv(spark, tmp_path, trim=False)
    last = [{"a": "last", "b": "row"}]
    for name, want in (("closed", [{"a": "3", "b": field}, *last]), ("open", [{"a": "3", "b": field + "\n"}]), ("open_end", [{"a": "3", "b": field + "x"}])):
        assert [row for file, _, row in found if file == f"{name}.csv"] == [{"a": "1", "b": "2"}, *want]
        assert [at for file, at, _ in found if file == f"{name}.csv"] == list(range(1 + len(want)))


def test_csv_of_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n" + "".join(f"{n},text {n}\n" for n in range(20_000)))
    with splits_of(spark, 1 << 12):
        rows, _ = read_csv_rows(spark, str(tmp_path))
        tasks = rows.groupBy(F.spark_partition_id()).count().count()
    assert tasks > 8


def _quoted_csv(path, rows, width):
    """Rows of a number and a text of several lines, all of about a size."""
    path.write_text("n,text\n" + "".join(f'{n},"{"line of text" + chr(10)}{"x" * width}"\n' for n in range(rows)))


@pytest.mark.parametrize("small", [1, 3, 8, 40, 150])
def test_csv_splits_are_the_same_whatever_small_files_are_beside(spark, tmp_path, small):
    """Small files make the splits of a scan longer: rows came twice, or the job ended with KeyError."""
    _quoted_csv(tmp_path / "one.csv", 2000, 30)
    _quoted_csv(tmp_path / "two.csv", 1500, 30)
    for k in range(small):
        _quoted_csv(tmp_path / f"small{k}.csv", 15, 30)
    with splits_of(spark, 1 << 20):
        spark.conf.set("spark.sql.files.openCostInBytes", "2000")
        found = _csv(spark, tmp_path)
    for name, rows in [("one", 2000), ("two", 1500), *((f"small{k}", 15) for k in range(small))]:
        assert [(at, row["n"]) for file, at, row in found if file == f"{name}.csv"] == [(n, str(n)) for n in range(rows)], name


@pytest.mark.parametrize(("before", "after"), [(2, 3), (3, 2), (2, 16)])
def test_csv_splits_stay_when_cores_come_or_go(spark, tmp_path, before, after):
    """Executors that came between the pass over large files and their parsing ended the job with KeyError."""
    _quoted_csv(tmp_path / "one.csv", 2000, 30)
    (tmp_path / "open.csv").write_text("a,b\n" + "1,2\n" * 20_000 + '3,"open')
    try:
        with splits_of(spark, 1 << 20):
            spark.conf.unset("spark.sql.files.minPartitionNum")
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", before)
            rows, rejects = read_csv_rows(spark, str(tmp_path))
            spark.conf.set("spark.sql.leafNodeDefaultParallelism", after)
            found = sorted((row["file"], row["row_index"], row["row"].get("n"), row["row"].get("b")) for row in rows.collect())
            assert rejects.count() == 0
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert found == [("one.csv", n, str(n), None) for n in range(2000)] + [("open.csv", n, None, "2") for n in range(20_000)] + [("open.csv", 20_000, None, "open")]


def test_csv_small_files_leave_the_sessions_splits_alone(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    spark.conf.unset("spark.sql.files.minPartitionNum")
    assert len(_csv(spark, tmp_path)) == 1 and spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_csv_header_longer_than_a_split_is_told(spark, tmp_path):
    (tmp_path / "wide.csv").write_text('"' + "name\n" * 100 + '",b\n1,2\n')
    with splits_of(spark, 100):
        rows, rejects = read_csv_rows(spark, str(tmp_path))
        assert rows.count() == 0 and [tuple(r) for r in rejects.collect()] == [("wide.csv", "CSV read error: the header is longer than a split")]
    assert _csv(spark, tmp_path) == [("wide.csv", 0, {("name\n" * 100).strip(): "1", "b": "2"})]


def test_csv_with_carriage_returns(spark, tmp_path):
    (tmp_path / "old.csv").write_bytes(b"a,b\r1,2\r3,4\r")
    assert [row for _, _, row in _csv(spark, tmp_path / "old.csv")] == [{"a": "1", "b": "2"}, {"a": "3", "b": "4"}]


def test_lines_are_numbered_across_splits(spark, tmp_path):
    lines = [f"line {n}" if n % 7 else "" for n in range(500)]
    (tmp_path / "a.jsonl").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.jsonl").write_text("x\ny")
    with splits_of(spark, 400):
        df = read_lines(spark, str(tmp_path))
        rows = sorted(df.collect(), key=lambda row: row["ordinal"])
        unnumbered = read_lines(spark, str(tmp_path), numbered=False).orderBy("ordinal").collect()
    assert [row["value"] for row in rows] == [row["value"] for row in unnumbered] == [*lines, "x", "y"]
    assert [row["ordinal"] for row in rows] == list(range(502))
    assert [row["line_number"] for row in rows] == [*range(1, 501), 1, 2]


def test_jsonl_readers(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text('{"a":"1"}\n\n  \n{"a":"2","b":3}\n')
    rows = read_jsonl(spark, str(path), "a string, b int", numbered=True).orderBy("ordinal").collect()
    assert [tuple(row) for row in rows] == [("1", None, 0), ("2", 3, 1)]
    rows = read_jsonl(spark, str(path), "a string, b int").orderBy("ordinal").collect()
    assert [(row["a"], row["b"]) for row in rows] == [("1", None), ("2", 3)]
    path.write_text('{"a":"1"}\n\n{"a":\n{"a":"2"}}\n"text"\n')
    records, rejects = read_jsonl_lenient(spark, str(path))
    assert [row["record"] for row in records.orderBy("ordinal").collect()] == ['{"a":"1"}', '"text"']
    assert {row["line_number"] for row in rejects.collect()} == {3, 4}
    for bad in ('{"a":"1"}\n{"a":', '{"a":"1"}}', '{"a":"1"}]', '{"a":"1"} {"a":"2"}', '{"a":"1"},{"a":"2"}', "words"):
        path.write_text(bad + "\n")
        with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
            read_jsonl(spark, str(path), "a string").select("a").collect()


def test_parquet_ordinal(spark, tmp_path):
    spark.range(1000).repartition(3).write.parquet(str(tmp_path / "t"))
    df = parquet_ordinal(spark.read.parquet(str(tmp_path / "t")))
    assert sorted(row["ordinal"] for row in df.collect()) == list(range(1000))


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "é\n\"q\"", None), (2, "", "x,y")], "n int, t string, u string")
    write_jsonl(df, str(tmp_path / "j"), order_by=["n"])
    lines = [line for part in sorted((tmp_path / "j").glob("part*")) for line in part.read_text("utf-8").splitlines()]
    assert [json.loads(line) for line in lines] == [{"n": 1, "t": 'é\n"q"', "u": None}, {"n": 2, "t": "", "u": "x,y"}]
    write_review_csv(df.coalesce(1), str(tmp_path / "c"), order_by=["n"])
    found = []
    for part in sorted((tmp_path / "c").glob("part*")):
        with part.open(encoding="utf-8", newline="") as file:
            found += list(csv.DictReader(file))
    assert found == [{"n": "1", "t": 'é\n"q"', "u": ""}, {"n": "2", "t": "", "u": "x,y"}]


def test_folder_of_everything(spark, tmp_path):
    text = "long enough to be a document of its own"
    (tmp_path / "a list.json").write_text(json.dumps([{"title": "L", "full_text": text}, "no record", {"full_text": "short"}]))
    (tmp_path / "wrapped.JSON").write_text(json.dumps({"n": 1, "items": [{"name": "W", "full_text": text}], "later": [{"full_text": "no " * 20}]}))
    (tmp_path / "single.json").write_text(json.dumps({"full_text": text}))
    (tmp_path / "broken.json").write_text("{")
    (tmp_path / "scalar.json").write_text("5")
    (tmp_path / "lines.jsonl").write_text(json.dumps({"full_text": text, "title": "1"}) + "\n{bad\n" + json.dumps({"text": "t" * 41}) + "\n")
    (tmp_path / "repeated.jsonl").write_text('{"m":{"a":1,"a":2},"full_text":"' + text + '"}\n[1]\n"bare"\n')
    (tmp_path / "rows.csv").write_text(f"title,full_text\nC,{text}\nD,short\n")
    (tmp_path / "my notes+1%20.md").write_text("# Notes\r\n\r\nwith a body of text")
    (tmp_path / "no_suffix").write_text("also read as a text file")
    (tmp_path / "tiny.txt").write_text("tiny")
    (tmp_path / "image.png").write_bytes(b"\x89PNG\xff\xfe" * 10)
    (tmp_path / "bad.txt").write_bytes("café au lait et croissants".encode("latin-1"))
    (tmp_path / "inner").mkdir()
    (tmp_path / "inner" / "deep.txt").write_text("files in folders inside are not read")
    documents, rejects = collect_documents(spark, str(tmp_path))
    assert {(row["file"], row["title"], row["text"]) for row in documents.collect()} == {
        ("a list.json", "L", text),
        ("wrapped.JSON", "W", text),
        ("single.json", "", text),
        ("lines.jsonl", "1", text),
        ("lines.jsonl", "", "t" * 41),
        ("repeated.jsonl", "", text),
        ("rows.csv", "C", text),
        ("my notes+1%20.md", "my notes+1%20", "# Notes\n\nwith a body of text"),
        ("no_suffix", "no_suffix", "also read as a text file"),
    }
    assert {row["file"] for row in rejects.collect()} == {"a list.json", "broken.json", "scalar.json", "lines.jsonl", "repeated.jsonl", "image.png", "bad.txt"}
    assert rejects.where(F.col("file") == "repeated.jsonl").count() == 2
    assert rejects.where(F.col("file") == "lines.jsonl").first()["error"] == "invalid JSON in line 2"


def test_half_a_surrogate_pair_disturbs_no_other_file(spark, tmp_path):
    """Such a JSON file ended the job; it reads as such a line does, and whole pairs beside it stay."""
    text = "half a pair \\ud83d and a whole one \\ud83d\\ude00 in a text"
    (tmp_path / "odd.json").write_text('[{"title": "odd", "full_text": "' + text + '"}]')
    (tmp_path / "odd.jsonl").write_text('{"title": "line", "full_text": "' + text + '"}\n')
    (tmp_path / "good.json").write_text(json.dumps({"title": "good", "full_text": "long enough to be a document of its own"}))
    documents, rejects = collect_documents(spark, str(tmp_path))
    found = {row["title"]: row["text"] for row in documents.collect()}
    assert found.keys() == {"odd", "line", "good"} and rejects.count() == 0
    assert found["odd"] == found["line"] and "😀" in found["odd"]
