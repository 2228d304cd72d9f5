"""CSV files as string maps with row numbers per file, large files in parallel.

Spark's own CSV reader applies the first file's header to all, numbers no rows and
cuts no quoted line break right, so the parsing runs inside tasks, over Python's csv
module. Lines come from Spark's text reader, which splits large files anywhere.

Which quotes count depends on all that comes before. But a split begins at a line, and
there the parser is in one of two states: between records, or inside quotes. A first
pass over files larger than a split tells for either state the one at the split's end
and how many records end on the way; put together in order of the splits, that gives
every split its true state and its first row's number. Then all splits are parsed at
once. A record that crosses splits is told in fragments, one per split, which are
joined by their record's number. All passes must meet the same splits, so the large
files are scanned apart from the others, and as for the cores of the first pass.
"""

from __future__ import annotations

import codecs
import csv
import re
import sys
from collections.abc import Iterable, Iterator
from itertools import chain, groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.classify import file_stem
from corpusloom.session import hold_splits
from corpusloom.sources.lines import file_name

_ROWS = 64  # Python objects at a time; Spark's own batches have up to 10,000 rows
_ROW_TYPE = pa.map_(pa.string(), pa.string())
_SCHEMA = "path string, file string, row_index bigint, row map<string,string>, error string"
_SCANNED = (
    "path string, start bigint, bytes bigint, utf8 boolean, header binary, "
    "ends_outside bigint, outside_to boolean, ends_inside bigint, inside_to boolean"
)
_FRAGMENT = "path string, file string, number bigint, start bigint, data binary"
# What is left of a quoted field, with its closing quote; doubled quotes belong to it.
_CLOSING = re.compile(rb'[^"]*+(?:""[^"]*+)*+"(?!")')


def _encoding(valid_utf8: bool) -> str:
    return "utf-8" if valid_utf8 else "latin-1"


def _is_utf8(lines: Iterable[bytes]) -> bool:
    try:
        for line in lines:
            line.decode()
    except UnicodeDecodeError:
        return False
    return True


def _pieces(lines: Iterable[bytes], open_end: bool = False) -> Iterator[bytes]:
    """Lines with their ends, which are CR, LF or both, as the csv module wants them.

    ``lines`` were cut at LF; with ``open_end`` no LF followed the last one.
    """
    before = None
    for line in lines:
        if before is not None:
            yield from _at_returns(before + b"\n")
        before = line
    if before is not None:
        yield from _at_returns(before if open_end else before + b"\n")


def _at_returns(line: bytes) -> list[bytes]:
    return line.splitlines(True) if b"\r" in line else [line]


def _ends_inside(piece: bytes, inside: bool) -> bool:
    """Whether the parser is inside quotes after a piece that it began inside or else between records.

    A quote opens a field only as its first character; what follows a closing quote
    other than a comma or an end is plain text again.
    """
    at = 0
    if not inside:
        if piece[:1] == b'"':
            at = 1
        else:
            at = piece.find(b',"') + 2
            if at < 2:
                return False
    while True:
        closed = _CLOSING.match(piece, at)
        if closed is None:
            return True
        at = piece.find(b',"', closed.end()) + 2
        if at < 2:
            return False


def _records(pieces: Iterable[bytes], inside: bool = False) -> Iterator[tuple[list[bytes], bool]]:
    """(pieces of a record, whether it is complete); only the last may be incomplete."""
    held = []
    for piece in pieces:
        held.append(piece)
        inside = _ends_inside(piece, inside)
        if not inside:
            yield held, True
            held = []
    if held:
        yield held, False


def _is_blank(pieces: list[bytes]) -> bool:
    return len(pieces) == 1 and not pieces[0].strip(b"\r\n")


def _row_items(names: list[str], values: list[str], trim: bool) -> list[tuple[str, str | None]]:
    """Fields of one row: surplus values are dropped, missing ones are '' (null untrimmed)."""
    padded = values[: len(names)] + [None] * (len(names) - len(values))
    row = {}
    for name, value in zip(names, padded, strict=True):
        row[name.strip() if trim else name] = (value or "").strip() if trim else value
    return list(row.items())


def _values(records: Iterable[tuple[list[bytes], bool]], encoding: str, at_end: bool) -> Iterator[list[str]]:
    """Values of records, blank ones too; one that is incomplete counts only at the end of its file."""
    csv.field_size_limit(sys.maxsize)
    return csv.reader(piece.decode(encoding) for pieces, complete in records if complete or at_end for piece in pieces)


def _without_mark(lines: Iterator[bytes]) -> Iterator[bytes]:
    first = next(lines, None)
    return iter(()) if first is None else chain([first.removeprefix(codecs.BOM_UTF8)], lines)


def _lacks_last_end(seen: int, size: int) -> bool:
    """Whether no LF ends a file: lines, an LF counted for each, hold one byte more than it, a byte-order mark aside."""
    return seen - size in (1, 1 - len(codecs.BOM_UTF8))


# --- files larger than a split ---------------------------------------------------------


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str, int, Iterator[bytes]]]:
    """(path, start, file, size, lines) of each split of a task, in order."""
    parts = (batch.slice(at, _ROWS) for batch in batches for at in range(0, batch.num_rows, _ROWS))
    rows = (row for part in parts for row in zip(*(column.to_pylist() for column in part.columns)))
    for (path, start, file, size), group in groupby(rows, key=lambda row: row[:4]):
        yield path, start, file, size, (row[4] for row in group)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: what a parser that enters it in either state leaves with, and how many records end."""
    for path, start, _, _, lines in _splits(batches):
        seen, utf8, header = 0, True, None

        def counted(lines):
            nonlocal seen, utf8
            for line in lines:
                seen += len(line) + 1
                utf8 = utf8 and _is_utf8((line,))
                yield line

        lines = counted(lines)
        first, has_header = [], start == 0
        states, ends = [False, True], [0, 0]
        for piece in _pieces(_without_mark(lines) if has_header else lines):
            blank = not piece.strip(b"\r\n")
            before = list(states)
            states[0] = _ends_inside(piece, before[0])
            states[1] = states[0] if before[0] == before[1] else _ends_inside(piece, before[1])
            for k in (0, 1):
                ends[k] += not states[k] and (before[k] or not blank)
            if has_header and header is None:
                first.append(piece)
                header = None if states[0] else b"".join(first)
        columns = [path, start, seen, utf8, header, ends[0], states[0], ends[1], states[1]]
        types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(columns, types)], names=[f.split()[0] for f in _SCANNED.split(", ")])


def _facts(lines: DataFrame) -> dict[str, tuple]:
    """Per large file (encoding, header values or None, open end, last start, {start: (inside, records before)}).

    The driver sees one row per split of a large file, about one byte in a million.
    """
    sizes = lines.select("path", "size").distinct()
    by_path: dict[str, list] = {}
    for row in lines.mapInArrow(_scan, _SCANNED).collect():
        by_path.setdefault(row["path"], []).append(row)
    size_of = {row["path"]: row["size"] for row in sizes.collect()} if by_path else {}
    facts = {}
    for path, rows in by_path.items():
        rows.sort(key=lambda row: row["start"])
        encoding = _encoding(all(row["utf8"] for row in rows))
        open_end = _lacks_last_end(sum(row["bytes"] for row in rows), size_of[path])
        inside, count, states = False, 0, {}
        for row in rows:
            states[row["start"]] = (inside, count)
            count += row["ends_inside"] if inside else row["ends_outside"]
            inside = row["inside_to"] if inside else row["outside_to"]
        header = rows[0]["header"]
        names = None if header is None else next(_values([(bytes(header).splitlines(True), True)], encoding, True), [])
        facts[path] = (encoding, names, open_end, rows[-1]["start"], states)
    return facts


# --- parsing -----------------------------------------------------------------------------


def _batches(path: str, file: str, first: int, rows: Iterator[list]) -> Iterator[pa.RecordBatch]:
    """Numbered rows as Arrow batches; a failure becomes a last row with the error."""
    number, pending, error = first, [], None
    while True:
        try:
            row = next(rows, None)
        except (csv.Error, UnicodeDecodeError) as failure:
            row, error = None, f"CSV read error: {failure}"
        if row is not None:
            pending.append(row)
        if pending and (row is None or len(pending) == _ROWS):
            yield _batch(path, file, range(number, number + len(pending)), pending, [None] * len(pending))
            number, pending = number + len(pending), []
        if row is None:
            break
    if error:
        yield _batch(path, file, [number], [None], [error])


def _batch(path, file, numbers, rows, errors) -> pa.RecordBatch:
    size = len(rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([path] * size, pa.string()), pa.array([file] * size, pa.string()), pa.array(list(numbers), pa.int64()),
            pa.array(rows, _ROW_TYPE), pa.array(errors, pa.string()),
        ],
        names=["path", "file", "row_index", "row", "error"],
    )


def _parse(large, trim: bool):
    """Rows of all splits. A small file is one split, read whole; a large one's state is known."""

    def items(names, values):
        return (_row_items(names, row, trim) for row in values if row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        facts = large.value
        for path, start, file, size, lines in _splits(batches):
            if path not in facts:
                held = list(lines)
                open_end = _lacks_last_end(sum(map(len, held)) + len(held), size)
                values = _values(_records(_pieces(_without_mark(iter(held)), open_end)), _encoding(_is_utf8(held)), True)
                names = next(values, [])
                yield from _batches(path, file, 0, items(names, values))
                continue
            encoding, names, open_end, last, states = facts[path]
            if names is None:
                if start == 0:
                    yield _batch(path, file, [0], [None], ["CSV read error: the header is longer than a split"])
                continue
            inside, before = states[start]
            is_last = start == last
            records = _records(_pieces(_without_mark(lines) if start == 0 else lines, open_end and is_last), inside)
            if inside:
                next(records, None)  # told as a fragment
            values = _values(records, encoding, is_last)
            if start == 0:
                next(values, None)
            first = before + inside - bool(names) if start else 0
            yield from _batches(path, file, first, items(names, values))

    return run


def _fragments(large):
    """(path, file, number, start, data): the bytes in each split of the records that cross splits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        facts = large.value
        for path, start, file, _, lines in _splits(batches):
            encoding, names, open_end, last, states = facts[path]
            inside, number = states[start]
            is_last = start == last
            records = _records(_pieces(_without_mark(lines) if start == 0 else lines, open_end and is_last), inside)
            for pieces, complete in records:
                crosses = inside or not (complete or is_last)
                if crosses and names is not None:
                    row = [path, file, number, start, b"".join(pieces)]
                    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=["path", "file", "number", "start", "data"])
                number += complete and (inside or not _is_blank(pieces))
                inside = False

    return run


def _join_fragments(large, trim: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        facts = large.value
        for batch in batches:
            for path, file, number, parts in zip(*(batch[name].to_pylist() for name in ("path", "file", "number", "parts"))):
                encoding, names = facts[path][:2]
                data = b"".join(part["data"] for part in parts)
                values = _values([(data.splitlines(True), True)], encoding, True)
                yield from _batches(path, file, number - bool(names), (_row_items(names, row, trim) for row in values))

    return run


def _bytes(setting: str) -> int:
    """A size as Spark's settings spell it."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]*)\s*", setting).groups()
    return int(number) << {"k": 10, "m": 20, "g": 30, "t": 40}.get(unit.lower()[:1], 0)


def _unsplit_bytes(spark: SparkSession) -> int:
    """Files up to this size are never split."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    return min(_bytes(spark.conf.get(name)) for name in names)


def _spread(rows: DataFrame) -> DataFrame:
    """Rows of a small input over all cores, in the order of files and rows."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() >= cores:
        return rows
    return rows.repartitionByRange(cores, "path", "row_index").sortWithinPartitions("path", "row_index")


def with_unique_stems(rows: DataFrame, path: str | list[str], glob: str = "*.[cC][sS][vV]") -> DataFrame:
    """Rows with ``stem``, the file's name without suffix; where files of several folders share it, with a mark of its path.

    Files are told from their listing alone, and only shared names cost a join.
    """
    listing = rows.sparkSession.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    files = listing.select(F.col("_metadata.file_path").alias("path"), file_stem(file_name()).alias("stem"))
    shared = files.groupBy("stem").count().where(F.col("count") > 1)
    stem = file_stem("file")
    if shared.isEmpty():
        return rows.withColumn("stem", stem)
    marked = files.join(shared, "stem", "left_semi").select("path", F.substring(F.md5(F.col("path").cast("binary")), 1, 8).alias("_mark"))
    marked = rows.join(marked, "path", "left")
    return marked.withColumn("stem", F.concat(stem, F.coalesce(F.concat(F.lit("@"), "_mark"), F.lit("")))).drop("_mark")


def read_csv_rows(
    spark: SparkSession, path: str | list[str], trim: bool = True, glob: str = "*.[cC][sS][vV]"
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): (path, file, row_index, row) of all rows, and (file, error) of files that failed.

    Trimmed rows have stripped names and values and '' for missing values. Files
    that are not UTF-8 are read as Latin-1. Rows before an error are kept. Files larger
    than a split are read by many tasks, whatever their quotes; a single line and a
    single record must each fit in a cell (2 GB), a header in a split.
    """
    reader = spark.read.option("pathGlobFilter", glob).option("lineSep", "\n")
    lines = reader.text([path] if isinstance(path, str) else path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        file_name().alias("file"), F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("value"),
    )
    # Where Spark cuts a file depends on all files of a scan, so every pass over the large ones scans these alone.
    unsplit = F.col("size") <= _unsplit_bytes(spark)
    splittable = lines.where(~unsplit)
    release = hold_splits(spark)
    facts = _facts(splittable)
    large = spark.sparkContext.broadcast(facts)  # about a millionth of the input
    rows = lines.where(unsplit).mapInArrow(_parse(large, trim), _SCHEMA)
    if facts:
        rows = rows.unionByName(splittable.mapInArrow(_parse(large, trim), _SCHEMA))
    else:
        release()
    rows = _spread(rows)
    if any(inside for fact in facts.values() for inside, _ in fact[4].values()):
        parts = splittable.mapInArrow(_fragments(large), _FRAGMENT).groupBy("path", "file", "number")
        joined = parts.agg(F.array_sort(F.collect_list(F.struct("start", "data"))).alias("parts"))
        rows = rows.unionByName(joined.mapInArrow(_join_fragments(large, trim), _SCHEMA))
    return (
        rows.where(F.col("error").isNull()).select("path", "file", "row_index", "row"),
        rows.where(F.col("error").isNotNull()).select("file", "error"),
    )
