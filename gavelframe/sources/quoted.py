"""CSV files with line breaks inside quotes, read by many tasks.

Whether a line begins inside a quoted field depends on all lines before it. Each
line turns "outside" and "inside" into "outside" or "inside"; these pairs are
composed along a split, one row per split gives by the splits before it the
state in which it begins, and a second pass over the lines then knows every
record's first line. Records of one line, nearly all, stay where they are; only
the lines of longer ones are brought together, wherever a split cut them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelframe.session import cut

_OUT, _IN = 0, 1
# Fields that are closed on their line, from the start of a field; a quote counts only there.
_CLOSED = re.compile(r'(?:(?:"(?:[^"]|"")*+"(?!")[^,]*+|(?!")[^,]*+)(?:,|\Z))*+')
_REST_OF_QUOTED = re.compile(r'(?:[^"]|"")*+"(?!")[^,]*+(?:,|\Z)')
_PLACE = "file string, block long, row long"
_LONGEST = 10_000


def _end_of_fields(line: str, start: int) -> int:
    """State behind a line, from a place where a field begins."""
    closed = _CLOSED.match(line, start).end()
    return _IN if closed < len(line) else _OUT


def line_ends(line: str) -> tuple[int, int]:
    """States behind a line that begins outside and inside a quoted field."""
    inside = _REST_OF_QUOTED.match(line)
    return _end_of_fields(line, 0), _end_of_fields(line, inside.end()) if inside else _IN


def _steps(lines: pa.Array) -> list[tuple[int, int] | None]:
    """`line_ends` of each line; None where there is no quote, which changes nothing."""
    quoted = pc.match_substring(lines, '"').to_pylist()
    return [line_ends(lines[k].as_py()) if q else None for k, q in enumerate(quoted)]


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, str, tuple[int, int] | None]]:
    for batch in batches:
        files, blocks, rows, lines = (batch.column(c) for c in range(4))
        for file, block, row, k, step in zip(files.to_pylist(), blocks.to_pylist(), rows.to_pylist(), range(len(batch)), _steps(lines), strict=True):
            yield file, block, row, lines[k], step


def _split_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, from_outside, from_inside): the lines of each split composed."""
    ends: dict[tuple[str, int], tuple[int, int]] = {}
    for file, block, _, _, step in _along(batches):
        before = ends.setdefault((file, block), (_OUT, _IN))
        if step:
            ends[file, block] = (step[before[0]], step[before[1]])
    if ends:
        columns = list(zip(*[(*place, *states) for place, states in ends.items()], strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0]), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int32())],
            names=["file", "block", "from_outside", "from_inside"],
        )


def _begins(splits: list[tuple[str, int, int, int]]) -> set[tuple[str, int]]:
    """Splits that begin inside a quoted field, from one row per split."""
    state, found, last = _OUT, set(), None
    for file, block, outside, inside in sorted(splits):
        if file != last:
            state, last = _OUT, file
        if state == _IN:
            found.add((file, block))
        state = inside if state == _IN else outside
    return found


def _numbered(begin_inside: set[tuple[str, int]]):
    """(file, block, row, first, whole, header, value): `first` is the row of the record's first line, -1 if that is in an earlier split."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, state, first, top = None, _OUT, -1, -1
        for batch in batches:
            files, blocks, rows, lines = (batch.column(c) for c in range(4))
            firsts, whole, header = [], [], []
            for file, block, row, step in zip(files.to_pylist(), blocks.to_pylist(), rows.to_pylist(), _steps(lines), strict=True):
                if (file, block) != place:
                    place, first, top = (file, block), -1, row if block == 0 else -1
                    state = _IN if place in begin_inside else _OUT
                if state == _OUT:
                    first = row
                after = step[state] if step else state
                firsts.append(first)
                header.append(first >= 0 and first == top)
                whole.append(state == _OUT and after == _OUT)
                state = after
            columns = [files, blocks, rows, pa.array(firsts, pa.int64()), pa.array(whole), pa.array(header), lines]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "block", "row", "first", "whole", "header", "value"])

    return number


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file, position, header, text`` of every record; blank lines between records are left out.

    A record of more than ten thousand lines, which a quote that is never
    closed makes, is an error with its place.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    ends = lines.mapInArrow(_split_ends, "file string, block long, from_outside int, from_inside int").collect()
    marked = lines.mapInArrow(_numbered(_begins([tuple(r) for r in ends])), f"{_PLACE}, first long, whole boolean, header boolean, value string")
    # Rows of a split count on from a number of its own: bytes before it and rows in it order a file.
    within = F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    marked = marked.withColumn("position", F.col("block") + within)
    single = marked.where("whole").select("file", "position", "header", "value")
    parts = cut(marked.where("NOT whole").drop("whole"), "csv-parts")
    last = parts.where("first >= 0").groupBy("file", "block").agg(F.max("first")).collect()
    carried = _open_records([tuple(r) for r in last], ends)
    carried = spark.createDataFrame(carried, "file string, block long, carried long")
    parts = parts.join(carried, ["file", "block"], "left")
    parts = parts.withColumn("first", F.when(F.col("first") < 0, F.col("carried")).otherwise(F.col("first")))
    counted = parts.groupBy("file", "first").agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("at"))
    longest = counted.where(F.col("n") > _LONGEST).head()
    if longest:
        raise PySparkException(f"{longest['file']}: a quote near position {longest['at']} is not closed within {_LONGEST} lines")
    joined = parts.groupBy("file", "first").agg(
        F.min("position").alias("position"),
        F.bool_or("header").alias("header"),
        F.array_sort(F.collect_list(F.struct("position", "value"))).alias("lines"),
    )
    whole = F.array_join(F.transform("lines", lambda x: x["value"]), "\n")
    return _texts(single.unionByName(joined.select("file", "position", "header", whole.alias("value"))))


def _open_records(last: list[tuple[str, int, int]], splits: Sequence) -> list[tuple[str, int, int]]:
    """For each split that begins inside a record, the first row of that record, from the last one begun before it."""
    begun = {(file, block): row for file, block, row in last}
    out, current, of_file = [], None, None
    inside = _begins([tuple(r) for r in splits])
    for file, block, *_ in sorted(tuple(r) for r in splits):
        if file != of_file:
            current, of_file = None, file
        if (file, block) in inside and current is not None:
            out.append((file, block, current))
        current = begun.get((file, block), current)
    return out


def _texts(rows: DataFrame) -> DataFrame:
    text = F.regexp_replace("value", "\r\\z", "")
    return rows.select("file", "position", "header", text.alias("text")).where("text <> ''")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows of CSV files with a header each, all columns as text; line breaks in quotes do not hinder splitting."""
    names = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).columns
    schema = ", ".join(f"_{k} string" for k in range(len(names)))
    fields = F.from_csv("text", schema, {"escape": '"', "multiLine": "true"})
    rows = records(spark, path).where("NOT header").select(fields.alias("_r"))
    return rows.select(*[F.col(f"_r._{k}").alias(name) for k, name in enumerate(names)])
