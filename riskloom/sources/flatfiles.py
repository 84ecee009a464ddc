"""Delimited text with `#` header lines, read and written line by line through Spark's text files.

A file begins with a line of column names and one of types. A row is one line: values are separated by one
character, null is nothing, and a value that would be taken for something else (empty, with a separator,
a quote, a line end, a `#` in front or blanks around it) stands in quotes with line ends, quotes and
backslashes escaped. So a line is whole wherever a file is split, and any store that Spark reads will do.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

COLUMNS, TYPES = "#Columns: ", "#Type: "

# Type words of the header and the types they stand for.
TYPE_WORDS = {"ID": "string", "STRING": "string", "NUMBER": "double", "INTEGER": "bigint", "DATE": "date"}
# What a backslash and a letter stand for inside quotes.
ESCAPES = {"\n": "\\n", "\r": "\\r", '"': '\\"', "\\": "\\\\"}
_BACK = {v: k for k, v in ESCAPES.items()}


def encode(value: str | None, sep: str = "|") -> str:
    """A value as it stands in a line."""
    if value is None:
        return ""
    plain = value and value == value.strip() and value[0] not in '#"' and sep not in value and not re.search(r"[\x00-\x1f\x85\u2028\u2029]", value)
    return value if plain else '"' + re.sub(r'[\n\r"\\]', lambda m: ESCAPES[m[0]], value) + '"'


def decode(line: str, sep: str = "|") -> list[str | None]:
    """The values of a line. A quote that is not closed, or text after one, stands for itself."""
    out: list[str | None] = []
    i = 0
    quoted = re.compile(r'"((?:[^"\\]|\\.)*)"(?=' + re.escape(sep) + r"|$)", re.S)
    while True:
        m = quoted.match(line, i)
        if m:
            out.append(re.sub(r"\\.", lambda e: _BACK.get(e[0], e[0]), m[1], flags=re.S))
            end = m.end()
        else:
            end = line.find(sep, i)
            end = len(line) if end < 0 else end
            out.append(line[i:end] or None)
        if end >= len(line):
            return out
        i = end + len(sep)


def write_flat(df: DataFrame, path: str, types: dict[str, str] | None = None, sep: str = "|") -> None:
    """Add rows to a folder of such files, every file with its header lines. Spark's commit makes all files of a job
    visible at once; an empty table writes a file with the header only."""
    types = types or {}
    head = [COLUMNS + sep.join(df.columns), TYPES + sep.join(types.get(c, "STRING") for c in df.columns)]

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(head)], names=["value"])
        for b in batches:
            columns = [[encode(x, sep) for x in c.to_pylist()] for c in b.columns]
            # a row of one null would be an empty line, which readers skip
            rows = [sep.join(r) if any(r) or len(r) > 1 else f'{sep}' for r in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], names=["value"])

    text = df.select(*[F.col(f"`{c}`").cast("string") for c in df.columns])
    if text.isEmpty():
        text = text.repartition(1)
    text.mapInArrow(lines, "value string").write.mode("append").text(path)


def header(lines: DataFrame, path: str, sep: str) -> tuple[list[str], list[str]]:
    """Names and type words, on which all files must agree."""
    value = F.col("value")
    head = lines.where(value.startswith(COLUMNS) | value.startswith(TYPES)).groupBy(F.substring_index(value, " ", 1).alias("mark"))
    found = {}
    for r in head.agg(F.min(value).alias("low"), F.max(value).alias("high")).collect():
        if r.low != r.high:
            raise ValueError(f"files of {path} differ in their {r.mark} line")
        found[r.mark] = r.low.split(": ", 1)[1].split(sep)
    if "#Columns:" not in found:
        raise ValueError(f"no {COLUMNS.strip()} line in {path}")
    names = found["#Columns:"]
    return names, found.get("#Type:", ["STRING"] * len(names))


def read_flat(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    """Read such files; names and types come from the header lines. Lines that begin with `#` are comments, empty
    lines are skipped, values missing at a line's end are null, a value beyond the last column is an error, and a value
    that is not of its column's type is null."""
    lines = spark.read.text(path)
    names, kinds = header(lines, path, sep)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(0)
            if pc.any(pc.match_substring(text, '"')).as_py():
                values = [decode(x, sep) for x in text.to_pylist()]
            else:
                values = [[x or None for x in r] for r in pc.split_pattern(text, sep).to_pylist()]
            for r in values:
                if len(r) > len(names) and any(x is not None for x in r[len(names) :]):
                    raise ValueError(f"{len(r)} values for {len(names)} columns: {sep.join(x or '' for x in r)[:200]}")
                r.extend([None] * (len(names) - len(r)))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in values], pa.string()) for i in range(len(names))], names=names)

    body = lines.where(~F.col("value").startswith("#") & (F.col("value") != ""))
    raw = body.mapInArrow(rows, ", ".join(f"`{n}` string" for n in names))
    return raw.select(*[F.col(f"`{n}`").try_cast(TYPE_WORDS.get(k, "string")).alias(n) for n, k in zip(names, kinds)])
