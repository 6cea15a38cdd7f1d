"""Delimited and JSON-lines tables: look at the first lines, then scan with Spark.

Only a bounded piece of the first file is looked at on the driver, however long its lines are. The scan itself
yields every value as text, with the kind of each field taken from the first row.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from isobar.functions.sql import ident
from isobar.operators.fieldtypes import sample_kinds

# Size of the looked-at sample, and the form of a JSON object line.
SAMPLE_CHARS = 1024
JSON_LINE = r"^{.+}$"
DEFAULT_DELIMITER = ","

# What is looked at of each of the first two lines: the names of a few thousand columns.
HEAD_CHARS = 1 << 17

# Where the parser leaves a line that it cannot read.
DAMAGED = "_damaged"


class BinaryInput(ValueError):
    """The input holds NUL characters."""


@dataclass(frozen=True)
class TextTable:
    """A text table: its rows as strings and what was found out about it."""

    parsed: DataFrame  # the fields in order, then the text of a damaged line or null
    kinds: dict[str, str]
    filetype: str
    delimiter: str | None = None
    header: bool | None = None
    check_binary: bool = True

    @property
    def rows(self) -> DataFrame:
        return self.parsed.drop(DAMAGED)


def first_lines(spark: SparkSession, path: str, lines: int = SAMPLE_CHARS) -> list[str]:
    """The lines that ``look`` finds, ``lines`` at most."""
    return look(spark, path)[1][:lines]


def look(spark: SparkSession, path: str) -> tuple[str | None, list[str]]:
    """The first file by name that has more than one line, or the first one where none has, and its first lines,
    as far as they are looked at: two lines of up to ``HEAD_CHARS``, and more if these are shorter than the sample.

    Lines are cut before they leave the executors. Only where the first file is empty or a lone header are the lines
    of all files counted, by Spark; one row comes back.
    """
    text = spark.read.text(path)
    files = text.inputFiles()
    file = min(files) if files else None
    found = _head(spark, file) if file else []
    if len(found) < 2 and len(files) > 1:
        name = F.col("_metadata.file_path").alias("file")
        file = text.select(name).groupBy("file").agg(F.count(F.lit(1)).alias("n")).agg(
            F.min_by("file", F.struct(F.col("n") < 2, "file")).alias("file")
        ).first()["file"]
        found = _head(spark, file) if file else []
    return file, found


def _head(spark: SparkSession, file: str) -> list[str]:
    def cut(lines: int, chars: int) -> list[str]:
        return [r[0] for r in spark.read.text(file).select(F.substring("value", 1, chars)).head(lines)]

    found = cut(2, HEAD_CHARS)
    # Every further line adds a line break at least.
    wanted = SAMPLE_CHARS - sum(len(line) + 1 for line in found)
    return found + cut(2 + wanted, wanted)[2:] if len(found) == 2 and wanted > 0 else found


def _first_row(spark: SparkSession, file: str) -> DataFrame:
    return spark.read.text(file).limit(1)


def detect_format(first_line: str) -> str:
    return "JSON" if re.search(JSON_LINE, first_line.rstrip()) else "CSV"


def format_of(spark: SparkSession, file: str | None) -> str:
    """As ``detect_format``, by the whole first line of a file, which stays where it is."""
    if file is None:
        return "CSV"
    line = F.rtrim(F.col("value"))
    found = _first_row(spark, file).select(
        (F.startswith(line, F.lit("{")) & F.endswith(line, F.lit("}")) & (F.length(line) > 2)).alias("is_json")
    ).first()
    return "JSON" if found and found["is_json"] else "CSV"


def detect_dialect(sample: str) -> type[csv.Dialect] | csv.Dialect | None:
    """Delimiter and quoting of the sample, or None where they cannot be told."""
    try:
        return csv.Sniffer().sniff(sample)
    except csv.Error:
        return None


def detect_header(sample: str) -> bool:
    try:
        return csv.Sniffer().has_header(sample)
    except csv.Error:
        return False


def contains_nul(lines: DataFrame, column: str = "value"):
    """Number of rows whose text holds a NUL character."""
    return lines.select(F.count_if(F.contains(F.col(column), F.char(F.lit(0)))).alias("n_nul"))


def nul_test(table: TextTable) -> str:
    """Whether a parsed line holds a NUL character, as SQL. JSON allows none outside of
    escapes, so there it leaves a damaged line."""
    columns = [DAMAGED] if table.filetype == "JSON" else table.parsed.columns
    return " OR ".join(f"coalesce(contains({ident(c)}, char(0)), false)" for c in columns)


def column_names(width: int, names: Sequence[str | None] | None = None) -> list[str]:
    """Given names; blank or missing ones become ``var<i>``. A name that was there before,
    in whatever case, gets ``_2``, ``_3`` and so on at its end."""
    given = list(names or [])
    if len(given) > width:
        raise ValueError(f"{len(given)} names for {width} columns")
    given += [None] * (width - len(given))
    out: list[str] = []
    for i, name in enumerate(given):
        name = own = name or f"var{i}"
        taken, n = {o.lower() for o in out}, 1
        while own.lower() in taken:
            n += 1
            own = f"{name}_{n}"
        out.append(own)
    return out


def read_delimited(
    spark: SparkSession,
    path: str,
    *,
    sep: str | None = None,
    header: bool | None = None,
    names: Sequence[str | None] | None = None,
    infer: str = "regex",
    multiline: bool = False,
    check_binary: bool = True,
    looked: tuple[str | None, list[str]] | None = None,
) -> TextTable:
    """Scan a delimited table. ``sep`` and ``header`` are detected unless given.

    Blank cells stay blank text. In a folder every file has the header or none has.
    ``multiline`` allows line breaks inside quotes, at the price of unsplittable files. A line
    with too few or too many cells is damaged. ``check_binary`` has the use of
    the table refuse NUL characters. ``looked`` is what ``look`` gave, where that is known. A first line whose
    cells go on beyond what is looked at is refused.
    """
    file, lines = looked or look(spark, path)
    sample = "\n".join(line[:SAMPLE_CHARS] for line in lines)[:SAMPLE_CHARS]
    dialect = detect_dialect(sample)
    sep = sep or (dialect.delimiter if dialect else DEFAULT_DELIMITER)
    header = detect_header(sample) if header is None else header
    quote = (dialect.quotechar if dialect else None) or '"'
    options = {
        "sep": sep,
        "quote": quote,
        "escape": quote,
        "ignoreLeadingWhiteSpace": str(bool(dialect and dialect.skipinitialspace)).lower(),
        "multiLine": str(multiline).lower(),
        "emptyValue": "",
    }

    head = lines[:2]
    if any(len(line) == HEAD_CHARS for line in head):
        beyond = F.substring("value", HEAD_CHARS + 1, 2**31 - 1)
        if spark.read.text(file).limit(2).where(F.contains(beyond, F.lit(sep))).count():
            raise ValueError(f"{file}: a first line has cells beyond {HEAD_CHARS} characters")
    cells = list(csv.reader(head, delimiter=sep, quotechar=quote, skipinitialspace=bool(dialect and dialect.skipinitialspace)))
    first = cells[0] if cells else []
    fields = column_names(len(first), first if header else names)
    row = cells[1:2] if header else cells[:1]
    values = row[0] if row else []
    sample_row = {f: (values[i] if i < len(values) else None) for i, f in enumerate(fields)}

    # With the schema given, columns go by position and the header line is only skipped.
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(fields))] + [_DAMAGED_FIELD])
    reader = spark.read.schema(schema).option("header", header).option("enforceSchema", "true")
    rows = reader.option("columnNameOfCorruptRecord", DAMAGED).options(**options).csv(path)
    rows = rows.selectExpr(*[f"coalesce(c{i}, '') AS {ident(f)}" for i, f in enumerate(fields)], DAMAGED)
    return TextTable(rows, sample_kinds(rows, sample_row, infer), "CSV", sep, header, check_binary)


_DAMAGED_FIELD = T.StructField(DAMAGED, T.StringType())


def read_json_lines(
    spark: SparkSession, path: str, *, infer: str = "regex", check_binary: bool = True,
    looked: tuple[str | None, list[str]] | None = None,
) -> TextTable:
    """Scan JSON lines. The columns are the keys of the first object; other keys are
    ignored and missing ones are null. Nested values stay JSON text. A line that is no
    object is damaged.

    The first object is taken apart by Spark: names, kinds and the beginnings of texts come back.
    """
    file, _ = looked or look(spark, path)
    fields, numbers, texts = _first_object(spark, file) if file else ([], [], {})
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields] + [_DAMAGED_FIELD])
    rows = spark.read.schema(schema).option("columnNameOfCorruptRecord", DAMAGED).json(path)
    kinds = sample_kinds(rows, texts, infer)
    kinds = {f: "Numeric" if f in numbers else kinds[f] for f in fields}
    return TextTable(rows, kinds, "JSON", check_binary=check_binary)


def _first_object(spark: SparkSession, file: str) -> tuple[list[str], list[str], dict[str, str | None]]:
    """Keys of a file's first object in order, those with numbers, and the beginnings of the other values as text."""
    first = _first_row(spark, file)
    found = first.select(F.json_object_keys("value").alias("keys")).first()
    if found is None:
        return [], [], {}
    if found["keys"] is None:
        raise ValueError(f"{file}: the first line is no JSON object")
    fields = list(dict.fromkeys(found["keys"]))
    if not fields:
        return [], [], {}

    names = [f"v{i}" for i in range(len(fields))]

    def parsed(kind: T.DataType) -> DataFrame:
        schema = T.StructType([T.StructField(f, kind) for f in fields])
        return first.select(F.from_json("value", schema).alias("o")).select("o.*").toDF(*names)

    # A text is no double, but for the names of odd numbers.
    is_number = parsed(T.DoubleType()).select(*[(F.abs(n) < float("inf")).alias(n) for n in names]).first()
    begins = parsed(T.StringType()).select(*[F.substring(n, 1, SAMPLE_CHARS).alias(n) for n in names]).first()
    numbers = [f for f, yes in zip(fields, is_number, strict=True) if yes]
    return fields, numbers, {f: t for f, t in zip(fields, begins, strict=True) if f not in numbers}


def read_text_table(spark: SparkSession, path: str, **delimited_options) -> TextTable:
    """Scan a file in whichever of the two formats its first line shows."""
    looked = look(spark, path)
    if format_of(spark, looked[0]) == "JSON":
        own = {name: delimited_options[name] for name in ("infer", "check_binary") if name in delimited_options}
        return read_json_lines(spark, path, looked=looked, **own)
    return read_delimited(spark, path, looked=looked, **delimited_options)
