"""Profile of a whole table: one record per field, plus histograms, value
frequencies and correlations, and the JSON report over them."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from isobar.functions.nested import as_text
from isobar.functions.numbers import is_blank, to_double
from isobar.functions.sql import ident
from isobar.operators.correlation import default_pairs
from isobar.operators.fieldtypes import sample_kinds
from isobar.operators.frequency import distinct_values, modes, number_frequencies, text_frequencies
from isobar.operators.numberprofile import NumberProfile, profile_numbers
from isobar.session import shared_dir
from isobar.sources.tables import DAMAGED, BinaryInput, TextTable, nul_test, read_text_table
from isobar.sources.versions import delete_folder, write_text

# The word for no mode, and the names in ``_string_record``, ``_numeric_record`` and
# ``report``.
NO_MODE = "No Mode"
BLANK_RULES = ("skip", "zero", "fail")


class InvalidValues(ValueError):
    """Numeric fields hold values that the chosen rules do not allow."""


@dataclass(frozen=True)
class ProfileConfig:
    """Settings of a file profile. ``format``, ``hasheader`` and ``separator`` are
    accepted for what a settings document may hold; the file itself decides."""

    infile: str
    metafile: str | None = None
    format: str | None = None
    hasheader: str | None = None
    separator: str | None = None

    @classmethod
    def from_json(cls, text: str) -> ProfileConfig:
        settings = json.loads(text)
        if "infile" not in settings:
            raise ValueError("the settings need 'infile'")
        known = {name: settings[name] for name in cls.__dataclass_fields__ if name in settings}
        return cls(**known)


@dataclass(frozen=True)
class Typed:
    """A table with numeric fields as doubles and all other fields as text."""

    df: DataFrame
    kinds: dict[str, str]
    n_blank: dict[str, int] = field(default_factory=dict)
    n_invalid: dict[str, int] = field(default_factory=dict)
    n_nan: dict[str, int] = field(default_factory=dict)
    n_malformed: int = 0
    landed: str | None = None

    def of_kind(self, kind: str) -> list[str]:
        return [name for name in self.df.columns if self.kinds[name] == kind]


def type_text_table(table: TextTable, *, blank: str = "skip", strict: bool = False) -> Typed:
    """Cast the numeric fields and land the table as parquet in the shared folder.

    The text is parsed once. While it is written, blanks, values that do not cast, values that are
    no number by their own account (``nan``), damaged lines and NUL characters are counted; every
    later pass reads columns. ``strict`` refuses all of these but blanks.
    """
    if blank not in BLANK_RULES:
        raise ValueError(f"blank must be one of {BLANK_RULES}, not {blank!r}")
    spark, rows, kinds = table.parsed.sparkSession, table.rows, table.kinds
    numeric = [i for i, f in enumerate(rows.columns) if kinds[f] == "Numeric"]
    # Positional names: field names from a file need not be valid parquet names. A number is
    # matched and cast once, below the place where it is counted.
    cells = table.parsed.selectExpr(
        *[f"{ident(f)} AS t{i}" for i, f in enumerate(rows.columns)],
        *[f"{to_double(ident(rows.columns[i]))} AS d{i}" for i in numeric],
        f"{DAMAGED} IS NOT NULL AS damaged", f"{nul_test(table)} AS nul",
    )
    metrics = ["count_if(damaged) AS damaged", "count_if(nul) AS nul"]
    for i in numeric:
        metrics += [
            f"count_if({is_blank(f't{i}')}) AS blank{i}", f"count_if(isnan(d{i})) AS nan{i}",
            f"count_if(d{i} IS NULL AND NOT {is_blank(f't{i}')}) AS bad{i}",
        ]
    counted = Observation()
    # ``skip`` leaves blank cells out, ``zero`` counts them as 0, ``fail`` is checked below.
    value = {i: f"if({is_blank(f't{i}')}, 0D, d{i})" if blank == "zero" else f"d{i}" for i in numeric}
    typed = cells.observe(counted, *map(F.expr, metrics)).selectExpr(
        *[f"{value.get(i, f't{i}')} AS c{i}" for i in range(len(rows.columns))]
    )
    path = shared_dir(spark, "typed")
    typed.write.parquet(path)
    seen = counted.get
    counts = {kind: {rows.columns[i]: seen[f"{kind}{i}"] for i in numeric} for kind in ("blank", "bad", "nan")}
    problems = [
        (table.check_binary and seen["nul"], BinaryInput, "lines with NUL characters, probably no text"),
        (blank == "fail" and _positive(counts["blank"]), InvalidValues, "blank numeric cells"),
        (strict and _positive(counts["bad"]), InvalidValues, "values that are no numbers"),
        (strict and _positive(counts["nan"]), InvalidValues, "values that are not a number"),
        (strict and seen["damaged"], InvalidValues, "damaged lines"),
    ]
    for found, kind, what in problems:
        if found:
            delete_folder(spark, path)
            raise kind(f"{what}: {found}")
    landed = spark.read.schema(typed.schema).parquet(path).toDF(*rows.columns)
    return Typed(landed, kinds, counts["blank"], counts["bad"], counts["nan"], seen["damaged"], path)


def _positive(counts: dict[str, int]) -> dict[str, int]:
    return {name: n for name, n in counts.items() if n}


def type_frame(df: DataFrame, infer: str = "regex", first_by: str | None = None) -> Typed:
    """A DataFrame for profiling: numeric columns are numeric, text columns go by the row
    that is first by the column ``first_by``, everything else is text."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if texts and first_by is None:
        raise ValueError("text columns go by their first row: first_by names the column that orders rows")
    first = df.orderBy(ident(first_by)).select(*map(ident, texts)).head() if texts else None
    kinds = sample_kinds(df, dict(zip(texts, first)) if first else {}, infer)
    columns = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.NumericType):
            kinds[f.name] = "Numeric"
            value = f"CAST({ident(f.name)} AS DOUBLE)"
        elif kinds.get(f.name) == "Numeric":
            value = to_double(ident(f.name))
        else:
            kinds[f.name] = "String"
            value = as_text(df, f.name)
        columns.append(f"{value} AS {ident(f.name)}")
    return Typed(df.selectExpr(*columns), kinds)


@dataclass(frozen=True)
class Profile:
    """The parts of a profile, each computed when first asked for.

    All are DataFrames keyed by ``field`` (``x``, ``y`` for the correlations), or None
    where the table has no field of that kind. ``frequencies`` and ``distinct`` hold
    every value of the text fields.
    """

    typed: Typed
    pairs: list[tuple[str, str]]
    attributes: dict[str, object] = field(default_factory=dict)
    values: str | None = None

    @cached_property
    def numbers(self) -> NumberProfile:
        """All about the numeric fields, in as few scans as they need together."""
        return profile_numbers(self.typed.df, self.typed.of_kind("Numeric"), self.pairs)

    @cached_property
    def numeric(self) -> DataFrame | None:
        return self.numbers.records if self.typed.of_kind("Numeric") else None

    @cached_property
    def histograms(self) -> DataFrame | None:
        return self.numbers.histograms if self.typed.of_kind("Numeric") else None

    @cached_property
    def distinct_numbers(self) -> DataFrame | None:
        """How many different values each numeric field has. The one part that moves every value."""
        numbers = self.typed.of_kind("Numeric")
        return modes(number_frequencies(self.typed.df, numbers)).select("field", "n_unique") if numbers else None

    @cached_property
    def frequencies(self) -> DataFrame | None:
        """Written once and read back, so that its uses share one computation."""
        texts = self.typed.of_kind("String")
        if not texts:
            return None
        counted = text_frequencies(self.typed.df, texts)
        counted.write.mode("overwrite").parquet(self.frequencies_path)
        return counted.sparkSession.read.schema(counted.schema).parquet(self.frequencies_path)

    @cached_property
    def frequencies_path(self) -> str:
        """Where the values of the text fields are: ``values``, or below the shared folder."""
        return self.values or shared_dir(self.typed.df.sparkSession, "frequencies")

    @cached_property
    def strings(self) -> DataFrame | None:
        return None if self.frequencies is None else modes(self.frequencies)

    @cached_property
    def distinct(self) -> DataFrame | None:
        return None if self.frequencies is None else distinct_values(self.frequencies)

    @cached_property
    def correlations(self) -> DataFrame:
        return self.numbers.correlations

    def discard(self) -> None:
        """Delete what was landed in the shared folder; the parts cannot be read after."""
        for path in (None if self.values else self.frequencies_path, self.typed.landed):
            if path:
                delete_folder(self.typed.df.sparkSession, path)


def profile(
    typed: Typed, pairs: Sequence[tuple[str, str]] | None = None, values: str | None = None, **attributes
) -> Profile:
    """Profile a typed table. With exactly two numeric fields their correlation is
    included; with more, ``pairs`` chooses. ``values`` is where the values of the text fields go."""
    pairs = default_pairs(typed.of_kind("Numeric")) if pairs is None else list(pairs)
    return Profile(typed, pairs, attributes, values)


def profile_frame(
    df: DataFrame, pairs: Sequence[tuple[str, str]] | None = None, infer: str = "regex", first_by: str | None = None,
    land: bool = False,
) -> Profile:
    """The parts scan the frame several times and rely on equal rows each time. ``land`` writes
    it to the shared folder first: for a frame that is costly, or not the same when computed again."""
    typed = type_frame(df, infer, first_by)
    if land:
        path = shared_dir(df.sparkSession, "frame")
        plain = typed.df.toDF(*[f"c{i}" for i in range(len(typed.df.columns))])
        plain.write.parquet(path)
        landed = df.sparkSession.read.schema(plain.schema).parquet(path).toDF(*typed.df.columns)
        typed = Typed(landed, typed.kinds, landed=path)
    return profile(typed, pairs, filetype="TABLE")


def profile_file(
    spark: SparkSession,
    config: ProfileConfig | str,
    *,
    pairs: Sequence[tuple[str, str]] | None = None,
    sep: str | None = None,
    header: bool | None = None,
    names: Sequence[str | None] | None = None,
    infer: str = "regex",
    blank: str = "skip",
    strict: bool = False,
    multiline: bool = False,
    check_binary: bool = True,
) -> Profile:
    """Profile a delimited or JSON-lines file and write the report if asked to."""
    config = ProfileConfig(config) if isinstance(config, str) else config
    table = read_text_table(
        spark, config.infile, sep=sep, header=header, names=names, infer=infer, multiline=multiline,
        check_binary=check_binary,
    )
    attributes = {"filetype": table.filetype, "inputfile": config.infile}
    if table.filetype == "CSV":
        attributes |= {"FieldSeparator": table.delimiter, "HeaderPresent": str(table.header)}
    values = f"{config.metafile}.values" if config.metafile else None
    done = profile(type_text_table(table, blank=blank, strict=strict), pairs, values, **attributes)
    if config.metafile:
        write_report(done, config.metafile)
    return done


def _string_record(row, values: str) -> dict:
    return {
        "Name": row["field"],
        "Type": "String",
        "NumUniqueValues": row["n_unique"],
        "UniqueValues": values,
        "Mode": row["mode"] if row["has_mode"] else NO_MODE,
    }


def _numeric_record(row) -> dict:
    return {
        "Name": row["field"],
        "Type": "Numeric",
        "Minimum": row["minimum"],
        "Maximum": row["maximum"],
        "Range": row["range"],
        "Average": row["average"],
        "Median": row["median"],
        "Mode": row["mode"] if row["has_mode"] else NO_MODE,
        "Variance": row["variance"],
        "Standard Deviation": row["stddev"],
        "First Quartile": row["q1"],
        "Third Quartile": row["q3"],
        "IQR": row["iqr"],
    }


def report(done: Profile) -> dict:
    """The report document. It holds one record per field, so only summaries reach the
    driver. ``UniqueValues`` names the parquet folder with the values of all text fields: field,
    value and n, each value once."""
    records = {}
    if done.numeric is not None:
        records |= {r["field"]: _numeric_record(r) for r in done.numeric.collect()}
    if done.strings is not None:
        records |= {r["field"]: _string_record(r, done.frequencies_path) for r in done.strings.collect()}
    empty = {"Numeric": {}, "String": {"NumUniqueValues": 0, "UniqueValues": done.frequencies_path, "Mode": NO_MODE}}
    fields = [
        records.get(name, {"Name": name, "Type": done.typed.kinds[name], **empty[done.typed.kinds[name]]})
        for name in done.typed.df.columns
    ]
    document = {**done.attributes, "No Of Fields": len(fields), "Fields": fields}
    for row in done.correlations.collect():
        document[f"Pearsons CC ({row['x']} Vs {row['y']})"] = row["r"]
    return document


def plain_number(value: object) -> object:
    """JSON has no infinite numbers, which become their names, and none that is no number, which becomes null."""
    if not isinstance(value, float) or math.isfinite(value):
        return value
    return None if math.isnan(value) else "Infinity" if value > 0 else "-Infinity"


def report_json(done: Profile) -> str:
    document = report(done)
    plain = {k: plain_number(v) for k, v in document.items()}
    plain["Fields"] = [{k: plain_number(v) for k, v in record.items()} for record in document["Fields"]]
    return json.dumps(plain, indent=4, allow_nan=False)


def write_report(done: Profile, path: str) -> None:
    """Write the report as one file of whatever filesystem the path is on."""
    write_text(done.typed.df.sparkSession, path, report_json(done))
