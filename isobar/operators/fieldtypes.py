"""Field kinds from the first row, and how later rows fit them."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

from isobar.functions.nested import as_text
from isobar.functions.numbers import is_blank, is_invalid, kind_of
from isobar.functions.sql import ident, text


def field_types(df: DataFrame, first_by: str, infer: str = "regex") -> DataFrame:
    """Kind per field from the row that is first by ``first_by``, with the number of
    rows, blanks and (for numeric fields) values that do not cast, in one pass."""
    fields = df.columns
    values = [f"v{i}" for i in range(len(fields))]
    row = df.selectExpr(
        f"{ident(first_by)} AS first_by", *[f"{as_text(df, f)} AS {v}" for f, v in zip(fields, values)]
    ).selectExpr(
        f"min_by(struct({', '.join(values)}), first_by) AS head",
        "count(*) AS n",
        *[f"count_if({is_blank(v)}) AS blank_{v}" for v in values],
        *[f"count_if({is_invalid(v)}) AS bad_{v}" for v in values],
    )
    records = ", ".join(
        f"struct({text(f)} AS field, {kind_of(f'head.{v}', infer)} AS kind, "
        f"n AS n_rows, blank_{v} AS n_blank, bad_{v} AS bad)"
        for f, v in zip(fields, values)
    )
    return row.selectExpr(f"inline(array({records}))").selectExpr(
        "field", "kind", "n_rows", "n_blank", "if(kind = 'Numeric', bad, 0L) AS n_invalid"
    )


def field_kinds(df: DataFrame, first_by: str, infer: str = "regex") -> DataFrame:
    """Kind per field from the row that is first by ``first_by``; no other cell is looked at."""
    fields = df.columns
    values = [f"v{i}" for i in range(len(fields))]
    head = df.selectExpr(
        f"{ident(first_by)} AS first_by", f"struct({', '.join(map(ident, fields))}) AS row"
    ).selectExpr("min_by(row, first_by) AS row").selectExpr("row.*")
    texts = head.selectExpr(*[f"{as_text(head, f)} AS {v}" for f, v in zip(fields, values)])
    records = ", ".join(f"struct({text(f)} AS field, {kind_of(v, infer)} AS kind)" for f, v in zip(fields, values))
    return texts.selectExpr(f"inline(array({records}))")


def type_counts(types: DataFrame) -> DataFrame:
    """How many fields there are, and of which kind."""
    return types.selectExpr(
        "count(*) AS n_fields",
        "count_if(kind = 'Numeric') AS n_numeric",
        "count_if(kind = 'String') AS n_string",
    )


def sample_kinds(df: DataFrame, sample: dict[str, str | None], infer: str = "regex") -> dict[str, str]:
    """Kinds of one known sample row of texts, by the same expressions."""
    if not sample:
        return {}
    schema = T.StructType([T.StructField(f"v{i}", T.StringType()) for i in range(len(sample))])
    one = df.sparkSession.createDataFrame([tuple(sample.values())], schema)
    kinds = one.selectExpr(*[f"{kind_of(v, infer)} AS {v}" for v in one.columns]).head()
    return dict(zip(sample, kinds))
