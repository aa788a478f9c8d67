"""Raw files to typed staging tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from curbstar.functions.dates import ANY_DATE_FORMATS, parse_any_date
from curbstar.operators.date_order import date_order_report, ordered_formats
from curbstar.sources.records import array_records, quoted_records


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    sep: str = ",",
    any_date: bool = False,
    date_formats: Sequence[str] = ANY_DATE_FORMATS,
    mode: str = "FAILFAST",
    multiline: bool | Literal["split"] = False,
    date_neighbours: Mapping[str, Column | None] | None = None,
) -> DataFrame:
    """Delimited text with one header line; fields bind to ``schema`` by position.

    A field in double quotes may hold the separator, and quotes written twice; a backslash is a
    plain character. ``multiline=True`` also allows line breaks inside quotes, and then a file
    is read by one task; ``multiline="split"`` allows them in a file that many tasks read. A bad number in a column that is not selected may go unseen, since only
    selected columns are converted.

    ``any_date=True`` reads dates in any of ``date_formats`` and turns any other text into
    null. With ``date_neighbours`` the order of day and month is found for each date column by
    ``operators.date_order`` before: the mapping names for a column a date of the same row, as an
    expression over the texts, that its dates lie close to, or None; ``{}`` goes by the values
    alone. An undecided column keeps the order of ``date_formats``. No other conversion is tolerant unless ``mode`` says so. An empty field is null.
    The files stay splittable, so one large file is read by many tasks.
    """
    if not any_date:
        return _delimited_rows(spark, path, schema, sep, mode, multiline)
    as_text = StructType(
        [
            StructField(f.name, StringType() if isinstance(f.dataType, DateType) else f.dataType)
            for f in schema
        ]
    )
    raw = _delimited_rows(spark, path, as_text, sep, mode, multiline)
    formats = {f.name: date_formats for f in schema}
    if date_neighbours is not None:
        dated = {f.name: date_neighbours.get(f.name) for f in schema if isinstance(f.dataType, DateType)}
        for row in date_order_report(raw, dated).collect():
            formats[row["column_name"]] = ordered_formats(date_formats, row["date_order"])
    return raw.select(
        *[
            parse_any_date(F.col(f.name), formats[f.name]).alias(f.name)
            if isinstance(f.dataType, DateType)
            else F.col(f.name)
            for f in schema
        ]
    )


def _delimited_rows(
    spark: SparkSession, path: str | list[str], schema: StructType, sep: str, mode: str, multiline: bool | Literal["split"]
) -> DataFrame:
    if multiline != "split":
        return _delimited(spark, sep, multiline).option("mode", mode).schema(schema).csv(path)
    records = quoted_records(spark, path).filter(~F.col("first"))
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": mode}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return records.select(F.from_csv("text", ddl, options).alias("record")).select("record.*")


def read_columns(
    spark: SparkSession,
    path: str | list[str],
    columns: Mapping[str, str],
    sep: str = ",",
    multiline: bool = False,
) -> DataFrame:
    """Chosen columns of a delimited file, by header name, as text under new names.

    Only the chosen fields are converted; nothing is inferred, so the data is read once.
    """
    raw = _delimited(spark, sep, multiline).csv(path)
    return raw.select(*[_field(name).alias(alias) for name, alias in columns.items()])


def _delimited(spark: SparkSession, sep: str, multiline: bool) -> DataFrameReader:
    quoting = {"header": True, "sep": sep, "quote": '"', "escape": '"', "multiLine": multiline}
    return spark.read.options(**quoting)


def read_json_paths(
    spark: SparkSession,
    path: str | list[str],
    paths: Sequence[str],
    schema: StructType,
    layout: Literal["lines", "array", "split_array"] = "lines",
) -> DataFrame:
    """JSON records to ``schema``: the n-th path fills the n-th column.

    A path is ``$['Class Code']``, ``$.code`` or a nesting of these. ``lines`` is one record
    per line and splittable. ``array`` is one pretty-printed array per file, which one task
    must read whole, so it is meant for lookups; ``split_array`` is an array that many tasks read.
    """
    if len(paths) != len(schema):
        raise ValueError(f"{len(paths)} paths for {len(schema)} columns")
    steps = [path_steps(text) for text in paths]
    wanted = StructType()
    for names, field in zip(steps, schema):
        wanted = _with_field(wanted, names, field)
    if layout == "split_array":
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted)
        record = F.from_json("text", ddl, {"mode": "FAILFAST"})
        raw = array_records(spark, path).select(record.alias("record")).select("record.*")
    else:
        raw = spark.read.schema(wanted).json(path, multiLine=layout == "array", mode="FAILFAST")
    return raw.select(
        *[_nested(names).alias(field.name) for names, field in zip(steps, schema)]
    )


def read_path_list(spark: SparkSession, path: str) -> list[str]:
    """The paths of a path-list file: one JSON object with a ``jsonpaths`` array."""
    schema = "jsonpaths array<string>"
    return list(spark.read.schema(schema).json(path, multiLine=True).first()["jsonpaths"])


def path_steps(path: str) -> list[str]:
    """Field names along a record path."""
    step = r"\[\s*'([^']+)'\s*\]|\.([A-Za-z_]\w*)"
    if not re.fullmatch(rf"\$(?:{step})+", path):
        raise ValueError(f"Unsupported record path: {path}")
    return [quoted or plain for quoted, plain in re.findall(step, path)]


def _with_field(schema: StructType, names: list[str], field: StructField) -> StructType:
    head, rest = names[0], names[1:]
    if not rest:
        return StructType(schema.fields + [StructField(head, field.dataType)])
    inner = schema[head].dataType if head in schema.names else StructType()
    kept = [f for f in schema.fields if f.name != head]
    return StructType(kept + [StructField(head, _with_field(inner, rest, field))])


def _field(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _nested(names: list[str]) -> Column:
    column = _field(names[0])
    for name in names[1:]:
        column = column.getField(name)
    return column
