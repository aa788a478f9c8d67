"""The derived tables written in the layouts of the raw files, for the source queries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbstar.operators.date_order import DAY_FIRST
from curbstar.plans.load import JSON_PATHS, Delimited, JsonRecords
from curbstar.sources.readers import path_steps
from curbstar.sources.schemas import STAGING
from curbstar.sources.scratch import scratch_path
from workload import fixtures


@dataclass(frozen=True)
class Derived:
    """A staging table as a source that needs no file."""

    table: DataFrame

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return self.table


def derived_tables(spark: SparkSession, sf_dir: str) -> dict[str, Derived]:
    return {name: Derived(df) for name, df in fixtures.full_staging(spark, sf_dir).items()}


def write_delimited(df: DataFrame, sep: str, purpose: str) -> str:
    path = scratch_path(df.sparkSession, purpose)
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(header=True, sep=sep, quote='"', escape='"', **kept).csv(path)
    return path


def with_raw_names(df: DataFrame, table: str) -> DataFrame:
    """A code table under its raw field names."""
    names = [path_steps(text)[0] for text in JSON_PATHS[table]]
    return df.select(*[F.col(column).alias(name) for column, name in zip(STAGING[table].names, names)])


def write_json(df: DataFrame, table: str) -> str:
    """Records under their raw field names, one per line."""
    path = scratch_path(df.sparkSession, table)
    with_raw_names(df, table).write.json(path)
    return path


def write_json_array(df: DataFrame, purpose: str) -> str:
    """All records as one array in one file, each over several lines."""
    path = scratch_path(df.sparkSession, purpose)
    record = F.to_json(F.struct(*df.columns), {"pretty": "true"})
    rows = df.coalesce(1).select(record.alias("text"), F.monotonically_increasing_id().alias("place"))
    rows = rows.select(F.concat(F.when(F.col("place") == 0, "[").otherwise(","), F.col("text")).alias("text"))
    end = df.sparkSession.range(1).select(F.lit("]").alias("text"))
    rows.union(end).coalesce(1).write.text(path)
    return path


def write_path_list(spark: SparkSession, table: str) -> str:
    """A file that lists the record paths of a code table."""
    path = scratch_path(spark, "paths")
    spark.range(1).select(F.array(*[F.lit(p) for p in JSON_PATHS[table]]).alias("jsonpaths")).coalesce(1).write.json(path)
    return path


def with_date_order(df: DataFrame, order: str) -> DataFrame:
    """Issue dates as numbers in one order, expiration dates compact."""
    layout = "dd/MM/yyyy" if order == DAY_FIRST else "MM/dd/yyyy"
    return df.withColumn("issue_date", F.date_format("issue_date", layout)).withColumn(
        "vehicle_expiration_date", F.date_format("vehicle_expiration_date", "yyyyMMdd")
    )


def with_line_breaks(df: DataFrame) -> DataFrame:
    """Street names over several lines."""
    return df.withColumn("street_name", F.replace("street_name", F.lit(" "), F.lit("\n")))


def citations_file(spark: SparkSession, sf_dir: str, sep: str, where: Column | None = None) -> Delimited:
    raw = fixtures.raw_citations(spark, sf_dir, where)
    return Delimited(write_delimited(raw, sep, "citations"), sep, any_date=True)


def all_files(spark: SparkSession, sf_dir: str) -> dict[str, Delimited | JsonRecords]:
    """One raw source per staging table."""
    tables = fixtures.staging(spark, sf_dir)
    files: dict[str, Delimited | JsonRecords] = {
        "stage_violation": citations_file(spark, sf_dir, ";"),
        "stage_state": Delimited(write_delimited(tables["stage_state"], ";", "states"), ";"),
        "stage_violation_code": Delimited(
            write_delimited(tables["stage_violation_code"], ",", "codes")
        ),
    }
    for table in JSON_PATHS:
        files[table] = JsonRecords(write_json(tables[table], table), layout="lines")
    return files
