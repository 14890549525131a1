"""Literal rows and text-line files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rillet.schemas import LINES


def from_rows(spark: SparkSession, rows: Iterable, schema: T.StructType = LINES) -> DataFrame:
    """A bounded table from literal rows with a declared schema.

    For fixtures and examples only; real inputs come from files or streams.
    """
    return spark.createDataFrame(list(rows), schema)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of a text file or folder, column ``line``."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def read_text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming form of :func:`read_text_lines` over a folder of files."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path).withColumnRenamed("value", "line")


def read_csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """A one-column CSV table of lines (S3).

    A plain CSV reader cuts a line at its first comma, so the file is read as
    text: each physical line is the value, with an optional pair of
    surrounding double quotes removed and doubled quotes undone.
    """
    from pyspark.sql import functions as F

    raw = spark.read.text(path).select(F.col("value").alias("line"))
    quoted = F.col("line").rlike('^".*"$')
    unq = F.regexp_replace(F.expr("substring(line, 2, length(line) - 2)"), '""', '"')
    return raw.select(F.when(quoted, unq).otherwise(F.col("line")).alias("line"))
