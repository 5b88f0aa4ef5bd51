"""Delimited text: ';', UTF-8 with BOM, a header, every column text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from satmart.functions.text import null_to_empty

BOM = "﻿"


def _dialect(reader, sep: str, multi_line: bool = False):
    return (
        reader.option("sep", sep)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
    )


def _text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def _as_text(raw: DataFrame) -> DataFrame:
    return raw.select(
        [null_to_empty(F.col(f"`{c}`")).alias(c.replace(BOM, "").strip()) for c in raw.columns]
    )


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    sep: str = ";",
    multi_line: bool = False,
) -> DataFrame:
    """Every column as text, empty fields as '', header names trimmed.

    Files are split by size, so one huge extract is read by many tasks; ``multi_line``
    (line breaks inside quotes) gives that up. With ``columns`` the header is not read first.
    """
    reader = _dialect(spark.read, sep, multi_line)
    if columns is not None:
        reader = reader.schema(_text_schema(columns))
    return _as_text(reader.csv(path))


def stream_delimited(
    spark: SparkSession, folder: str, columns: Sequence[str], sep: str = ";"
) -> DataFrame:
    """The same for files that arrive in a folder; a stream needs its columns named."""
    return _as_text(_dialect(spark.readStream, sep).schema(_text_schema(columns)).csv(folder))


def write_delimited(df: DataFrame, path: str, sep: str = ";", mode: str = "overwrite") -> None:
    """One file per partition, each with the BOM and the header; null and '' are empty fields."""
    first, *rest = df.columns
    marked = df.select(F.col(f"`{first}`").alias(BOM + first), *[F.col(f"`{c}`") for c in rest])
    (
        marked.write.mode(mode)
        .option("sep", sep)
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", "")
        .csv(path)
    )
