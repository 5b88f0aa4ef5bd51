"""Stops and fallbacks for missing input."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession

from satmart.sources.storage import exists


class MissingInputError(FileNotFoundError):
    """One or more inputs of a step are not there."""


class EmptyTableError(ValueError):
    """A step found its input table without rows."""


def require(spark: SparkSession, *paths: str) -> None:
    missing = [path for path in paths if not exists(spark, path)]
    if missing:
        raise MissingInputError("run the earlier steps first; missing:\n  " + "\n  ".join(missing))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise EmptyTableError(f"{what} is empty; run the step that fills it first")
    return df


def parquet_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An optional input: an empty table of the same schema when it is absent."""
    if exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    warnings.warn(f"optional input {path} is absent; going on without it", stacklevel=2)
    return spark.createDataFrame([], schema)
