"""Checks that stand for the warehouse's constraints: each returns one row per check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satmart.sources.schemas import FOREIGN_KEYS, NOT_NULL, UNIQUE_KEYS, WIDTHS


class QualityError(ValueError):
    """A table breaks one of its declared rules."""


def _row(df: DataFrame, table: str, column: str, violations: Column) -> DataFrame:
    return df.agg(violations.cast("bigint").alias("n_violations")).select(
        F.lit(table).alias("table_name"), F.lit(column).alias("check_column"), "n_violations"
    )


def unique_violations(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)
    return _row(repeated, table, ",".join(keys), F.count("*"))


def foreign_key_violations(
    child: DataFrame, parent: DataFrame, table: str, column: str
) -> DataFrame:
    """Child rows whose non-null key has no parent.

    Child keys are counted before the anti join, so a hot key is one row of it.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    orphans = keys.join(parent.select(column), column, "left_anti")
    return _row(orphans, table, column, F.coalesce(F.sum("n"), F.lit(0)))


def _one_pass(df: DataFrame, table: str, violations: dict[str, Column]) -> DataFrame:
    counts = df.agg(*[F.count_if(v).cast("bigint").alias(c) for c, v in violations.items()])
    return counts.unpivot([], list(violations), "check_column", "n_violations").select(
        F.lit(table).alias("table_name"), "check_column", "n_violations"
    )


def null_violations(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    return _one_pass(df, table, {c: F.col(c).isNull() for c in columns})


def length_violations(df: DataFrame, table: str, widths: dict[str, int]) -> DataFrame:
    return _one_pass(df, table, {c: F.length(c) > n for c, n in widths.items()})


def domain_violations(df: DataFrame, table: str, column: str, domain: Sequence[str]) -> DataFrame:
    return _one_pass(df, table, {column: ~F.col(column).isin(*domain)})


def _union(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def unique_in_one_pass(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Repeated values of each key, of one column or of several parted by commas.

    64-bit digests of all keys are counted together, in one exchange. Only rows whose digest is there
    twice are looked at as they are, so two values that share a digest are told apart.
    """
    def listed(*values) -> DataFrame:
        return df.select(F.explode(F.array(*values)).alias("key")).select("key.*")

    own = {k: [F.col(c) for c in k.split(",")] for k in keys}
    digests = listed(*[
        F.struct(F.lit(k).alias("check_column"), F.xxhash64(*cs).alias("digest"))
        for k, cs in own.items()])
    twice = digests.groupBy("check_column", "digest").agg(F.count("*").alias("n")).where(
        "n > 1").drop("n")
    suspects = listed(*[
        F.struct(F.lit(k).alias("check_column"), F.xxhash64(*cs).alias("digest"),
                 F.array(*[c.cast("string") for c in cs]).alias("value"))
        for k, cs in own.items()]).join(twice, ["check_column", "digest"], "left_semi")
    counted = suspects.groupBy("check_column", "value").agg(F.count("*").alias("n"))
    repeated = {k: (F.col("check_column") == k) & (F.col("n") > 1) for k in keys}
    return _one_pass(counted, table, repeated)


def check_unique(tables: dict[str, DataFrame]) -> DataFrame:
    """Declared keys of each table, all in one pass over it."""
    return _union([
        unique_in_one_pass(tables[table], table, keys)
        for table, keys in UNIQUE_KEYS.items() if table in tables
    ])


def check_foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    return _union(
        [
            foreign_key_violations(tables[child], tables[parent], child, column)
            for child, column, parent in FOREIGN_KEYS
            if child in tables and parent in tables
        ]
    )


def check_not_null(tables: dict[str, DataFrame]) -> DataFrame:
    return _union(
        [null_violations(tables[t], t, cs) for t, cs in NOT_NULL.items() if t in tables]
    )


def check_lengths(tables: dict[str, DataFrame]) -> DataFrame:
    return _union(
        [length_violations(tables[t], t, ws) for t, ws in WIDTHS.items() if t in tables]
    )


def check_declared(tables: dict[str, DataFrame]) -> DataFrame:
    """Keys, required columns and widths of the given tables in one report."""
    return _union([check_unique(tables), check_not_null(tables), check_lengths(tables)])


def enforce(checks: DataFrame) -> None:
    """Raise when any check found violations. Brings back only the failed checks' rows."""
    failed = checks.where(F.col("n_violations") > 0).collect()
    if failed:
        lines = [f"{r.table_name}.{r.check_column}: {r.n_violations}" for r in failed]
        raise QualityError("violations found:\n  " + "\n  ".join(lines))
