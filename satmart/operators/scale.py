"""Order statistics and ranks over groups of any size, without one task holding a group."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from satmart.sources.storage import Stage

_PARTS = 1 << 16  # parts that a range of values is cut into
_CLASSES = 256  # groups whose range counts are broadcast: a class column, never an entity


@dataclass(frozen=True)
class _Range:
    """Values low to high of a column, how many rows lie below them, and the ranks sought in them."""

    column: str
    low: int
    high: int
    below: int
    ranks: tuple[int, ...]

    @property
    def width(self) -> int:
        return -(-(self.high - self.low + 1) // _PARTS)


def exact_quantiles(
    df: DataFrame, columns: str | Sequence[str], probabilities: Sequence[float], decimals: int = 2
) -> DataFrame:
    """(column, probability, value): linearly interpolated quantiles of whole columns.

    ``percentile`` would collect every distinct value in one task. Values with a fixed number of
    decimals are whole numbers of the last place, which are counted once, for all columns together,
    and written. Ranks are then found by radix: a range is cut into 2^16 parts, their counts tell
    which parts hold the ranks, and those are cut again, four times at most for 64 bits. A round
    looks for all ranks of all columns and brings one row for each to the driver. A column without
    values gives no row.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    unit, spark = 10**decimals, df.sparkSession
    values = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.bround(F.col(c) * unit).cast("bigint").alias("v"))
        for c in names
    ])).alias("x")
    counted = Stage(spark)(
        df.select(values).select("x.*").where("v IS NOT NULL")
        .groupBy("column", "v").agg(F.count("*").alias("n")),
        "counted")
    spans = counted.groupBy("column").agg(
        F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).collect()
    positions = {(r.column, p): p * (r.n - 1) for r in spans for p in probabilities}
    ranges = [
        _Range(r.column, r.low, r.high, 0, tuple(sorted(
            {f(positions[r.column, p]) for p in probabilities for f in (math.floor, math.ceil)})))
        for r in spans
    ]
    found: dict[tuple[str, int], int] = {}
    while ranges:
        found |= {(r.column, k): r.low for r in ranges if r.low == r.high for k in r.ranks}
        ranges = _narrowed(counted, [r for r in ranges if r.low < r.high])
    rows = []
    for (column, p), at in positions.items():
        low, high = (found[column, f(at)] / unit for f in (math.floor, math.ceil))
        rows.append((column, float(p), low + (high - low) * (at - math.floor(at))))
    return spark.createDataFrame(rows, "column string, probability double, value double")


def _narrowed(counted: DataFrame, ranges: list[_Range]) -> list[_Range]:
    """The parts of the ranges that hold their ranks."""
    if not ranges:
        return []
    number = F.coalesce(*[
        F.when((F.col("column") == r.column) & F.col("v").between(r.low, r.high), F.lit(i))
        for i, r in enumerate(ranges)
    ])
    part = F.coalesce(*[
        F.when(F.col("range") == i, F.floor((F.col("v") - r.low) / r.width))
        for i, r in enumerate(ranges)
    ])
    upto = W.partitionBy("range").orderBy("part")
    sums = (
        counted.withColumn("range", number).where("range IS NOT NULL").withColumn("part", part)
        .groupBy("range", "part").agg(F.sum("n").alias("n"))
        .withColumn("upto", F.sum("n").over(upto))
    )
    below = F.coalesce(*[F.when(F.col("range") == i, F.lit(r.below)) for i, r in enumerate(ranges)])
    wanted = F.coalesce(*[
        F.when(F.col("range") == i, F.array(*map(F.lit, r.ranks))) for i, r in enumerate(ranges)])
    sums = sums.withColumn("below", below + F.col("upto") - F.col("n"))
    ranks = F.filter(wanted, lambda k: (k >= F.col("below")) & (k < F.col("below") + F.col("n")))
    hits = sums.withColumn("ranks", ranks).where(F.size("ranks") > 0).collect()
    result = []
    for h in hits:
        r = ranges[h.range]
        low = r.low + h.part * r.width
        result.append(_Range(r.column, low, min(low + r.width - 1, r.high), h.below, tuple(h.ranks)))
    return result


def position_by_digest(
    df: DataFrame, group: str, digest: Column, digits: int = 3
) -> DataFrame:
    """Adds ``position``: the row's place (from 1) in its group, ordered by a hex digest.

    Same numbers as ``row_number() over (partition by group order by digest)``. A group may
    hold most of the table, so it is cut into 16^digits even ranges of the digest; rows are
    numbered inside a range and shifted by the counts of the ranges before it.
    """
    classes = df.select(group).distinct().limit(_CLASSES + 1).count()
    if classes > _CLASSES:
        raise ValueError(f"{group} has over {_CLASSES} values; it must be a class")
    keyed = df.withColumn("_digest", digest).withColumn(
        "_range", F.substring("_digest", 1, digits)
    )
    before = W.partitionBy(group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    # One row per group and range: groups are a handful of classes, ranges are 16^digits.
    offsets = (
        keyed.groupBy(group, "_range")
        .agg(F.count("*").alias("_n"))
        .select(group, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = W.partitionBy(group, "_range").orderBy("_digest")
    return (
        keyed.join(F.broadcast(offsets), [group, "_range"])
        .withColumn("position", F.col("_before") + F.row_number().over(inside))
        .drop("_digest", "_range", "_before")
    )
