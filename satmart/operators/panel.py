"""Dense monthly panels, lags, and the splice of actuals and projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from satmart.functions.numbers import percent
from satmart.functions.periods import month_range
from satmart.settings import Settings

# The lags the classifier reads, in months.
RATIO_LAGS = (1, 2, 3, 12)
MEASURE_LAGS = (1, 12)
LAG_COLUMNS = [f"ratio_lag{k}" for k in RATIO_LAGS] + [f"aten_lag{k}" for k in MEASURE_LAGS]


def densify(
    series: DataFrame,
    entity: str,
    month: str = "ds",
    first: Column | None = None,
    last: Column | None = None,
) -> DataFrame:
    """One row per entity and month; months without a row get nulls.

    ``first`` and ``last`` bound the calendar; without them each entity spans its own months.
    Each row brings forth the gap before it and the last one also the gap after it, so no
    calendar is joined and the only shuffle is the one on the entity that lags need anyway.
    """
    order = W.partitionBy(entity).orderBy(month)
    previous = F.lag(month).over(order)
    following = F.lead(month).over(order)
    start = F.coalesce(F.add_months(previous, 1), F.lit(None) if first is None else first, month)
    end = F.col(month)
    if last is not None:
        end = F.when(following.isNull(), last).otherwise(end)
    rest = [c for c in series.columns if c not in (entity, month)]
    spans = series.withColumn("_start", start).withColumn("_end", end)
    months = spans.withColumn("_month", F.explode(month_range(F.col("_start"), F.col("_end"))))
    here = F.col("_month") == F.col(month)
    return months.select(
        entity,
        F.col("_month").alias(month),
        *[F.when(here, F.col(c)).alias(c) for c in rest],
    )


def calendar_panel(series: DataFrame, entity: str, month: str = "ds") -> DataFrame:
    """Every entity on the calendar between the first and the last month of the whole table."""
    first = series.agg(F.min(month)).scalar()
    last = series.agg(F.max(month)).scalar()
    return densify(series, entity, month, first, last)


def add_lags(panel: DataFrame, entity: str, month: str = "ds") -> DataFrame:
    """Ratio and measure of earlier months. The panel must be dense: lags count rows."""
    order = W.partitionBy(entity).orderBy(month)
    ratios = {f"ratio_lag{k}": F.lag("ratio", k).over(order) for k in RATIO_LAGS}
    measures = {f"aten_lag{k}": F.lag("aten", k).over(order) for k in MEASURE_LAGS}
    return panel.withColumns(ratios | measures)


def panel_features(saturated: DataFrame, entity: str) -> DataFrame:
    """Lags and calendar features of every department-month, from its series with ratio."""
    panel = calendar_panel(saturated.select(entity, "ds", "aten", "ratio"), entity)
    return add_lags(panel, entity).select(
        entity, "ds", F.month("ds").alias("mes"), F.year("ds").alias("anio"), "aten", "ratio",
        *LAG_COLUMNS,
    )


def splice_features(
    series: DataFrame, projection: DataFrame, baseline: DataFrame, entity: str, s: Settings
) -> DataFrame:
    """Features of every projected month, over actuals spliced with projections.

    ``projection`` holds (entity, ds, aten). For a month with both, the actual wins; a month
    may use the projection of an earlier one as its lag. Rows with missing lags are kept here
    and dropped by ``complete``.
    """
    actual = series.where(F.col("ds") >= F.lit(s.splice_start)).select(
        entity, "ds", F.col("aten").alias("actual"), F.lit(None).cast("double").alias("projected")
    )
    future = projection.select(
        entity, "ds", F.lit(None).cast("bigint").alias("actual"),
        F.col("aten").cast("double").alias("projected"),
    )
    spliced = (
        actual.unionByName(future)
        .groupBy(entity, "ds")
        .agg(F.max("actual").alias("actual"), F.max("projected").alias("projected"))
        .withColumn("aten", F.coalesce(F.col("actual").cast("double"), "projected"))
        .withColumn("is_projected", F.col("projected").isNotNull())
        .drop("actual", "projected")
    )
    dense = densify(spliced, entity)
    rated = (
        dense.join(baseline.select(entity, "linea_base"), entity, "left")
        .withColumn("ratio", percent(F.col("aten"), F.col("linea_base")))
        .drop("linea_base")
    )
    return (
        add_lags(rated, entity)
        .where("is_projected")
        .select(
            entity, "ds", F.month("ds").alias("mes"), F.year("ds").alias("anio"), "aten", "ratio",
            *LAG_COLUMNS,
        )
    )


def complete(features: DataFrame) -> DataFrame:
    """Rows with the ratio and every lag."""
    return features.dropna(subset=["ratio", *LAG_COLUMNS])


def dropped_counts(features: DataFrame) -> DataFrame:
    """One row: projected months, those with complete features, and those dropped."""
    whole = F.lit(True)
    for name in ["ratio", *LAG_COLUMNS]:
        whole = whole & F.col(name).isNotNull()
    return features.agg(
        F.count("*").alias("n_projected"),
        F.count_if(whole).alias("n_kept"),
        (F.count("*") - F.count_if(whole)).alias("n_dropped"),
    )
