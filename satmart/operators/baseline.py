"""Monthly totals, the operating baseline of each entity, and saturation against it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from satmart.functions.numbers import half_even, percent
from satmart.operators.scale import exact_quantiles
from satmart.settings import Settings


def monthly_totals(fact: DataFrame, time: DataFrame, entity: str) -> DataFrame:
    """(entity, periodo, anio, total): summed before the time lookup, so the join is small."""
    totals = fact.groupBy(entity, "id_tiempo").agg(F.sum("cantidad_atenciones").alias("total"))
    return totals.join(time.select("id_tiempo", "periodo", "anio"), "id_tiempo").select(
        entity, "periodo", "anio", "total"
    )


def department_series(fact: DataFrame, time: DataFrame, geography: DataFrame) -> DataFrame:
    """(id_departamento, ds, anio, aten): monthly totals of the resolved departments.

    The fact is summed per month and geography before the two lookups and once more after.
    """
    totals = fact.groupBy("id_geografia", "id_tiempo").agg(
        F.sum("cantidad_atenciones").alias("aten")
    )
    districts = geography.where(F.col("id_departamento").isNotNull()).select(
        "id_geografia", "id_departamento"
    )
    months = time.select("id_tiempo", F.col("fecha_inicio").alias("ds"), "anio")
    return (
        totals.join(districts, "id_geografia")
        .join(months, "id_tiempo")
        .groupBy("id_departamento", "ds", "anio")
        .agg(F.sum("aten").alias("aten"))
    )


def _estimate(measure: Column, s: Settings) -> Column:
    if s.baseline_use_mean:
        return F.avg(measure)
    # Exact and per group: a group is one entity's months, so it stays small at any scale.
    return F.percentile(measure, s.baseline_percentile)


def _in_regime(year: str, s: Settings) -> Column:
    return ~F.col(year).isin(*s.excluded_years)


def baseline(
    series: DataFrame,
    entity: str,
    measure: str,
    s: Settings,
    year: str = "anio",
    min_months: int | None = None,
    places: int | None = None,
) -> DataFrame:
    """(entity, meses, linea_base): the estimate over months outside the excluded years.

    Support is the number of months with rows; under ``min_months`` the baseline is null.
    """
    months = F.count("*")
    estimate = _estimate(F.col(measure), s)
    if min_months is not None:
        estimate = F.when(months >= min_months, estimate)
    if places is not None:
        estimate = half_even(estimate, places)
    return (
        series.where(_in_regime(year, s))
        .groupBy(entity)
        .agg(months.alias("meses"), estimate.alias("linea_base"))
    )


def saturation(
    series: DataFrame,
    entity: str,
    measure: str,
    s: Settings,
    year: str = "anio",
    min_months: int | None = None,
    places: int | None = None,
) -> DataFrame:
    """Adds ``linea_base`` and ``ratio`` (percent of the baseline) to every month.

    The same baseline as ``baseline``, taken over a window: one shuffle on the entity instead
    of an aggregate, a join and a second read of the series.
    """
    own = W.partitionBy(entity)
    regular = F.when(_in_regime(year, s), F.col(measure))
    estimate = _estimate(regular, s).over(own)
    if min_months is not None:
        estimate = F.when(F.count(regular).over(own) >= min_months, estimate)
    if places is not None:
        estimate = half_even(estimate, places)
    return series.withColumn("linea_base", estimate).withColumn(
        "ratio", percent(F.col(measure), F.col("linea_base"))
    )


def apply_baseline(facilities: DataFrame, computed: DataFrame, entity: str) -> DataFrame:
    """Facility dimension with its computed baselines; facilities not computed keep theirs."""
    new = computed.select(
        entity,
        F.col("linea_base").cast("decimal(12,2)").alias("_new"),
        F.lit(True).alias("_computed"),
    )
    merged = facilities.join(new, entity, "left")
    return merged.withColumn(
        "linea_base_operativa",
        F.when(F.col("_computed"), F.col("_new")).otherwise(F.col("linea_base_operativa")),
    ).drop("_new", "_computed")


def coverage(computed: DataFrame) -> DataFrame:
    """One row: entities with data, those with a baseline and those without."""
    return computed.agg(
        F.count("*").alias("n_total"),
        F.count("linea_base").alias("n_with_base"),
        F.count_if(F.col("linea_base").isNull()).alias("n_without_base"),
    )


def distribution(df: DataFrame, column: str, decimals: int = 2) -> DataFrame:
    """One row: n, mean, std, min, quartiles and max of a column with few decimals."""
    quartiles = exact_quantiles(df, column, [0.25, 0.5, 0.75], decimals).agg(
        F.struct(
            *[
                F.max(F.when(F.col("probability") == p, F.col("value"))).alias(name)
                for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))
            ]
        )
    )
    return (
        df.agg(
            F.count(column).alias("n"),
            F.avg(column).alias("mean"),
            F.stddev_samp(column).alias("std"),
            F.min(column).alias("min"),
            F.max(column).alias("max"),
        )
        .withColumn("_q", quartiles.scalar())
        .select("n", "mean", "std", "min", "_q.p25", "_q.p50", "_q.p75", "max")
    )
