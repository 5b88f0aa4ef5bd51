"""Fact load: surrogate-key resolution, the valid / reject split, and the valid-rate gate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ["id_tiempo", "id_establecimiento", "id_especialidad", "id_geografia"]
REQUIRED = KEYS + ["cantidad_atenciones"]


class ValidRateError(ValueError):
    """Too few fact rows resolved all their keys."""


def resolve_keys(
    fact: DataFrame,
    time: DataFrame,
    facilities: DataFrame,
    specialties: DataFrame,
    geography: DataFrame,
) -> DataFrame:
    """Adds the four surrogate keys and ``reason``: the required columns that are null.

    No join carries a hint. The dimensions are written tables, so their size is known and
    Catalyst broadcasts those under the session's threshold; above it AQE splits hot keys.
    """
    period = F.col("periodo").try_cast("int")
    resolved = (
        fact.withColumn("_periodo", period)
        .join(
            time.select("id_tiempo", F.col("periodo").alias("_periodo")), "_periodo", "left"
        )
        .join(facilities.select("id_establecimiento", "nombre_centro"), "nombre_centro", "left")
        .join(specialties.select("id_especialidad", "especialidad"), "especialidad", "left")
        .join(geography.select("id_geografia", "ubigeo"), "ubigeo", "left")
    )
    failed = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED])
    return resolved.select(*fact.columns, *KEYS, failed.alias("reason"))


def accepted(resolved: DataFrame) -> DataFrame:
    return resolved.where(F.col("reason") == "").drop("reason")


def rejected(resolved: DataFrame) -> DataFrame:
    return resolved.where(F.col("reason") != "")


def reject_reasons(resolved: DataFrame) -> DataFrame:
    """(key_name, n_failed): how many rows miss each required column."""
    counts = resolved.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in REQUIRED])
    return counts.unpivot([], REQUIRED, "key_name", "n_failed")


def valid_rate(resolved: DataFrame, threshold: float) -> DataFrame:
    """One row: rows, rows loaded and rejected, their rate, and whether it passes."""
    loaded = F.count_if(F.col("reason") == "")
    total = F.count("*")
    rate = F.coalesce(F.try_divide(loaded.cast("double"), total), F.lit(0.0))
    return resolved.agg(
        total.alias("n_total"),
        loaded.alias("n_loaded"),
        (total - loaded).alias("n_rejected"),
        rate.alias("valid_rate"),
        (rate >= threshold).alias("passes"),
    )


def require_valid_rate(resolved: DataFrame, threshold: float) -> None:
    row = valid_rate(resolved, threshold).first()
    if not row.passes:
        raise ValidRateError(f"valid rate {row.valid_rate:.2%} is under {threshold:.0%}")
