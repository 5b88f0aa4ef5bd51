"""Facility registry: selection, geography, one row per name, and its profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satmart.functions.text import is_six_digits, normalize_geo_code, normalize_name_exact, trim_all
from satmart.operators.dimensions import keep_first
from satmart.settings import Settings


def _owned(s: Settings) -> Column:
    return F.lit(True) if s.institution is None else F.col("INSTITUCION") == s.institution


def active_facilities(raw: DataFrame, s: Settings) -> DataFrame:
    """Active facilities of the institution, with normalised name and code and validity flags."""
    code = normalize_geo_code(F.col("UBIGEO"))
    return (
        trim_all(raw)
        .where(_owned(s))
        .where(F.col("ESTADO") == s.active_state)
        .select(
            F.col("COD_IPRESS").alias("cod_ipress"),
            normalize_name_exact(F.col("NOMBRE")).alias("nombre_norm"),
            F.col("CATEGORIA").alias("categoria"),
            code.alias("ubigeo"),
            is_six_digits(code).alias("ubigeo_valido"),
            (F.col("CATEGORIA") != "0").alias("categoria_valida"),
            F.col("DEPARTAMENTO").alias("departamento"),
            F.col("PROVINCIA").alias("provincia"),
            F.col("DISTRITO").alias("distrito"),
        )
    )


def registry_geography(active: DataFrame) -> DataFrame:
    """Distinct valid geography rows; one code may still come with several spellings."""
    return (
        active.where("ubigeo_valido").select("ubigeo", "departamento", "provincia", "distrito")
    ).distinct()


def one_per_name(active: DataFrame) -> DataFrame:
    """Code and category of each normalised name; among repeats the lowest code is kept."""
    return keep_first(
        active.select("nombre_norm", "cod_ipress", "categoria"),
        ["nombre_norm"],
        ["cod_ipress", "categoria"],
    )


def registry_profile(raw: DataFrame, s: Settings) -> DataFrame:
    """(metric, value, expected, ok): totals, bad codes and repeats, against expected totals."""
    owned = trim_all(raw).withColumn("_owned", _owned(s))
    totals = owned.agg(
        F.count("*").alias("filas_totales"),
        F.count_if("_owned").alias("institucion"),
    )
    active = active_facilities(raw, s)
    quality = active.agg(
        F.count("*").alias("activos"),
        F.count_if(F.col("categoria") == "0").alias("categoria_0"),
        F.count_if(~F.col("ubigeo_valido")).alias("ubigeo_invalido"),
        (F.count("cod_ipress") - F.count_distinct("cod_ipress")).alias("cod_ipress_duplicados"),
        (F.count("nombre_norm") - F.count_distinct("nombre_norm")).alias("nombre_norm_duplicados"),
    )
    expected = {"filas_totales": s.expected_rows, "institucion": s.expected_institution_rows}
    report = totals.unpivot([], totals.columns, "metric", "value").unionByName(
        quality.unpivot([], quality.columns, "metric", "value")
    )
    target = F.lit(None).cast("bigint")
    for metric, count in expected.items():
        target = F.when(F.col("metric") == metric, F.lit(count).cast("bigint")).otherwise(target)
    return report.withColumn("expected", target).withColumn(
        "ok", F.col("value") == F.col("expected")
    )
