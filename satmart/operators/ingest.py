"""Attendance extract: cleaning, one-pass aggregation to the fact grain, and its profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satmart.functions.numbers import lenient_long
from satmart.functions.periods import period_start
from satmart.functions.text import normalize_geo_code, trim_all, trim_ws
from satmart.settings import Settings

# Source column -> warehouse column.
COLUMNS = {
    "PERIODO": "periodo",
    "SES_DESCAS": "nombre_centro",
    "DES_SER": "especialidad",
    "SES_DESRED": "red_asistencial",
    "UBIGEO": "ubigeo",
    "DEPARTAMENTO": "departamento",
    "PROVINCIA": "provincia",
    "DISTRITO": "distrito",
}

FACT_GRAIN = ["periodo", "nombre_centro", "especialidad", "ubigeo"]
GEOGRAPHY = ["departamento", "provincia", "distrito"]
OBSERVATION_GRAIN = FACT_GRAIN + ["red_asistencial"] + GEOGRAPHY
OBSERVATION_SCHEMA = ", ".join(
    [f"{name} string" for name in ["actividad", *OBSERVATION_GRAIN]]
    + [f"{name} bigint" for name in ("cantidad", "n", "n_bad", "n_rows")]
)


def cleaned(raw: DataFrame, activity: str | None = None) -> DataFrame:
    """Rows trimmed, with activity, normalised geo code and whole quantity (null if bad).

    With an activity, rows of others keep only what ``observations`` reads of them, activity and
    specialty: the rest is null before it would be trimmed.
    """
    renamed = [
        (normalize_geo_code(F.col(old)) if old == "UBIGEO" else F.col(old)).alias(new)
        for old, new in COLUMNS.items()
    ]
    if activity is not None:
        named = raw.toDF(*[name.strip() for name in raw.columns])
        own = named.withColumn("_own", trim_ws(F.col("DES_ACT")) == activity)
        raw = own.withColumns({
            old: F.when(F.col("_own"), F.col(old))
            for old in [*COLUMNS, "CANTIDAD"] if old != "DES_SER"}).drop("_own")
    return trim_all(raw).select(
        *renamed, F.col("DES_ACT").alias("actividad"),
        lenient_long(F.col("CANTIDAD")).alias("cantidad"),
    )


def clean_attendance(raw: DataFrame, activity: str) -> DataFrame:
    """Cleaned rows of one activity."""
    return cleaned(raw).where(F.col("actividad") == activity).drop("actividad")


def observations(rows: DataFrame, activity: str) -> DataFrame:
    """Per grain and spelling: quantity, rows with a quantity (n) and rows without (n_bad).

    Takes cleaned rows of every activity. Those of others shrink to one row per activity, with or
    without specialty, and count in ``n_rows`` alone, for the profile of the whole extract.
    The fact, both dominant-value counts and the row counters are sums over this one aggregate,
    so the raw extract is cleaned once whatever is built from it. Counting the bad rows here
    and not in an observed metric keeps the counts right when lost tasks run again.
    """
    own = F.col("actividad") == activity
    blank = F.col("especialidad") == ""
    grain = [
        F.when(own | blank if c == "especialidad" else own, F.col(c)).alias(c)
        for c in OBSERVATION_GRAIN
    ]
    return rows.groupBy("actividad", *grain).agg(
        F.sum(F.when(own, F.col("cantidad"))).alias("cantidad"),
        F.count(F.when(own, F.col("cantidad"))).alias("n"),
        F.count_if(own & F.col("cantidad").isNull()).alias("n_bad"),
        F.count("*").alias("n_rows"),
    )


def merge_observations(parts: DataFrame) -> DataFrame:
    """Observations of several loads added up."""
    sums = [F.sum(c).alias(c) for c in ("cantidad", "n", "n_bad", "n_rows")]
    return parts.groupBy("actividad", *OBSERVATION_GRAIN).agg(*sums)


def with_month(rows: DataFrame, s: Settings) -> DataFrame:
    """Adds ``mes``: the period as a number where it is a valid one, else 0. So it has a few hundred
    values at most, whatever the extract holds."""
    day = period_start(F.col("periodo"))
    valid = F.year(day).between(s.first_year, s.last_year)
    return rows.withColumn(
        "mes", F.when(valid, F.col("periodo").try_cast("int")).otherwise(0).cast("int"))


def fact_aggregate(rows: DataFrame) -> DataFrame:
    """Quantity at the fact grain, from clean rows or from observations."""
    return (
        rows.where(F.col("cantidad").isNotNull())
        .groupBy(*FACT_GRAIN)
        .agg(F.sum("cantidad").alias("cantidad_atenciones"))
    )


def row_counts(observed: DataFrame) -> DataFrame:
    """One row: rows read, rows of the activity, bad quantities and blank specialties among them."""
    rows = F.col("n") + F.col("n_bad")
    blank = F.when(F.col("especialidad") == "", rows).otherwise(0)
    counts = {
        "filas_leidas": F.col("n_rows"),
        "filas_consultas": rows, "cantidad_no_numerica": F.col("n_bad"), "especialidad_vacia": blank
    }
    return observed.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(k) for k, c in counts.items()])


def long_format(one_row: DataFrame) -> DataFrame:
    """(metric, value) from a one-row report."""
    return one_row.unpivot([], one_row.columns, "metric", "value")


def ingest_profile(
    observed: DataFrame,
    fact: DataFrame,
    time: DataFrame,
    specialties: DataFrame,
    facilities: DataFrame,
    geography: DataFrame,
) -> DataFrame:
    """The extract's profile as (metric, value)."""
    parts = [
        row_counts(observed),
        fact.agg(
            F.count("*").alias("filas_hecho"),
            F.sum("cantidad_atenciones").alias("cantidad_total"),
        ),
        facilities.agg(
            F.count("*").alias("establecimientos"),
            F.count_if("nombre_excede_150").alias("nombre_centro_excede_150"),
        ),
        specialties.agg(F.count("*").alias("especialidades")),
        time.agg(
            F.count("*").alias("periodos"),
            F.min("periodo").cast("bigint").alias("periodo_min"),
            F.max("periodo").cast("bigint").alias("periodo_max"),
        ),
        geography.agg(F.count("*").alias("ubigeos")),
    ]
    report = long_format(parts[0])
    for part in parts[1:]:
        report = report.unionByName(long_format(part))
    return report


def activity_counts(observed: DataFrame) -> DataFrame:
    """Rows per activity and, among them, rows without specialty."""
    blank = F.when(F.col("especialidad") == "", F.col("n_rows")).otherwise(0)
    return (
        observed.groupBy(F.col("actividad").alias("des_act"))
        .agg(F.sum("n_rows").alias("n"), F.sum(blank).alias("n_blank_specialty"))
        .orderBy(F.desc("n"), "des_act")
    )


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows per value, most frequent first; ``top`` keeps the first few as a report."""
    counts = df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)
    return counts if top is None else counts.limit(top)
