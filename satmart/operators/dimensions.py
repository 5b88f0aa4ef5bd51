"""Dimensions of the star: dominant values, priority unions, enrichment, hierarchy and keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from satmart.functions.periods import month_name, period_start, semester
from satmart.functions.text import empty_to_null, is_six_digits, normalize_name_exact
from satmart.operators.ingest import GEOGRAPHY
from satmart.settings import Settings


def _first_by(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Per key, the row that comes first in the given order.

    The least struct is an aggregate: every map task sends one candidate per key, so a key
    with a third of the rows costs no more than any other. A window would sort all its rows.
    """
    return df.groupBy(*key).agg(F.min(F.struct(*order)).alias("_first"))


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key; ``order`` lists every other column, so the choice is total."""
    return _first_by(df, key, order).select(*key, *[F.col(f"_first.{c}").alias(c) for c in order])


def dominant(observed: DataFrame, key: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """Per key, the attribute values seen most often, with their count ``n``.

    Counts come in as column ``n``; ties go to the lowest attribute values.
    """
    counts = (
        observed.where(F.col("n") > 0).groupBy(*key, *attributes).agg(F.sum("n").alias("n"))
    )
    first = _first_by(counts, key, [(-F.col("n")).alias("minus_n"), *attributes])
    return first.select(
        *key,
        *[F.col(f"_first.{a}").alias(a) for a in attributes],
        (-F.col("_first.minus_n")).alias("n"),
    )


def with_sequence_key(df: DataFrame, key_name: str, natural_key: str) -> DataFrame:
    """Consecutive surrogate keys. Only for dimensions whose natural key bounds their size:
    periods, six-digit geo codes and two-digit department codes."""
    number = F.row_number().over(W.orderBy(natural_key)).cast("bigint")
    return df.select(number.alias(key_name), *df.columns)


def with_lasting_key(
    df: DataFrame, key_name: str, natural_key: str, known: DataFrame | None
) -> DataFrame:
    """Sequence keys that a later load keeps: ``known`` (clave, id) are those given before, new
    natural keys are numbered in their order above the highest of them.

    For the same bounded dimensions as ``with_sequence_key``."""
    if known is None:
        return with_sequence_key(df, key_name, natural_key)
    given = known.select(F.col("clave").alias("_clave"), F.col("id").alias("_id"))
    rows = df.join(given, F.col(natural_key).cast("string") == F.col("_clave"), "left")
    new = F.sum(F.col("_id").isNull().cast("bigint")).over(W.orderBy(natural_key))
    top = known.agg(F.coalesce(F.max("id"), F.lit(0).cast("bigint"))).scalar()
    return rows.withColumn("_new", new).select(
        F.coalesce("_id", top + F.col("_new")).alias(key_name), *df.columns)


def keys_given(dimension: str, table: DataFrame, key_name: str, natural_key: str) -> DataFrame:
    """The rows of the key registry that a dimension stands for."""
    return table.select(
        F.lit(dimension).alias("dimension"), F.col(natural_key).cast("string").alias("clave"),
        F.col(key_name).alias("id"))


def with_hash_key(df: DataFrame, key_name: str, natural_key: str) -> DataFrame:
    """Surrogate keys for dimensions without a bound: no task sees the whole table, and a
    reload gives the same keys. ``quality.check_unique`` reports a collision."""
    return df.select(F.xxhash64(natural_key).alias(key_name), *df.columns)


def time_dimension(fact: DataFrame, s: Settings, known: DataFrame | None = None) -> DataFrame:
    """One row per valid period found in the fact, within the first and the last valid year."""
    day = F.col("fecha_inicio")
    # The day names the count, so that it is read off each period and not off each row: Catalyst
    # would move a rule of the key alone below the aggregate.
    start = F.when(F.col("_n") > 0, period_start(F.col("periodo")))
    periods = (
        fact.groupBy("periodo")
        .agg(F.count("*").alias("_n"))
        .withColumn("fecha_inicio", start)
        .where(F.year(day).between(s.first_year, s.last_year))
    )
    rows = periods.select(
        F.col("periodo").cast("int").alias("periodo"),
        F.year(day).alias("anio"),
        F.month(day).alias("mes"),
        month_name(F.month(day)).alias("nombre_mes"),
        F.quarter(day).alias("trimestre"),
        semester(F.month(day)).alias("semestre"),
        day,
    )
    return with_lasting_key(rows, "id_tiempo", "periodo", known)


def specialty_dimension(fact: DataFrame) -> DataFrame:
    """One row per named specialty; the area catalogue is still open, so it is null."""
    rows = (
        fact.where(F.col("especialidad") != "")
        .select("especialidad")
        .distinct()
        .withColumn("area", F.lit(None).cast("string"))
    )
    return with_hash_key(rows, "id_especialidad", "especialidad")


def observed_geography(observed: DataFrame) -> DataFrame:
    return dominant(observed, ["ubigeo"], GEOGRAPHY)


def observed_facilities(observed: DataFrame) -> DataFrame:
    return dominant(observed, ["nombre_centro"], ["red_asistencial", "ubigeo"])


def geography_union(attendance_geo: DataFrame, registry_geo: DataFrame | None) -> DataFrame:
    """One row per valid geo code; the registry only adds codes that attendance lacks."""
    columns = ["ubigeo", *GEOGRAPHY]
    rows = attendance_geo.select(*columns, F.lit(1).alias("priority"))
    if registry_geo is not None:
        rows = rows.unionByName(registry_geo.select(*columns, F.lit(2).alias("priority")))
    first = keep_first(
        rows.where(is_six_digits(F.col("ubigeo"))), ["ubigeo"], ["priority", *GEOGRAPHY]
    )
    source = F.when(F.col("priority") == 1, "atenciones").otherwise("registro")
    return first.select(*columns, source.alias("source"))


def geography_dimension(union: DataFrame, known: DataFrame | None = None) -> DataFrame:
    return with_lasting_key(union.select("ubigeo", *GEOGRAPHY), "id_geografia", "ubigeo", known)


def named_facilities(facilities: DataFrame) -> DataFrame:
    """Adds the normalised name and the flag for names over the declared width."""
    return facilities.withColumn(
        "nombre_norm", normalize_name_exact(F.col("nombre_centro"))
    ).withColumn("nombre_excede_150", F.length("nombre_centro") > 150)


def enrich_facilities(named: DataFrame, registry_names: DataFrame | None) -> DataFrame:
    """Adds registry code and category by normalised name, null where no name matches."""
    if registry_names is None:
        missing = F.lit(None).cast("string")
        return named.withColumn("cod_ipress", missing).withColumn("categoria", missing)
    return named.join(registry_names, "nombre_norm", "left")


def facility_dimension(enriched: DataFrame, geography: DataFrame) -> DataFrame:
    """Facilities with their geography key; the baseline is filled in by a later step."""
    keyed = enriched.join(geography.select("ubigeo", "id_geografia"), "ubigeo", "left")
    rows = keyed.select(
        "nombre_centro",
        empty_to_null(F.col("red_asistencial")).alias("red_asistencial"),
        "cod_ipress",
        "categoria",
        "id_geografia",
        F.lit(None).cast("decimal(12,2)").alias("linea_base_operativa"),
        F.when(F.col("id_geografia").isNotNull(), F.col("ubigeo")).alias("ubigeo_resolved"),
        "nombre_excede_150",
    )
    return with_hash_key(rows, "id_establecimiento", "nombre_centro")


def match_rate(facilities: DataFrame) -> DataFrame:
    """One row: facilities, how many the registry matched, and how many lack geography."""
    matched = F.col("cod_ipress").isNotNull()
    return facilities.agg(
        F.count("*").alias("n_total"),
        F.count_if(matched).alias("n_matched"),
        F.coalesce(F.avg(matched.cast("double")), F.lit(0.0)).alias("match_rate"),
        F.count_if(F.col("id_geografia").isNull()).alias("n_without_geography"),
    )


def department_code(ubigeo: Column) -> Column:
    return F.substring(ubigeo, 1, 2)


def department_names(fact: DataFrame, geography: DataFrame) -> DataFrame:
    """Departments that have facts, under the name most of their fact rows carry.

    Rows are counted per geography before the lookup, so the join sees codes, not facts.
    """
    per_geography = fact.groupBy("id_geografia").agg(F.count("*").alias("n"))
    observed = per_geography.join(geography, "id_geografia").select(
        department_code(F.col("ubigeo")).alias("codigo_departamento"),
        F.col("departamento").alias("nombre"),
        "n",
    )
    return dominant(observed, ["codigo_departamento"], ["nombre"])


def department_dimension(names: DataFrame, known: DataFrame | None = None) -> DataFrame:
    return with_lasting_key(
        names.select("codigo_departamento", "nombre"), "id_departamento", "codigo_departamento",
        known,
    )


def backfill_department(geography: DataFrame, departments: DataFrame) -> DataFrame:
    """Every district inherits its department by the first two digits of its code."""
    codes = departments.select("id_departamento", "codigo_departamento")
    bare = geography.drop("id_departamento", "codigo_departamento")
    return bare.join(
        codes, department_code(bare["ubigeo"]) == codes["codigo_departamento"], "left"
    )
