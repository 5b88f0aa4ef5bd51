"""The batch jobs over a published warehouse, in the order they are run:
load_star, compute_baseline, load_departments, run_forecast, run_classification; add_attendance and
replay_quarantine go on from a loaded star. Each returns its report as a DataFrame. export_staging
writes text files instead.

A job reads one release and publishes the next one; it is refused if another job has changed what it
read, and can then be run again.

Intermediate tables go to ``stage``; the caller may clear it once the report was read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satmart.functions.levels import DOMAINS
from satmart.operators import baseline as bl
from satmart.operators import classify, dimensions, facts, forecast, ingest, panel, quality
from satmart.operators import registry, waves
from satmart.plans.star import Star
from satmart.settings import Settings
from satmart.sources.delimited import write_delimited
from satmart.sources.guards import require_rows
from satmart.sources.storage import Stage
from satmart.sources.warehouse import Snapshot, Warehouse, partition_name, stamped

ENTITY = "id_departamento"
RESULTS = ("resultado_proyeccion", "resultado_clasificacion")


def load_star(
    attendance: DataFrame,
    known: DataFrame | None,
    warehouse: Warehouse,
    s: Settings,
    strict: bool = False,
    stage: Stage | None = None,
    batch: str | None = None,
) -> DataFrame:
    """Dimensions, fact and quarantine (``fact_cuarentena``) from the raw extracts.

    Replaces the whole star at once and drops the results that were computed from the old one.
    Returns (section, metric, value): the profiles of both extracts, with a warning where the
    registry has not the expected size, the match rate, failures per key and the valid rate.
    A dimension that breaks a declared rule (a repeated key, a null, a text over its width)
    raises and nothing is published.
    With ``strict`` a valid rate under the limit raises and nothing is published. ``batch`` names the
    rows for ``add_attendance``, which then does not add them again.
    """
    base = warehouse.snapshot()
    star = Star(attendance, known, s, stage or Stage(warehouse.spark), _keys(base))
    require_rows(star.counted, "the cleaned attendance")
    if strict:
        facts.require_valid_rate(star.resolved, s.valid_rate)
    dimension_tables = {
        "dim_geografia": star.geography,
        "dim_tiempo": star.time,
        "dim_especialidad": star.specialties,
        "dim_establecimiento": star.facilities,
    }
    quality.enforce(quality.check_declared(dimension_tables))
    published = dimension_tables | {
        "fact_atenciones": star.fact, "fact_cuarentena": facts.rejected(star.resolved),
        "observaciones": ingest.with_month(star.observations, s),
        "registro_claves": _keys_after(star.keys, dimension_tables),
    }
    names = [(batch,)] if batch is not None else []
    published["lotes"] = warehouse.spark.createDataFrame(names, "lote string")
    warehouse.replace(published, drop=("dim_departamento", *RESULTS), since=base)
    return _load_report(star, s)


#: Dimensions with consecutive keys, which later loads keep: key and natural key
_SEQUENCES = {
    "dim_tiempo": ("id_tiempo", "periodo"), "dim_geografia": ("id_geografia", "ubigeo"),
    "dim_departamento": ("id_departamento", "codigo_departamento"),
}


def _keys(base: Snapshot) -> DataFrame | None:
    """The keys given so far; none before the first load."""
    return base.read("registro_claves") if "registro_claves" in base.tables else None


def _keys_after(keys: DataFrame | None, tables: dict[str, DataFrame]) -> DataFrame:
    """The registry with what the tables add. A key stays in it when its row leaves the table."""
    parts = [dimensions.keys_given(t, tables[t], *_SEQUENCES[t]) for t in _SEQUENCES if t in tables]
    result = keys
    for part in parts:
        result = part if result is None else result.unionByName(part)
    return result.distinct()


def add_attendance(
    attendance: DataFrame,
    known: DataFrame | None,
    warehouse: Warehouse,
    s: Settings,
    stage: Stage | None = None,
    batch: str | None = None,
) -> DataFrame:
    """Attendance that arrived after a load, added to the star.

    Only the months that the new rows name are read and replaced in the fact, and only the facilities
    and geographies they name are derived again, from all observations of those; keys stay as they
    were. The result equals a load of all rows together. Returns (mes, filas): the months replaced
    and their fact rows. A named ``batch`` that the warehouse holds already changes nothing, so a
    stream may hand in a batch twice. Results computed from the old star are dropped, baselines stay.
    """
    stage, base = stage or Stage(warehouse.spark), warehouse.snapshot()
    spark = warehouse.spark
    merged = base.read("lotes") if "lotes" in base.tables else None
    if batch is not None and merged is not None and not merged.where(F.col("lote") == batch).isEmpty():
        return spark.createDataFrame([], "mes int, filas bigint")
    new = stage(
        ingest.with_month(
            ingest.observations(ingest.cleaned(attendance, s.activity), s.activity), s), "new")
    # At most one per month between the first and the last valid year, and 0.
    months = [r.mes for r in new.select("mes").distinct().collect()]
    old = base.read("observaciones")
    touched = stage(
        ingest.with_month(
            ingest.merge_observations(
                old.where(F.col("mes").isin(months)).unionByName(new).drop("mes")), s),
        "touched")
    counted = touched.where(F.col("n") > 0)

    def named(column: str) -> DataFrame:
        """All observations of what the new rows name."""
        keys = new.select(column).distinct()
        rest = old.where(~F.col("mes").isin(months)).unionByName(touched)
        return rest.join(keys, column, "left_semi")

    def renewed(table: str, rows: DataFrame, natural: str) -> DataFrame:
        """The table with these rows in place of those of the same natural keys."""
        before = base.read(table).join(rows.select(natural), natural, "left_anti")
        return stage(before.unionByName(rows, allowMissingColumns=True), table)

    keys = _keys(base)
    periods = base.read("dim_tiempo").select(F.col("periodo").cast("string").alias("periodo"))
    time = stage(
        dimensions.time_dimension(
            periods.unionByName(counted.select("periodo")), s,
            keys.where("dimension = 'dim_tiempo'")),
        "dim_tiempo")
    specialties = renewed(
        "dim_especialidad", dimensions.specialty_dimension(counted), "especialidad")
    active = None if known is None else stage(registry.active_facilities(known, s), "registry")
    union = dimensions.geography_union(dimensions.observed_geography(named("ubigeo")), None)
    linked = base.read("dim_geografia").select("ubigeo", "id_departamento")
    geography = renewed(
        "dim_geografia",
        dimensions.geography_dimension(
            union, keys.where("dimension = 'dim_geografia'")).join(linked, "ubigeo", "left"),
        "ubigeo")
    names = None if active is None else registry.one_per_name(active)
    observed = dimensions.observed_facilities(named("nombre_centro"))
    baselines = base.read("dim_establecimiento").select("nombre_centro", "linea_base_operativa")
    facilities = renewed(
        "dim_establecimiento",
        dimensions.facility_dimension(
            dimensions.enrich_facilities(dimensions.named_facilities(observed), names), geography)
        .drop("linea_base_operativa").join(baselines, "nombre_centro", "left"),
        "nombre_centro")
    tables = {
        "dim_geografia": geography, "dim_tiempo": time, "dim_especialidad": specialties,
        "dim_establecimiento": facilities,
    }
    quality.enforce(quality.check_declared(tables))
    resolved = stage(
        facts.resolve_keys(
            ingest.fact_aggregate(touched), time, facilities, specialties, geography), "resolved")
    quarantine = ingest.with_month(base.read("fact_cuarentena"), s).where(
        ~F.col("mes").isin(months)).drop("mes")
    ids = [r.id_tiempo for r in time.where(F.col("periodo").isin(months)).collect()]
    published = tables | {
        "fact_atenciones": facts.accepted(resolved),
        "fact_cuarentena": quarantine.unionByName(facts.rejected(resolved)),
        "observaciones": touched,
        "registro_claves": _keys_after(keys, tables),
    }
    appended = ()
    if batch is not None:
        published["lotes"] = spark.createDataFrame([(batch,)], "lote string")
        appended = ("lotes",)
    warehouse.replace(
        published, drop=RESULTS, since=base, append=appended,
        partitions={
            "fact_atenciones": [partition_name("id_tiempo", i) for i in ids],
            "observaciones": [partition_name("mes", m) for m in months],
        })
    return facts.accepted(resolved).groupBy(F.col("periodo").cast("int").alias("mes")).agg(
        F.count("*").alias("filas"))


def replay_quarantine(warehouse: Warehouse) -> DataFrame:
    """Tries rejected fact rows again with the dimensions as they are now.

    Rows that resolve join the fact and leave the quarantine, in one release. A rejected row's grain
    is in no accepted row, since rows are summed by grain before they are resolved. Returns
    (reason, n) of what is still rejected."""
    base, stage = warehouse.snapshot(), Stage(warehouse.spark)
    waiting = base.read("fact_cuarentena").drop("reason", *facts.KEYS)
    resolved = stage(
        facts.resolve_keys(
            waiting, *[base.read(t) for t in (
                "dim_tiempo", "dim_establecimiento", "dim_especialidad", "dim_geografia")]),
        "replayed")
    rejected = facts.rejected(resolved)
    warehouse.replace(
        {"fact_atenciones": facts.accepted(resolved), "fact_cuarentena": rejected},
        since=base, append=("fact_atenciones",))
    return rejected.groupBy("reason").agg(F.count("*").alias("n"))


def _load_report(star: Star, s: Settings) -> DataFrame:
    repeated = quality.check_unique({"fact_atenciones": star.fact})
    parts = {
        "atenciones": ingest.ingest_profile(
            star.observations, star.aggregate, star.time, star.specialties, star.facilities,
            star.geography,
        ),
        "cruce": ingest.long_format(_as_doubles(dimensions.match_rate(star.facilities))),
        "claves_fallidas": facts.reject_reasons(star.resolved),
        "carga": ingest.long_format(_as_doubles(facts.valid_rate(star.resolved, s.valid_rate))),
        "grano_repetido": repeated.select("check_column", "n_violations"),
    }
    if star.raw_registry is not None:
        profile = registry.registry_profile(star.raw_registry, s)
        warning = profile.where("NOT ok").select("metric", F.col("value") - F.col("expected"))
        parts |= {"registro": profile.select("metric", "value"), "registro_inesperado": warning}
    return sections(parts)


def _as_doubles(one_row: DataFrame) -> DataFrame:
    return one_row.select([F.col(c).cast("double").alias(c) for c in one_row.columns])


def sections(parts: dict[str, DataFrame]) -> DataFrame:
    """(section, metric, value) from reports whose two columns are a name and a number."""
    result = None
    for section, part in parts.items():
        name, value = part.columns
        rows = part.select(
            F.lit(section).alias("section"), F.col(f"`{name}`").alias("metric"),
            F.col(f"`{value}`").cast("double").alias("value"),
        )
        result = rows if result is None else result.unionAll(rows)
    return result


def export_staging(
    attendance: DataFrame,
    known: DataFrame | None,
    folder: str,
    s: Settings,
    stage: Stage | None = None,
) -> list[str]:
    """The staged tables as delimited text, one folder each; returns their names."""
    star = Star(attendance, known, s, stage or Stage(attendance.sparkSession))
    facilities = dimensions.named_facilities(dimensions.observed_facilities(star.observations))
    tables = {
        "fact_atenciones_consultas": star.aggregate,
        "dim_tiempo": star.time.drop("id_tiempo"),
        "dim_especialidad": star.specialties.drop("id_especialidad"),
        "establecimientos_atenciones": facilities.drop("n"),
        "geografia_union": star.geography_union.drop("source"),
    }
    if star.registry is not None:
        tables["registro_activo"] = star.registry
        tables["geografia_registro"] = registry.registry_geography(star.registry)
    for name, table in tables.items():
        write_delimited(table, f"{folder}/{name}")
    return list(tables)


def compute_baseline(
    warehouse: Warehouse, s: Settings, stage: Stage | None = None
) -> DataFrame:
    """Operating baseline of every facility, written into its dimension.

    Returns (section, metric, value): how the baselines are spread, and who has none.
    """
    base = warehouse.snapshot()
    fact = require_rows(base.read("fact_atenciones"), "fact_atenciones")
    entity = "id_establecimiento"
    monthly = bl.monthly_totals(fact, base.read("dim_tiempo"), entity)
    stage = stage or Stage(warehouse.spark)
    computed = stage(
        bl.baseline(monthly, entity, "total", s, min_months=s.min_months, places=2), "baseline"
    )
    facilities = base.read("dim_establecimiento")
    updated = bl.apply_baseline(facilities, computed, entity)
    warehouse.replace({"dim_establecimiento": updated}, since=base)
    return sections({
        "distribucion": ingest.long_format(_as_doubles(bl.distribution(computed, "linea_base"))),
        "cobertura": ingest.long_format(bl.coverage(computed)),
    })


def load_departments(warehouse: Warehouse, stage: Stage | None = None) -> DataFrame:
    """Departments found in the facts, and the district-to-department link, published together."""
    base = warehouse.snapshot()
    fact = require_rows(base.read("fact_atenciones"), "fact_atenciones")
    geography, keys = base.read("dim_geografia"), _keys(base)
    stage = stage or Stage(warehouse.spark)
    names = dimensions.department_names(fact, geography)
    given = None if keys is None else keys.where("dimension = 'dim_departamento'")
    departments = stage(dimensions.department_dimension(names, given), "dim_departamento")
    districts = stage(dimensions.backfill_department(geography, departments), "dim_geografia")
    tables = {"dim_departamento": departments, "dim_geografia": districts}
    warehouse.replace(
        tables | {"registro_claves": _keys_after(keys, tables)}, drop=RESULTS, since=base)
    unlinked = districts.agg(F.count_if(F.col(ENTITY).isNull())).scalar()
    return departments.withColumn("districts_without_department", unlinked)


def _series(base: Snapshot, stage: Stage) -> DataFrame:
    fact = require_rows(base.read("fact_atenciones"), "fact_atenciones")
    series = bl.department_series(fact, base.read("dim_tiempo"), base.read("dim_geografia"))
    return stage(series, "series")


def run_forecast(
    warehouse: Warehouse, s: Settings, stage: Stage | None = None
) -> DataFrame:
    """Demand projection per department, replacing the earlier one.

    Returns the run's summary: a row per department, each with the verdict on the run, namely the
    departments, those modelled, those under the error limit, and both median errors."""
    stage, base = stage or Stage(warehouse.spark), warehouse.snapshot()
    series, names = _series(base, stage), base.read("dim_departamento")
    gated = forecast.eligible(series, ENTITY, s)
    summary = stage(
        forecast.summary(
            series, names,
            forecast.backtest(gated, ENTITY, s), forecast.recovery(gated, ENTITY, s),
            ENTITY, s,
        ),
        "summary",
    )
    model = {"meses": forecast.forecast, "ondas": waves.forecast}[s.forecast_model]
    published = forecast.published_forecast(model(gated, ENTITY, s), ENTITY)
    rows = forecast.result_rows(published, summary, ENTITY)
    warehouse.replace({"resultado_proyeccion": stamped(rows)}, since=base)
    verdict = forecast.acceptance(summary, s.mape_limit).first().asDict()
    return summary.withColumns({name: F.lit(value) for name, value in verdict.items()})


def run_classification(
    warehouse: Warehouse, s: Settings, stage: Stage | None = None
) -> DataFrame:
    """Saturation level of every projected month, replacing the earlier one.

    Returns (section, metric, value): scores per class and on average, folds, projected months kept
    and dropped for missing lags, months per published level, and whether the score passes its limit.
    """
    base = warehouse.snapshot()
    projection = require_rows(base.read("resultado_proyeccion"), "resultado_proyeccion")
    stage = stage or Stage(warehouse.spark)
    series = _series(base, stage)
    features = panel.panel_features(bl.saturation(series, ENTITY, "aten", s), ENTITY)
    train = stage(classify.training_set(features, s), "train")
    folded = stage(classify.stratified_folds(train, ENTITY, s), "folded")
    encode = classify.encoder(series.select(ENTITY).distinct(), ENTITY)
    predictors = classify.forest_predictors(classify.fit_forests(folded, encode, s), encode, s)
    scored = classify.out_of_fold(folded, predictors)
    report = stage(classify.class_report(scored), "report")
    spliced = panel.splice_features(
        series,
        projection.select(
            ENTITY, F.col("mes_proyectado").alias("ds"),
            F.col("atenciones_proyectadas").alias("aten"),
        ),
        bl.baseline(series, ENTITY, "aten", s), ENTITY, s,
    )
    score = classify.f1_scores(report).select("f1_macro").scalar()
    result = stage(
        classify.classified(predictors[None](panel.complete(spliced)), score, ENTITY),
        "classified",
    )
    quality.enforce(
        quality.domain_violations(
            result, "resultado_clasificacion", "nivel_saturacion", DOMAINS[s.scheme]
        )
    )
    warehouse.replace({"resultado_clasificacion": stamped(result)}, since=base)
    whole = report.unionByName(classify.report_averages(report))
    scores = [c for c in whole.columns if c != "nivel"]
    return sections({
        **{c: whole.select("nivel", c) for c in scores},
        "pliegues": folded.groupBy(F.col("fold").cast("string").alias("fold")).count(),
        "proyectados": ingest.long_format(panel.dropped_counts(spliced)),
        "niveles": result.groupBy("nivel_saturacion").count(),
        "veredicto": ingest.long_format(_as_doubles(classify.acceptance(report, s.f1_limit))),
    })
