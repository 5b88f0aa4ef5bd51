"""Every query by name: (spark, sf_dir) -> DataFrame, over the role views of the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from satmart.functions.levels import DOMAINS, level
from satmart.functions.text import is_six_digits, normalize_geo_code, normalize_name_exact, trim_ws
from satmart.operators import baseline as bl
from satmart.operators import classify, dimensions, facts, forecast, ingest, panel
from satmart.operators import quality, registry, waves
from satmart.plans.roles import (
    ROLE_SETTINGS,
    TABLES,
    attendance_of,
    dirty_attendance,
    documents,
    raw_attendance,
    raw_registry,
    table,
)
from satmart.plans import jobs
from satmart.plans.star import DEPARTMENT, Star
from satmart.sources.delimited import read_delimited, write_delimited
from satmart.sources.storage import Stage, exists, fingerprint
from satmart.sources.warehouse import Warehouse
from satmart.streaming.ingest import compact, ingest_new_files, keep_star, merged_observations

S = ROLE_SETTINGS
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_stars: dict[tuple, Star] = {}


def star(spark: SparkSession, sf_dir: str, view=raw_attendance) -> Star:
    """The star over one data folder, loaded once per application and then queried.

    Loaded anew when the line items under that name have changed, or when its staged tables are
    gone from the shared folder.
    """
    lines = fingerprint(spark, f"{sf_dir}/lineitem.parquet")
    key = (spark.sparkContext.applicationId, sf_dir, lines, view.__name__)
    if key not in _stars or not exists(spark, _stars[key].stage.root):
        _stars[key] = Star(view(spark, sf_dir), raw_registry(spark, sf_dir), S, Stage(spark))
    return _stars[key]


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def on_star(build: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(star(spark, sf_dir))
    return build


def on_dirty_star(build: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    """For checks: the star over attendance with faults put in."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(star(spark, sf_dir, dirty_attendance))
    return build


def _r(name: str, places: int = 6) -> Column:
    """Floating results to a fixed place, so summation order does not show."""
    return F.round(F.col(name), places).alias(name)


# Raw extracts and cleaning


@query
def clean_attendance(spark, sf_dir):
    columns = ["periodo", "nombre_centro", "especialidad", "red_asistencial", "ubigeo", "cantidad"]
    clean = ingest.clean_attendance(raw_attendance(spark, sf_dir), S.activity)
    return clean.groupBy(*columns).agg(F.count("*").alias("n"))


@query
def fact_aggregate(spark, sf_dir):
    clean = ingest.clean_attendance(raw_attendance(spark, sf_dir), S.activity)
    return ingest.fact_aggregate(clean)


@query
def stream_fact_aggregate(spark, sf_dir):
    """The same fact from line items that arrive as a file stream."""
    # Named by a pattern, since a stream's plain path must be a folder and a table may be one file.
    lines = spark.readStream.schema(TABLES["lineitem"]).parquet(f"{sf_dir}/lineitem.parque[t]")
    root = Stage(spark).root
    run = ingest_new_files(
        attendance_of(lines, spark, sf_dir), S.activity, f"{root}/partials", f"{root}/checkpoint"
    )
    run.awaitTermination()
    compact(spark, f"{root}/partials")
    return ingest.fact_aggregate(merged_observations(spark, f"{root}/partials"))


@query
def name_norm(spark, sf_dir):
    """Whole texts by the exact rule; every 97th gets letters that expand and rare blanks."""
    extra = F.when(F.col("doc_id") % 97 == 0, F.lit(" \u00a0ﬁnal½\u2003ﬀ Ⅷ "))
    text = F.concat(F.coalesce("text", F.lit("")), F.coalesce(extra, F.lit("")))
    return documents(spark, sf_dir).select(
        "doc_id", normalize_name_exact(text).alias("text_norm")
    )


@query
def geo_code_norm(spark, sf_dir):
    codes = raw_attendance(spark, sf_dir).select(F.col("UBIGEO").alias("raw_code"))
    codes = codes.union(raw_registry(spark, sf_dir).select("UBIGEO")).distinct()
    code = normalize_geo_code(trim_ws(F.col("raw_code")))
    return codes.select("raw_code", code.alias("ubigeo"), is_six_digits(code).alias("valid"))


@on_star
def ingest_profile(m):
    m.load_dimensions()
    return ingest.ingest_profile(
        m.observations, m.aggregate, m.time, m.specialties, m.facilities, m.geography
    )


@on_star
def activity_counts(m):
    return ingest.activity_counts(m.observations)


@query
def specialty_top(spark, sf_dir):
    """The five most frequent specialties among consultations."""
    clean = ingest.clean_attendance(raw_attendance(spark, sf_dir), S.activity)
    return ingest.value_counts(clean, "especialidad", top=5)


# Through the sources


@query
def delimited_fact(spark, sf_dir):
    """The fact from attendance written as delimited text and read back."""
    path = f"{Stage(spark).root}/attendance"
    write_delimited(raw_attendance(spark, sf_dir), path)
    raw = read_delimited(spark, path)
    return ingest.fact_aggregate(ingest.clean_attendance(raw, S.activity))


def _natural_fact(house: Warehouse) -> DataFrame:
    """A published fact under its natural keys."""
    facilities = house.read("dim_establecimiento").select("id_establecimiento", "nombre_centro")
    return (
        house.read("fact_atenciones")
        .join(house.read("dim_tiempo"), "id_tiempo")
        .join(facilities, "id_establecimiento")
        .join(house.read("dim_especialidad"), "id_especialidad")
        .join(house.read("dim_geografia"), "id_geografia")
        .select(F.col("periodo").cast("string").alias("periodo"), "nombre_centro",
                "especialidad", "ubigeo", "cantidad_atenciones")
    )


@query
def published_fact(spark, sf_dir):
    """The fact under its natural keys, read from a warehouse that the load job published."""
    house = Warehouse(spark, f"{Stage(spark).root}/warehouse")
    jobs.load_star(raw_attendance(spark, sf_dir), raw_registry(spark, sf_dir), house, S)
    return _natural_fact(house)


@query
def incremental_fact(spark, sf_dir):
    """The same fact from three arrivals: a first load, an earlier year with rows that come late for
    months already loaded, and the last years. The last one is handed in twice."""
    house = Warehouse(spark, f"{Stage(spark).root}/warehouse")
    rows, known = raw_attendance(spark, sf_dir), raw_registry(spark, sf_dir)
    late = F.crc32(F.concat("PERIODO", "SES_DESCAS", "DES_SER").cast("binary")) % 40 == 0
    middle = F.col("PERIODO").between("199601", "199912")
    jobs.load_star(rows.where(middle & ~late), known, house, S)
    last = rows.where(F.col("PERIODO") >= "200001")
    jobs.add_attendance(
        rows.where((F.col("PERIODO") < "199601") | middle & late), known, house, S, batch="early")
    for _ in range(2):
        jobs.add_attendance(last, known, house, S, batch="last")
    return _natural_fact(house)


@query
def streamed_star_fact(spark, sf_dir):
    """The same fact from a star that a file stream keeps up to date, in three arrivals."""
    root = Stage(spark).root
    rows, landing = raw_attendance(spark, sf_dir), f"{root}/landing"
    for low, high in (("0", "1995"), ("1995", "1998"), ("1998", "9")):
        rows.where((F.col("PERIODO") >= low) & (F.col("PERIODO") < high)).write.mode(
            "append").parquet(landing)
        stream = spark.readStream.schema(rows.schema).parquet(landing)
        house = Warehouse(spark, f"{root}/warehouse")
        keep_star(
            stream, raw_registry(spark, sf_dir), house, S, f"{root}/checkpoint"
        ).awaitTermination()
    return _natural_fact(house)


@query
def replayed_fact(spark, sf_dir):
    """The same fact, loaded before a third of the specialties were known: their rows wait in the
    quarantine and are replayed once the dimension has grown."""
    house = Warehouse(spark, f"{Stage(spark).root}/warehouse")
    m, stage = star(spark, sf_dir), Stage(spark)
    m.load_dimensions()
    missing = F.crc32(F.col("especialidad").cast("binary")) % 3 == 0
    resolved = stage(
        facts.resolve_keys(
            m.aggregate, m.time, m.facilities, m.specialties.where(~missing), m.geography),
        "resolved")
    house.replace({
        "dim_tiempo": m.time, "dim_geografia": m.geography, "dim_establecimiento": m.facilities,
        "dim_especialidad": m.specialties.where(~missing),
        "fact_atenciones": facts.accepted(resolved), "fact_cuarentena": facts.rejected(resolved),
    })
    house.replace({"dim_especialidad": m.specialties})
    jobs.replay_quarantine(house)
    return _natural_fact(house)


@query
def training_month_totals(spark, sf_dir):
    """Totals of the training years, from the months of the published fact that they prune to."""
    house = Warehouse(spark, f"{Stage(spark).root}/warehouse")
    jobs.load_star(raw_attendance(spark, sf_dir), raw_registry(spark, sf_dir), house, S)
    months = house.read("dim_tiempo").where(F.col("anio").isin(*S.train_years))
    return (
        house.read("fact_atenciones").join(months, "id_tiempo")
        .groupBy("periodo").agg(F.sum("cantidad_atenciones").alias("total"))
    )


# Dimensions


@on_star
def dim_time(m):
    return m.time


@on_star
def dim_specialty(m):
    return m.specialties.select("especialidad", "area")


@on_star
def facility_dominant(m):
    return dimensions.observed_facilities(m.observations)


@on_star
def geo_dominant(m):
    return dimensions.observed_geography(m.observations)


@query
def registry_active(spark, sf_dir):
    return registry.active_facilities(raw_registry(spark, sf_dir), S).select(
        "cod_ipress", "nombre_norm", "categoria", "ubigeo", "ubigeo_valido", "categoria_valida"
    )


@on_star
def registry_dedupe(m):
    return registry.one_per_name(m.registry)


@on_star
def registry_geo(m):
    return registry.registry_geography(m.registry)


@on_star
def registry_categories(m):
    return ingest.value_counts(m.registry, "categoria")


@query
def registry_profile(spark, sf_dir):
    return registry.registry_profile(raw_registry(spark, sf_dir), S)


@on_star
def geo_union(m):
    return m.geography_union


@on_star
def facility_enrich(m):
    return m.enriched_facilities.select("nombre_centro", "nombre_norm", "cod_ipress", "categoria")


@on_star
def facility_match_rate(m):
    return dimensions.match_rate(m.facilities).withColumn("match_rate", F.round("match_rate", 6))


@on_star
def facility_dim(m):
    return m.facilities.select(
        "nombre_centro", "red_asistencial", "cod_ipress", "categoria", "ubigeo_resolved",
        "nombre_excede_150",
    )


@on_star
def dim_department(m):
    return dimensions.department_names(m.fact, m.geography)


@on_star
def geo_department_backfill(m):
    return m.geography_with_department.select("ubigeo", "codigo_departamento")


# Fact


@on_star
def fact_load(m):
    return m.fact.select(*ingest.FACT_GRAIN, "cantidad_atenciones")


@on_star
def fact_quarantine(m):
    return facts.rejected(m.resolved).select(*ingest.FACT_GRAIN, "reason")


@on_dirty_star
def quarantine_reasons(m):
    return facts.reject_reasons(m.resolved)


@on_star
def fact_valid_rate(m):
    rate = facts.valid_rate(m.resolved, S.valid_rate)
    return rate.withColumn("valid_rate", F.round("valid_rate", 6))


# Baseline and saturation


@on_star
def facility_monthly(m):
    return m.facility_monthly


@on_star
def facility_baseline(m):
    return m.facility_baseline


@on_star
def facility_baseline_mean(m):
    return bl.baseline(
        m.facility_monthly, "nombre_centro", "total", replace(S, baseline_use_mean=True),
        min_months=S.min_months, places=2,
    )


@query
def customer_baseline(spark, sf_dir):
    """Baseline at customer grain, where some customers lack the minimum support."""
    day = F.col("o_orderdate").cast("date")
    monthly = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.trunc(day, "MM").alias("ds"))
        .agg(F.sum(F.floor("o_totalprice")).alias("total"))
        .withColumn("anio", F.year("ds"))
    )
    return bl.baseline(monthly, "o_custkey", "total", S, min_months=8, places=2)


@on_star
def facility_dim_with_baseline(m):
    return m.facilities_with_baseline.select(
        "nombre_centro", F.col("linea_base_operativa").cast("double").alias("linea_base_operativa")
    )


@on_star
def baseline_distribution(m):
    report = bl.distribution(m.facility_baseline, "linea_base")
    return report.select("n", *[_r(c) for c in report.columns if c != "n"])


@on_star
def baseline_coverage(m):
    return bl.coverage(m.facility_baseline)


@on_star
def facility_saturation(m):
    return m.facility_saturation.select("nombre_centro", "periodo", "total", _r("ratio"))


@on_star
def facility_levels(m):
    rated = m.facility_saturation.where(F.col("ratio").isNotNull())
    return rated.select(
        "nombre_centro", "periodo", _r("ratio"), level(F.col("ratio"), "cuatro", S).alias("nivel")
    )


@on_star
def dept_series(m):
    return m.department_series


@on_star
def dept_baseline(m):
    return m.department_baseline.select(DEPARTMENT, _r("linea_base"))


@on_star
def dept_saturation(m):
    return m.department_saturation.select(DEPARTMENT, "ds", "aten", _r("ratio"))


def _department_levels(m: Star) -> DataFrame:
    ratio = F.col("ratio")
    return m.department_saturation.where(ratio.isNotNull()).select(
        DEPARTMENT,
        "ds",
        _r("ratio"),
        *[
            level(ratio, scheme, S).alias(f"nivel_{scheme}")
            for scheme in ("binario", "tres", "cuatro")
        ],
    )


@on_star
def dept_levels(m):
    return _department_levels(m)


@on_star
def level_distribution(m):
    names = [f"nivel_{scheme}" for scheme in ("binario", "tres", "cuatro")]
    long = _department_levels(m).unpivot([], names, "scheme", "nivel")
    scheme = F.regexp_replace("scheme", "^nivel_", "").alias("scheme")
    return long.groupBy(scheme, "nivel").agg(F.count("*").alias("n"))


# Panel


@on_star
def dept_panel(m):
    return panel.calendar_panel(m.department_series.select(DEPARTMENT, "ds", "aten"), DEPARTMENT)


FEATURE_COLUMNS = [
    "ratio", "ratio_lag1", "ratio_lag2", "ratio_lag3", "ratio_lag12", "aten_lag1", "aten_lag12",
]


@on_star
def panel_features(m):
    return m.features.select(DEPARTMENT, "ds", "mes", "anio", *[_r(c) for c in FEATURE_COLUMNS])


# Quality


@on_dirty_star
def dq_unique(m):
    """The declared keys, and those of the registry and the candidate geographies before repair."""
    known = registry.registry_geography(m.registry)
    return (
        quality.check_unique(_tables(m))
        .unionByName(quality.unique_in_one_pass(
            m.registry, "registro_activo", ["cod_ipress", "nombre_norm"]))
        .unionByName(quality.unique_in_one_pass(known, "geografia_registro", ["ubigeo"]))
    )


def _tables(m: Star) -> dict[str, DataFrame]:
    return {
        "dim_tiempo": m.time,
        "dim_geografia": m.geography_with_department,
        "dim_establecimiento": m.facilities,
        "dim_especialidad": m.specialties,
        "dim_departamento": m.departments,
        "fact_atenciones": m.fact,
    }


@on_dirty_star
def dq_foreign_key(m):
    """The declared links, and the natural keys of the fact before they were resolved."""
    tables = _tables(m)
    unresolved = m.aggregate.withColumn("periodo", F.col("periodo").try_cast("int"))
    parts = [
        quality.foreign_key_violations(unresolved, tables[parent], "fact_agregado", column)
        for column, parent in (
            ("periodo", "dim_tiempo"), ("nombre_centro", "dim_establecimiento"),
            ("especialidad", "dim_especialidad"), ("ubigeo", "dim_geografia"),
        )
    ]
    result = quality.check_foreign_keys(tables)
    for part in parts:
        result = result.unionByName(part)
    return result


@on_dirty_star
def dq_not_null(m):
    """The declared rules, on the fact before its split so that the failures show."""
    return quality.check_not_null(_tables(m) | {"fact_atenciones": m.resolved})


@on_star
def dq_domain(m):
    """Four-level results checked against each scheme's domain."""
    rated = _department_levels(m)
    parts = [
        quality.domain_violations(rated, f"niveles_{scheme}", "nivel_cuatro", domain)
        for scheme, domain in DOMAINS.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@on_dirty_star
def dq_length(m):
    return quality.check_lengths(_tables(m))


# Forecast


@on_star
def forecast_seasonal(m):
    return m.forecast_rows.drop("mape_validacion")


@on_star
def forecast_waves(m):
    """The same months by the model with changes of trend and yearly waves."""
    predicted = m.stage(waves.forecast(m.gated_series, DEPARTMENT, S), "waves")
    exact = predicted.select(
        DEPARTMENT, F.col("ds").alias("mes_proyectado"), _r("yhat", 3), _r("sigma", 3))
    return exact.join(
        forecast.published_forecast(predicted, DEPARTMENT), [DEPARTMENT, "mes_proyectado"])


@on_star
def forecast_published(m):
    """The result table's rows, each with its department's backtest score."""
    return m.forecast_rows.select(
        DEPARTMENT, "mes_proyectado", "atenciones_proyectadas", "mape_validacion"
    )


@on_star
def backtest_mape(m):
    scores = forecast.backtest(m.gated_series, DEPARTMENT, S)
    return scores.select(DEPARTMENT, _r("mape", 4))


@on_star
def recovery_mape(m):
    scores = forecast.recovery(m.gated_series, DEPARTMENT, S)
    return scores.select(DEPARTMENT, "n_months", _r("mape", 4))


@on_star
def forecast_summary(m):
    return m.forecast_summary


@on_star
def forecast_acceptance(m):
    report = forecast.acceptance(m.forecast_summary, S.mape_limit)
    return report.select(
        "n_total", "n_ok", "n_under_limit", _r("mediana_principal"), _r("mediana_recuperacion")
    )


@on_star
def splice_features(m):
    return panel.complete(m.spliced).select(
        DEPARTMENT, "ds", *[_r(c) for c in FEATURE_COLUMNS]
    )


@on_star
def splice_dropped(m):
    return panel.dropped_counts(m.spliced)


@on_star
def backtest_long_era(m):
    """A backtest with cutoffs a month apart: enough scored months that a window spans several."""
    scores = forecast.backtest(m.gated_series, DEPARTMENT, replace(S, cv_period_days=31))
    return scores.select(DEPARTMENT, _r("mape", 4))


# Classification


@on_star
def class_weights(m):
    weights = classify.class_weights(classify.training_set(m.features, S))
    return weights.select("nivel", "n", _r("weight"))


@on_star
def stratified_folds(m):
    return m.folded.select(DEPARTMENT, "ds", "nivel", "fold")


def _encoder(m: Star):
    return classify.encoder(m.department_series.select(DEPARTMENT).distinct(), DEPARTMENT)


@on_star
def class_vectors(m):
    """The classifier's input: each feature of the vector, the entity's place in it, label, weight."""
    rows = classify.assembled(classify.training_set(m.features, S), _encoder(m), S)
    vector = vector_to_array("features")
    n = len(classify.FEATURES)
    rest = F.slice(vector, n + 1, F.size(vector) - n)
    return rows.select(
        DEPARTMENT, "ds", "nivel", "label", _r("weight"),
        *[F.round(F.get(vector, F.lit(i)), 6).alias(f"x_{name}")
          for i, name in enumerate(classify.FEATURES)],
        F.array_position(rest, 1.0).alias("entity_at"),
        F.size(vector).cast("bigint").alias("n_features"),
        F.aggregate(rest, F.lit(0.0), lambda a, x: a + x).alias("entity_sum"),
    )


def _persistence_report(m: Star) -> DataFrame:
    return classify.class_report(classify.persistence(classify.training_set(m.features, S), S))


@on_star
def f1_scores(m):
    scores = classify.f1_scores(_persistence_report(m))
    return scores.select(_r("f1_macro"), _r("f1_weighted"))


@on_star
def f1_acceptance(m):
    report = classify.acceptance(_persistence_report(m), S.f1_limit)
    return report.select(_r("f1_macro"), _r("f1_weighted"), "passes")


@on_star
def class_report(m):
    report = _persistence_report(m)
    whole = report.unionByName(classify.report_averages(report))
    return whole.select("nivel", _r("precision"), _r("recall"), _r("f1"), "support")


@on_star
def oof_majority(m):
    """Out-of-fold rows of the plainest predictor, so that the folds' plumbing can be checked."""
    scored = classify.out_of_fold(m.folded, classify.majority_predictors(m.folded))
    return scored.select(DEPARTMENT, "ds", "nivel", F.col("predicted").alias("prediction"), "fold")


@on_star
def publish_persistence(m):
    """The published shape of a classification, with last month's level as the predictor."""
    f1 = classify.f1_scores(_persistence_report(m)).select("f1_macro").scalar()
    scored = classify.persistence(panel.complete(m.spliced), S)
    return classify.classified(scored, f1, DEPARTMENT)


@on_star
def sat_oof(m):
    encode = _encoder(m)
    forests = classify.fit_forests(m.folded, encode, S, whole=False)
    scored = classify.out_of_fold(m.folded, classify.forest_predictors(forests, encode, S))
    return scored.select(
        DEPARTMENT, "ds", "nivel", F.col("predicted").alias("prediction"), "fold"
    )


@on_star
def sat_classify(m):
    encode = _encoder(m)
    predictors = classify.forest_predictors(
        classify.fit_forests(m.folded, encode, S), encode, S)
    scored = classify.out_of_fold(m.folded, predictors)
    f1 = classify.f1_scores(classify.class_report(scored)).select("f1_macro").scalar()
    return classify.classified(predictors[None](panel.complete(m.spliced)), f1, DEPARTMENT)
