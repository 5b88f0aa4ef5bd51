"""The star as a chain of tables. Each one that several others read is staged once."""

from __future__ import annotations

from functools import cached_property
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satmart.operators import baseline as bl
from satmart.operators import dimensions as dims
from satmart.operators import classify, facts, forecast, ingest, panel, registry
from satmart.settings import Settings
from satmart.sources.storage import Stage


class Star:
    """Dimensions, fact and analysis tables from the two raw extracts; the registry may be None.

    Tables are built when first asked for. The raw attendance is read once, into
    ``observations``; everything else derives from that aggregate. ``keys`` are the keys given by
    earlier loads (dimension, clave, id).
    """

    def __init__(
        self, attendance: DataFrame, raw_registry: DataFrame | None, s: Settings, stage: Stage,
        keys: DataFrame | None = None,
    ):
        self.attendance = attendance
        self.raw_registry = raw_registry
        self.s = s
        self.stage = stage
        self.keys = keys

    def known(self, dimension: str) -> DataFrame | None:
        return None if self.keys is None else self.keys.where(F.col("dimension") == dimension)

    # Attendance and registry

    @cached_property
    def observations(self) -> DataFrame:
        rows = ingest.observations(
            ingest.cleaned(self.attendance, self.s.activity), self.s.activity)
        return self.stage(rows, "observations")

    @cached_property
    def counted(self) -> DataFrame:
        """Observations with at least one valid quantity: what the fact is made of."""
        return self.observations.where(F.col("n") > 0)

    @cached_property
    def aggregate(self) -> DataFrame:
        return ingest.fact_aggregate(self.observations)

    @cached_property
    def registry(self) -> DataFrame | None:
        if self.raw_registry is None:
            return None
        return self.stage(registry.active_facilities(self.raw_registry, self.s), "registry")

    # Dimensions

    @cached_property
    def time(self) -> DataFrame:
        rows = dims.time_dimension(self.counted, self.s, self.known("dim_tiempo"))
        return self.stage(rows, "dim_tiempo")

    @cached_property
    def specialties(self) -> DataFrame:
        return self.stage(dims.specialty_dimension(self.counted), "dim_especialidad")

    @cached_property
    def geography_union(self) -> DataFrame:
        known = None if self.registry is None else registry.registry_geography(self.registry)
        return dims.geography_union(dims.observed_geography(self.observations), known)

    @cached_property
    def geography(self) -> DataFrame:
        rows = dims.geography_dimension(self.geography_union, self.known("dim_geografia"))
        return self.stage(rows, "dim_geografia")

    @cached_property
    def enriched_facilities(self) -> DataFrame:
        names = None if self.registry is None else registry.one_per_name(self.registry)
        observed = dims.observed_facilities(self.observations)
        return dims.enrich_facilities(dims.named_facilities(observed), names)

    @cached_property
    def facilities(self) -> DataFrame:
        rows = dims.facility_dimension(self.enriched_facilities, self.geography)
        return self.stage(rows, "dim_establecimiento")

    # Fact

    def load_dimensions(self) -> None:
        """Stage what the fact needs. Tables of one step do not depend on each other, so their
        jobs run side by side."""
        steps = (
            ("observations", "registry"),
            ("geography", "time", "specialties"),
            ("facilities",),
        )
        build = inheritable_thread_target(self.stage.spark)(lambda name: getattr(self, name))
        for step in steps:
            with ThreadPool(len(step)) as pool:
                pool.map(build, step)

    @cached_property
    def resolved(self) -> DataFrame:
        self.load_dimensions()
        rows = facts.resolve_keys(
            self.aggregate, self.time, self.facilities, self.specialties, self.geography
        )
        return self.stage(rows, "fact_resolved")

    @cached_property
    def fact(self) -> DataFrame:
        return facts.accepted(self.resolved)

    # Hierarchy and baselines

    @cached_property
    def departments(self) -> DataFrame:
        names = dims.department_names(self.fact, self.geography)
        return self.stage(dims.department_dimension(names), "dim_departamento")

    @cached_property
    def geography_with_department(self) -> DataFrame:
        rows = dims.backfill_department(self.geography, self.departments)
        return self.stage(rows, "dim_geografia_departamento")

    @cached_property
    def facility_monthly(self) -> DataFrame:
        rows = bl.monthly_totals(self.fact, self.time, "nombre_centro")
        return self.stage(rows, "facility_monthly")

    @cached_property
    def facility_baseline(self) -> DataFrame:
        rows = bl.baseline(
            self.facility_monthly, "nombre_centro", "total", self.s,
            min_months=self.s.min_months, places=2,
        )
        return self.stage(rows, "facility_baseline")

    @cached_property
    def facilities_with_baseline(self) -> DataFrame:
        return bl.apply_baseline(self.facilities, self.facility_baseline, "nombre_centro")

    @cached_property
    def facility_saturation(self) -> DataFrame:
        return bl.saturation(
            self.facility_monthly, "nombre_centro", "total", self.s,
            min_months=self.s.min_months, places=2,
        )

    # Departments

    @cached_property
    def department_series(self) -> DataFrame:
        """(codigo_departamento, ds, anio, aten)."""
        series = bl.department_series(self.fact, self.time, self.geography_with_department)
        codes = self.departments.select("id_departamento", "codigo_departamento")
        rows = series.join(codes, "id_departamento").drop("id_departamento")
        return self.stage(
            rows.select("codigo_departamento", "ds", "anio", "aten"), "department_series"
        )

    @cached_property
    def department_baseline(self) -> DataFrame:
        return bl.baseline(self.department_series, DEPARTMENT, "aten", self.s)

    @cached_property
    def department_saturation(self) -> DataFrame:
        return bl.saturation(self.department_series, DEPARTMENT, "aten", self.s)

    @cached_property
    def features(self) -> DataFrame:
        rows = panel.panel_features(self.department_saturation, DEPARTMENT)
        return self.stage(rows, "panel_features")

    @cached_property
    def folded(self) -> DataFrame:
        """Training rows with their folds."""
        train = classify.training_set(self.features, self.s)
        return self.stage(classify.stratified_folds(train, DEPARTMENT, self.s), "folded")

    # Forecast

    @cached_property
    def gated_series(self) -> DataFrame:
        return forecast.eligible(self.department_series, DEPARTMENT, self.s)

    @cached_property
    def forecast_summary(self) -> DataFrame:
        rows = forecast.summary(
            self.department_series,
            self.departments,
            forecast.backtest(self.gated_series, DEPARTMENT, self.s),
            forecast.recovery(self.gated_series, DEPARTMENT, self.s),
            DEPARTMENT,
            self.s,
        )
        return self.stage(rows, "forecast_summary")

    @cached_property
    def forecast_rows(self) -> DataFrame:
        """Published forecast with its score; staged, since the classifier reads it again."""
        predicted = forecast.forecast(self.gated_series, DEPARTMENT, self.s)
        published = forecast.published_forecast(predicted, DEPARTMENT)
        rows = forecast.result_rows(published, self.forecast_summary, DEPARTMENT)
        return self.stage(rows, "forecast_rows")

    @cached_property
    def spliced(self) -> DataFrame:
        projection = self.forecast_rows.select(
            DEPARTMENT,
            F.col("mes_proyectado").alias("ds"),
            F.col("atenciones_proyectadas").alias("aten"),
        )
        return panel.splice_features(
            self.department_series, projection, self.department_baseline, DEPARTMENT, self.s
        )


DEPARTMENT = "codigo_departamento"
