"""Demand forecast in closed form: linear trend plus month-of-year effect, with an interval,
rolling-origin backtests and a recovery score. Aggregates and windows only, no Python."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from satmart.functions.numbers import half_even, whole_not_negative
from satmart.functions.periods import month_number, month_range
from satmart.operators.scale import exact_quantiles
from satmart.settings import Settings

Z_95 = 1.96
_ZERO = 1e-8  # an actual this small has no percentage error


def fit_predict(rows: DataFrame, keys: Sequence[str], train: Column, y: str = "y") -> DataFrame:
    """Adds ``yhat`` and ``sigma`` to every row, fitted per key on the rows where ``train``.

    All windows share the partitioning on the first key, so a fit costs one shuffle.
    A calendar month never seen in training has no seasonal effect.
    """
    own, own_month = W.partitionBy(*keys), W.partitionBy(*keys, "_month")
    rows = (
        rows.withColumn("_t", month_number(F.col("ds")).cast("double"))
        .withColumn("_month", F.month("ds"))
        .withColumn("_y", F.when(train, F.col(y).cast("double")))
        .withColumn("_x", F.when(train, F.col("_t")))
    )
    trended = rows.withColumns(
        {
            "_slope": F.regr_slope("_y", "_x").over(own),
            "_level": F.regr_intercept("_y", "_x").over(own),
        }
    ).withColumn("_trend", F.col("_level") + F.col("_slope") * F.col("_t"))
    seasonal = trended.withColumn(
        "_season", F.avg(F.col("_y") - F.col("_trend")).over(own_month)
    ).withColumn("yhat", F.col("_trend") + F.coalesce("_season", F.lit(0.0)))
    return seasonal.withColumn(
        "sigma", F.stddev_samp(F.col("_y") - F.col("yhat")).over(own)
    ).drop("_t", "_month", "_y", "_x", "_slope", "_level", "_trend", "_season")


def stable_months(series: DataFrame, entity: str, s: Settings) -> DataFrame:
    """(entity, meses_estables) for every entity."""
    stable = F.col("anio").isin(*s.stable_years)
    return series.groupBy(entity).agg(F.count_if(stable).alias("meses_estables"))


def eligible(series: DataFrame, entity: str, s: Settings) -> DataFrame:
    """Rows of the entities with enough stable months, measure renamed to ``y``."""
    stable = F.col("anio").isin(*s.stable_years)
    months = F.count_if(stable).over(W.partitionBy(entity))
    return (
        series.select(entity, "ds", "anio", F.col("aten").alias("y"))
        .withColumn("_months", months)
        .where(F.col("_months") >= s.min_stable)
        .drop("_months")
    )


def forecast(gated: DataFrame, entity: str, s: Settings) -> DataFrame:
    """(entity, ds, yhat, sigma) for the months after each entity's last one.

    Trained on every month outside the excluded years.
    """
    own = W.partitionBy(entity).orderBy("ds")
    regular = gated.where(~F.col("anio").isin(*s.excluded_years))
    is_last = F.lead("ds").over(own).isNull()
    ahead = month_range(F.add_months("ds", 1), F.add_months("ds", s.horizon))
    months = regular.withColumn(
        "_months", F.when(is_last, F.concat(F.array("ds"), ahead)).otherwise(F.array("ds"))
    ).select(entity, F.explode("_months").alias("_m"), "ds", "y")
    rows = months.select(
        entity, F.col("_m").alias("ds"), "y", (F.col("_m") > F.col("ds")).alias("is_future")
    )
    return fit_predict(rows, [entity], ~F.col("is_future")).where("is_future").select(
        entity, "ds", "yhat", "sigma"
    )


def published_forecast(predicted: DataFrame, entity: str) -> DataFrame:
    """Whole, non-negative point and 95 % bounds per entity and month."""
    half_width = F.lit(Z_95) * F.col("sigma")
    return predicted.select(
        entity,
        F.col("ds").alias("mes_proyectado"),
        whole_not_negative(F.col("yhat")).alias("atenciones_proyectadas"),
        whole_not_negative(F.col("yhat") - half_width).alias("limite_inferior_ic95"),
        whole_not_negative(F.col("yhat") + half_width).alias("limite_superior_ic95"),
    )


def with_moments(stable: DataFrame, entity: str) -> DataFrame:
    """Each month with the sums over the months up to it: of its entity, and of its calendar month.

    A least-squares line and the month effects up to any day follow from two such rows, so no row is
    copied for a cutoff."""
    so_far = W.partitionBy(entity).orderBy("ds")
    same_month = W.partitionBy(entity, "m").orderBy("ds")
    t, y = F.col("t"), F.col("y")
    rows = stable.select(
        entity, "ds", F.month("ds").alias("m"), month_number(F.col("ds")).cast("double").alias("t"),
        F.col("y").cast("double").alias("y"))
    # Months are counted from the entity's first one, which keeps the squares small.
    rows = rows.withColumn("t", t - F.min("t").over(W.partitionBy(entity)))
    own = {"n": F.lit(1.0), "st": t, "stt": t * t, "sy": y, "sty": t * y}
    month = {"mn": F.lit(1.0), "mt": t, "my": y}
    return rows.withColumns(
        {k: F.sum(v).over(so_far) for k, v in own.items()}
        | {k: F.sum(v).over(same_month) for k, v in month.items()})


def _line(upto: Column) -> tuple[Column, Column]:
    """(level, slope) of the months summed in ``upto``; one month has no slope, so null."""
    n, st, stt, sy, sty = (upto[c] for c in ("n", "st", "stt", "sy", "sty"))
    slope = F.try_divide(n * sty - st * sy, n * stt - st * st)
    return (sy - slope * st) / n, slope


def _scored_months(s: Settings) -> Column:
    """Array of (days, error, size): each month of each cutoff's horizon, from ``_rows``."""
    rows = F.col("_rows")

    def of_cutoff(k: Column) -> Column:
        cutoff = F.date_sub(F.col("_last"), F.lit(s.cv_horizon_days) + k * s.cv_period_days)
        past = F.filter(rows, lambda r: r["ds"] <= cutoff)
        ahead = F.filter(
            rows,
            lambda r: (r["ds"] > cutoff) & (r["ds"] <= F.date_add(cutoff, s.cv_horizon_days)))
        level, slope = _line(F.element_at(past, -1))

        def month(r: Column) -> Column:
            seen = F.filter(past, lambda p: p["m"] == r["m"])
            last = F.try_element_at(seen, F.lit(-1))
            season = (last["my"] - level * last["mn"] - slope * last["mt"]) / last["mn"]
            yhat = level + slope * r["t"] + F.coalesce(season, F.lit(0.0))
            return F.struct(
                F.datediff(r["ds"], cutoff).alias("days"),
                F.try_divide(F.abs(r["y"] - yhat), F.abs(r["y"])).alias("error"),
                F.abs(r["y"]).alias("size"))

        return F.transform(ahead, month)

    cutoffs = F.sequence(F.lit(0), F.col("_cutoffs"))
    return F.flatten(F.transform(cutoffs, of_cutoff))


def _total(items: Column, value) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda sum_, x: sum_ + value(x))


def _by_horizon(scored: Column) -> Column:
    """Array of (days, n, error): the mean error of each horizon, in order."""
    def one(days: Column) -> Column:
        own = F.filter(scored, lambda e: e["days"] == days)
        n = F.size(own).cast("double")
        return F.struct(days.alias("days"), n.alias("n"),
                        (_total(own, lambda e: e["error"]) / n).alias("error"))

    return F.transform(F.array_sort(F.array_distinct(
        F.transform(scored, lambda e: e["days"]))), one)


def _rolled(horizons: Column, window: Column) -> Column:
    """Means over the last ``window`` scored months up to each horizon, where there are as many.

    A window may hold part of a horizon, which then counts with its mean."""
    def upto(h: Column, i: Column) -> Column:
        taken = F.aggregate(
            F.reverse(F.slice(horizons, F.lit(1), i + 1)),
            F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("sum")),
            lambda a, x: F.struct(
                (a["n"] + F.least(x["n"], window - a["n"])).alias("n"),
                (a["sum"] + x["error"] * F.least(x["n"], window - a["n"])).alias("sum")))
        return F.when(taken["n"] >= window, taken["sum"] / window)

    return F.filter(F.transform(horizons, upto), lambda x: x.isNotNull())


def backtest(gated: DataFrame, entity: str, s: Settings) -> DataFrame:
    """(entity, mape) of the rolling-origin backtest on the stable years.

    The last cutoff is one horizon before the entity's last month, the others follow at the period
    backwards as long as the initial training span remains; an entity without one has no row.
    Errors are averaged over a rolling window of a tenth of the scored months, at least one,
    that ends with a horizon (days after the cutoff); the score is the mean over the horizons
    whose window is full. Undefined, so null, when a scored actual is zero.

    One exchange on the entity: its months, which the calendar bounds, carry running sums, and each
    cutoff's fit is read off two of them. A cutoff costs a few array look-ups, not a copy of the
    months.
    """
    stable = gated.where(F.col("anio").isin(*s.stable_years))
    columns = ("ds", "m", "t", "y", "n", "st", "stt", "sy", "sty", "mn", "mt", "my")
    entities = with_moments(stable, entity).groupBy(entity).agg(
        F.sort_array(F.collect_list(F.struct(*columns))).alias("_rows"),
        F.min("ds").alias("_first"), F.max("ds").alias("_last"))
    span = F.datediff("_last", "_first")
    last = F.floor((span - s.cv_horizon_days - s.cv_initial_days) / F.lit(s.cv_period_days))
    scored = (
        entities.withColumn("_cutoffs", last.cast("int"))
        .where(F.col("_cutoffs") >= 0)
        .select(entity, _scored_months(s).alias("_scored"))
        .where(F.size("_scored") > 0)
        .withColumn("_horizons", _by_horizon(F.col("_scored")))
    )
    window = F.greatest(F.lit(1), F.floor(F.size("_scored") / 10)).cast("double")
    least = F.array_min(F.transform("_scored", lambda e: e["size"]))
    rolled = scored.select(entity, least.alias("_least"),
                           _rolled(F.col("_horizons"), window).alias("_rolled"))
    mean = F.try_divide(_total(F.col("_rolled"), lambda x: x), F.size("_rolled"))
    return rolled.select(entity, F.when(F.col("_least") >= _ZERO, mean * 100).alias("mape"))


def recovery(gated: DataFrame, entity: str, s: Settings) -> DataFrame:
    """(entity, n_months, mape): fitted on the stable years, scored on the recovery year.

    Zero actuals are left out of the mean; null when none remain.
    """
    is_train = F.col("anio").isin(*s.stable_years)
    is_test = F.col("anio") == s.recovery_year
    scored = fit_predict(gated.where(is_train | is_test), [entity], is_train)
    error = F.when(F.col("y") != 0, F.abs((F.col("y") - F.col("yhat")) / F.col("y")))
    return scored.groupBy(entity).agg(
        F.count_if(is_test).alias("n_months"),
        (F.avg(F.when(is_test, error)) * 100).alias("mape"),
    )


def summary(
    series: DataFrame, names: DataFrame, primary: DataFrame, recovered: DataFrame,
    entity: str, s: Settings,
) -> DataFrame:
    """One row per entity: name (or its key), stable months, both scores and a state.

    An entity without a score names the cause: no cutoff fits its months, or a scored month is zero.
    """
    enough = F.col("meses_estables") >= s.min_stable
    state = (
        F.when(~enough, "SIN_CV")
        .when(F.col("mape_principal").isNotNull(), "OK")
        .when(F.col("_scored"), "ERROR:ZERO_ACTUAL")
        .otherwise("ERROR:NO_CUTOFF")
    )
    return (
        stable_months(series, entity, s)
        .join(names.select(entity, "nombre"), entity, "left")
        .join(
            primary.select(
                entity, half_even(F.col("mape"), 2).alias("mape_principal"),
                F.lit(True).alias("_scored"),
            ),
            entity, "left",
        )
        .join(
            recovered.select(entity, half_even(F.col("mape"), 2).alias("mape_recuperacion")),
            entity, "left",
        )
        .select(
            entity,
            F.coalesce("nombre", F.col(entity).cast("string")).alias("departamento"),
            "meses_estables",
            "mape_principal",
            "mape_recuperacion",
            state.alias("estado"),
        )
    )


def result_rows(published: DataFrame, summarised: DataFrame, entity: str) -> DataFrame:
    """Forecast rows of the entities in state OK, each with its backtest score."""
    scores = summarised.where(F.col("estado") == "OK").select(
        entity, F.col("mape_principal").alias("mape_validacion")
    )
    return published.join(scores, entity)


def acceptance(summarised: DataFrame, limit: float) -> DataFrame:
    """One row: entities, modelled ones, those under the error limit, and median scores."""
    ok = F.col("estado") == "OK"
    modelled = summarised.where(ok)
    scores = ("mape_principal", "mape_recuperacion")
    medians = {r.column: r.value for r in exact_quantiles(modelled, scores, [0.5]).collect()}
    return summarised.agg(
        F.count("*").alias("n_total"),
        F.count_if(ok).alias("n_ok"),
        F.count_if(ok & (F.col("mape_principal") < limit)).alias("n_under_limit"),
    ).withColumns({
        f"mediana_{c.removeprefix('mape_')}": F.lit(medians.get(c)).cast("double") for c in scores})
