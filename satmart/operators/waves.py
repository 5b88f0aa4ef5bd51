"""Forecast by one linear model per series: a trend that may change its slope, and yearly waves.

The fit is the solution of the series' normal equations: sums of products of its regressors, added up
map-side, one row per series. A penalty on the changes of slope and on the waves keeps them small
where the months do not ask for them; with none the fit is plain least squares. Array functions solve
the equations, so everything is one exchange on the entity and no Python."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from satmart.functions.periods import month_number, month_range
from satmart.settings import Settings


@dataclass(frozen=True)
class Model:
    """Changes of slope, evenly spread over the first ``reach`` of the months; yearly waves (sine and
    cosine each); penalties on the squares of their coefficients, for months between 0 and 1 and
    quantities over the largest one."""

    changes: int = 6
    waves: int = 4
    reach: float = 0.8
    change_penalty: float = 1.0
    wave_penalty: float = 2.5e-5

    @property
    def size(self) -> int:
        return 2 + self.changes + 2 * self.waves

    @property
    def penalties(self) -> list[float]:
        return [0.0, 0.0, *[self.change_penalty] * self.changes,
                *[self.wave_penalty] * (2 * self.waves)]


def regressors(month: Column, first: Column, last: Column, model: Model) -> list[Column]:
    """One, time since the first month, time since each change, sines and cosines of the year.

    Months are whole numbers on one axis. A series of one month has no span, so time stays 0."""
    span = F.greatest(last - first, F.lit(1)).cast("double")
    time = (month - first) / span
    changes = [
        F.greatest(time - F.lit(model.reach * (j + 1) / (model.changes + 1)), F.lit(0.0))
        for j in range(model.changes)
    ]
    angle = [F.lit(2 * math.pi * (k + 1) / 12) * month for k in range(model.waves)]
    return [F.lit(1.0), time, *changes, *[f(a) for a in angle for f in (F.sin, F.cos)]]


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def solved(rows: Column, size: int) -> Column:
    """A positive definite system by elimination: ``rows`` holds the matrix and, to its right, what
    it is solved for; the result holds the solutions in place of the latter.

    Each step divides one row by its pivot and takes multiples of it from all the others."""
    def step(matrix: Column, k: Column) -> Column:
        pivot = F.element_at(matrix, k)
        own = F.transform(pivot, lambda x: x / F.element_at(pivot, k))

        def reduced(row: Column, i: Column) -> Column:
            by = F.element_at(row, k)
            other = F.zip_with(row, own, lambda x, y: x - by * y)
            return F.when(i + 1 == k, own).otherwise(other)

        return F.transform(matrix, reduced)

    done = F.aggregate(F.sequence(F.lit(1), F.lit(size)), rows, step)
    return F.transform(done, lambda row: F.slice(row, size + 1, F.size(row) - size))


def fitted(rows: DataFrame, entity: str, y: str, model: Model = Model()) -> DataFrame:
    """(entity, first, last, scale, n, beta, inverse, sigma) from (entity, ds, y), one row per month.

    ``beta`` are the coefficients of the regressors for y over ``scale``, ``inverse`` is the inverse
    of the penalised normal matrix, and ``sigma`` the spread of the residuals with as many degrees
    of freedom as there are months beyond coefficients, at least one. Months without a quantity are
    left out; a series of zeros has a scale of one.
    """
    own = W.partitionBy(entity)
    known = rows.where(F.col(y).isNotNull()).withColumn("_t", month_number(F.col("ds")))
    spanned = known.withColumns({
        "_first": F.min("_t").over(own), "_last": F.max("_t").over(own),
        "_scale": F.max(F.abs(F.col(y).cast("double"))).over(own),
    }).withColumn("_scale", F.when(F.col("_scale") > 0, F.col("_scale")).otherwise(1.0))
    x = [f"_x{i}" for i in range(model.size)]
    values = regressors(F.col("_t"), F.col("_first"), F.col("_last"), model)
    design = spanned.select(
        entity, "_first", "_last", "_scale", (F.col(y) / F.col("_scale")).alias("_y"),
        *[v.alias(name) for v, name in zip(values, x)])
    # The window has dealt the rows by entity already, so the sums need no second exchange.
    pairs = [(i, j) for i in range(model.size) for j in range(i, model.size)]
    sums = design.groupBy(entity).agg(
        F.first("_first").alias("first"), F.first("_last").alias("last"),
        F.first("_scale").alias("scale"), F.count("*").alias("n"),
        F.sum(F.col("_y") * F.col("_y")).alias("_yy"),
        *[F.sum(F.col(x[i]) * F.col(x[j])).alias(f"_s{i}_{j}") for i, j in pairs],
        *[F.sum(F.col(name) * F.col("_y")).alias(f"_b{i}") for i, name in enumerate(x)])

    def cell(i: int, j: int) -> Column:
        return F.col(f"_s{min(i, j)}_{max(i, j)}")

    matrix = F.array(*[
        F.array(
            *[cell(i, j) + F.lit(model.penalties[i] if i == j else 0.0)
              for j in range(model.size)],
            F.col(f"_b{i}"),
            *[F.lit(float(i == j)) for j in range(model.size)])
        for i in range(model.size)
    ])
    plain = F.array(*[F.array(*[cell(i, j) for j in range(model.size)])
                      for i in range(model.size)])
    right = F.array(*[F.col(f"_b{i}") for i in range(model.size)])
    found = sums.select(
        entity, "first", "last", "scale", "n", "_yy", plain.alias("_plain"),
        right.alias("_right"), solved(matrix, model.size).alias("_solved"),
    ).select(
        "*", F.transform("_solved", lambda row: F.element_at(row, 1)).alias("beta"),
        F.transform("_solved", lambda row: F.slice(row, 2, F.size(row) - 1)).alias("inverse"))
    explained = 2 * _dot(F.col("beta"), F.col("_right")) - _dot(
        F.col("beta"), F.transform("_plain", lambda row: _dot(row, F.col("beta"))))
    left = F.greatest(F.col("_yy") - explained, F.lit(0.0))
    freedom = F.greatest(F.col("n") - model.size, F.lit(1))
    return found.select(entity, "first", "last", "scale", "n", "beta", "inverse",
                        F.sqrt(left / freedom).alias("sigma"))


def predicted(fits: DataFrame, entity: str, month: str, model: Model = Model()) -> DataFrame:
    """Adds ``yhat`` and ``sigma`` of a month to rows that carry a fit and a date ``month``.

    The spread of a forecast is that of a month about the curve and of the curve itself."""
    x = F.array(*regressors(month_number(F.col(month)), F.col("first"), F.col("last"), model))
    rows = fits.withColumn("_x", x)
    curve = _dot(F.col("_x"), F.transform("inverse", lambda row: _dot(row, F.col("_x"))))
    return rows.withColumns({
        "yhat": F.col("scale") * _dot(F.col("_x"), F.col("beta")),
        "sigma": F.col("scale") * F.col("sigma") * F.sqrt(1 + curve),
    }).drop("_x")


def forecast(gated: DataFrame, entity: str, s: Settings, model: Model = Model()) -> DataFrame:
    """(entity, ds, yhat, sigma) for the months after each entity's last one.

    Trained on every month outside the excluded years, like the closed-form forecast."""
    regular = gated.where(~F.col("anio").isin(*s.excluded_years))
    fits = fitted(regular.select(entity, "ds", "y"), entity, "y", model)
    # "last" counts months on the axis of month_number.
    last = F.make_date(2000 + F.floor((F.col("last") - 1) / 12),
                       F.pmod(F.col("last") - 1, F.lit(12)) + 1, F.lit(1))
    ahead = month_range(F.add_months(last, 1), F.add_months(last, s.horizon))
    rows = fits.withColumn("ds", F.explode(ahead))
    return predicted(rows, entity, "ds", model).select(entity, "ds", "yhat", "sigma")
