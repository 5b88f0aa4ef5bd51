"""Operators on small fixtures, against values worked out by hand or by brute force."""

import random
from collections import Counter
from dataclasses import replace
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from satmart.operators import baseline, classify, dimensions, facts, forecast, ingest
from satmart.operators import panel, quality, scale, waves
from satmart.settings import Settings

S = Settings()


def months(first, count):
    return [d.date() for d in pd.date_range(first, periods=count, freq="MS")]


def test_dominant_breaks_ties_by_attribute(frame):
    seen = frame([("k", "b", 2), ("k", "a", 2), ("k", "c", 1), ("z", "q", 1)], "k string, a string, n long")
    got = dimensions.dominant(seen, ["k"], ["a"]).orderBy("k").collect()
    assert [tuple(r) for r in got] == [("k", "a", 2), ("z", "q", 1)]


def test_quantiles_of_several_columns_equal_percentile(frame):
    rng = np.random.default_rng(4)
    rows = [(float(v), float(w) if i % 3 else None, None) for i, (v, w) in enumerate(zip(
        rng.integers(-10**9, 10**9, 500) / 100, rng.choice([1.25, 7.5, 9e12], 500)))]
    df, probabilities = frame(rows, "x double, y double, z double"), [0.0, 0.1, 0.5, 0.75, 1.0]
    got = {(r.column, r.probability): r.value
           for r in scale.exact_quantiles(df, ["x", "y", "z"], probabilities).collect()}
    for i, c in enumerate("xy"):
        data = [r[i] for r in rows if r[i] is not None]
        for p in probabilities:
            assert got[c, p] == pytest.approx(np.quantile(data, p), rel=1e-12)
    assert len(got) == 10


def test_repeated_keys_are_found_by_digest_and_checked_as_they_are(frame):
    df = frame([(1, "a", "x"), (1, "b", "x"), (2, "b", None), (2, "b", None), (3, None, "y")],
               "k long, a string, b string")
    got = {r.check_column: r.n_violations for r in quality.unique_in_one_pass(
        df, "t", ["k", "a", "k,a,b", "b"]).collect()}
    assert got == {"k": 2, "a": 1, "k,a,b": 1, "b": 2}


def test_dominant_with_one_hot_key(frame):
    random.seed(1)
    rows = [("hot" if i % 3 else f"k{i % 50}", f"a{random.randint(0, 9)}", 1) for i in range(3000)]
    got = dimensions.dominant(frame(rows, "k string, a string, n long"), ["k"], ["a"])
    counts = Counter((k, a) for k, a, _ in rows)
    for r in got.collect():
        best = min((-n, a) for (k, a), n in counts.items() if k == r.k)
        assert (r.a, r.n) == (best[1], -best[0])


def test_union_prefers_attendance_and_skips_bad_codes(frame):
    schema = "ubigeo string, departamento string, provincia string, distrito string"
    seen = frame([("010101", "A", "p", "d"), ("12", "B", "p", "d")], schema)
    known = frame([("010101", "x", "p", "d"), ("020202", "y", "p", "d"), ("020202", "w", "p", "d")], schema)
    got = dimensions.geography_union(seen, known).orderBy("ubigeo").collect()
    assert [(r.ubigeo, r.departamento, r.source) for r in got] == [
        ("010101", "A", "atenciones"), ("020202", "w", "registro")
    ]
    assert dimensions.geography_union(seen, None).count() == 1


def test_bad_periods_leave_the_time_dimension(frame):
    given = ["201501", "201513", "20151", "", "201501", "000101", "999912"]
    fact = frame([(p,) for p in given], "periodo string")
    assert [r.periodo for r in dimensions.time_dimension(fact, S).collect()] == [201501]


def test_periods_are_read_once_each_and_not_in_every_row(frame):
    fact = frame([("201501",), ("201513",), (None,)], "periodo string")
    rows = dimensions.time_dimension(fact, S)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Aggregate [periodo", 1)
    assert "RLIKE" in above and "RLIKE" not in below
    assert [r.periodo for r in rows.collect()] == [201501]


def test_rows_of_other_activities_are_not_cleaned_and_count_the_same(frame):
    names = [*ingest.COLUMNS, "CANTIDAD", "DES_ACT "]
    row = ["201501", " c ", " s ", "r", "10101", "D", "P", "I"]
    rows = [(*row, "5", "Consultas "), (*row, "x", "Consultas"), (*row, "5", "Otra"),
            (*row[:2], " ", *row[3:], "5", "Otra"), (*row[:2], "", *row[3:], None, None),
            (*row[:2], None, *row[3:], "7", None), (*row, "5", "Otra"), (*row, None, "")]
    raw = frame(rows, ", ".join(f"`{n}` string" for n in names))
    own = ingest.cleaned(raw, "Consultas")
    assert {r.ubigeo for r in own.where("actividad = 'Consultas'").collect()} == {"010101"}
    others = own.where("actividad IS DISTINCT FROM 'Consultas'")
    assert others.where("nombre_centro IS NOT NULL OR cantidad IS NOT NULL").isEmpty()
    got, want = (sorted(map(str, ingest.observations(c, "Consultas").collect()))
                 for c in (own, ingest.cleaned(raw)))
    assert got == want and len(got) == 6


def test_fact_split_counts_every_row_once(frame):
    fact = frame(
        [("201501", "c", "s", "010101", 5), ("201513", "c", "", "010101", 1), ("201501", "c", "s", "99", 2)],
        "periodo string, nombre_centro string, especialidad string, ubigeo string, cantidad_atenciones long",
    )
    resolved = facts.resolve_keys(
        fact,
        frame([(1, 201501)], "id_tiempo long, periodo int"),
        frame([(1, "c")], "id_establecimiento long, nombre_centro string"),
        frame([(1, "s")], "id_especialidad long, especialidad string"),
        frame([(1, "010101")], "id_geografia long, ubigeo string"),
    )
    assert facts.accepted(resolved).count() == 1
    reasons = {r.reason for r in facts.rejected(resolved).collect()}
    assert reasons == {"id_tiempo,id_especialidad", "id_geografia"}
    rate = facts.valid_rate(resolved, 0.95).first()
    assert (rate.n_total, rate.n_loaded, rate.n_rejected, rate.passes) == (3, 1, 2, False)
    with pytest.raises(facts.ValidRateError):
        facts.require_valid_rate(resolved, 0.95)


def test_valid_rate_of_nothing_is_zero(frame):
    empty = frame([], "reason string")
    row = facts.valid_rate(empty, 0.95).first()
    assert (row.n_total, row.valid_rate, row.passes) == (0, 0.0, False)


def test_baseline_percentile_and_support(frame):
    rows = [("a", y, v) for y, v in zip([2015] * 4, [1, 2, 3, 4])] + [("a", 2020, 1000)]
    series = frame(rows, "e string, anio int, total long")
    assert baseline.baseline(series, "e", "total", S).first().linea_base == pytest.approx(3.7)
    few = baseline.baseline(series, "e", "total", S, min_months=5).first()
    assert (few.meses, few.linea_base) == (4, None)
    mean = baseline.baseline(series, "e", "total", replace(S, baseline_use_mean=True), min_months=4)
    assert mean.first().linea_base == 2.5


def test_saturation_window_equals_baseline_join(frame):
    random.seed(2)
    rows = [(f"e{i % 7}", 2014 + i % 9, random.randint(0, 50)) for i in range(400)]
    series = frame(rows, "e string, anio int, total long")
    base = {r.e: r.linea_base for r in baseline.baseline(
        series, "e", "total", S, min_months=24, places=2).collect()}
    for r in baseline.saturation(series, "e", "total", S, min_months=24, places=2).collect():
        assert r.linea_base == base.get(r.e)
        if base.get(r.e):
            assert r.ratio == pytest.approx(r.total / base[r.e] * 100)


def test_baseline_update_keeps_untouched_and_clears_unsupported(frame):
    dim = frame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "e string, linea_base_operativa double")
    dim = dim.withColumn("linea_base_operativa", F.col("linea_base_operativa").cast("decimal(12,2)"))
    new = frame([("a", 10.5), ("b", None)], "e string, linea_base double")
    got = baseline.apply_baseline(dim, new, "e").orderBy("e").collect()
    assert [None if r.linea_base_operativa is None else float(r.linea_base_operativa) for r in got] == [
        10.5, None, 3.0
    ]


@pytest.mark.parametrize("count", [1, 2, 5, 1001])
def test_exact_quantiles(frame, count):
    random.seed(count)
    # A third of the values are equal, the rest spread over several ranges.
    data = [7.25 if i % 3 == 0 else round(random.uniform(0, 5e4), 2) for i in range(count)]
    got = scale.exact_quantiles(frame([(v,) for v in data] + [(None,)], "x double"), "x", [0.25, 0.5, 0.9])
    for r in got.collect():
        assert r.value == pytest.approx(np.quantile(data, r.probability), abs=1e-9)


def test_position_by_digest_equals_row_number(frame):
    rows = [("big" if i % 10 else "small", f"id{i}") for i in range(2000)]
    df = frame(rows, "g string, id string")
    got = scale.position_by_digest(df, "g", F.md5("id"), digits=2).collect()
    want = df.selectExpr("id", "row_number() over (partition by g order by md5(id)) as rn")
    assert {r.id: r.position for r in got} == {r.id: r.rn for r in want.collect()}


def test_lag_over_a_gap_is_null(frame):
    rows = [("a", date(2020, 1, 1), 1, 1.0), ("a", date(2020, 3, 1), 3, 3.0), ("b", date(2020, 4, 1), 4, 4.0)]
    series = frame(rows, "e string, ds date, aten long, ratio double")
    features = panel.panel_features(series, "e").orderBy("e", "ds").collect()
    assert [(r.e, r.ds.month, r.aten) for r in features] == [
        ("a", 1, 1), ("a", 2, None), ("a", 3, 3), ("a", 4, None),
        ("b", 1, None), ("b", 2, None), ("b", 3, None), ("b", 4, 4),
    ]
    by_month = {(r.e, r.ds.month): r for r in features}
    assert by_month["a", 2].ratio_lag1 == 1.0
    assert by_month["a", 3].ratio_lag1 is None
    assert by_month["a", 3].ratio_lag2 == 1.0


def test_densify_on_own_months(frame):
    rows = [("a", date(2020, 1, 1), 1), ("a", date(2020, 3, 1), 3), ("b", date(2020, 4, 1), 4)]
    dense = panel.densify(frame(rows, "e string, ds date, aten long"), "e")
    assert sorted((r.e, r.ds.month, r.aten or 0) for r in dense.collect()) == [
        ("a", 1, 1), ("a", 2, 0), ("a", 3, 3), ("b", 4, 4)
    ]


def test_splice_lets_the_actual_win_and_feeds_projected_lags(frame):
    days = months("2022-01-01", 13)
    series = frame([("a", d, d.year, 100 + i) for i, d in enumerate(days)], "e string, ds date, anio int, aten long")
    projection = frame(
        [("a", days[-1], 999), ("a", date(2023, 2, 1), 50), ("a", date(2023, 3, 1), 60)],
        "e string, ds date, aten long",
    )
    base = frame([("a", 200.0)], "e string, linea_base double")
    got = {r.ds: r for r in panel.splice_features(series, projection, base, "e", S).collect()}
    assert len(got) == 3
    assert got[days[-1]].aten == 112.0
    assert got[date(2023, 2, 1)].aten_lag1 == 112.0
    assert got[date(2023, 3, 1)].aten_lag1 == 50.0
    assert got[date(2023, 3, 1)].ratio == 30.0
    counts = panel.dropped_counts(panel.splice_features(series, projection, base, "e", S)).first()
    assert (counts.n_projected, counts.n_kept, counts.n_dropped) == (3, 3, 0)


def _seasonal(count=60, start="2015-01-01", slope=2.0):
    days = months(start, count)
    return [("a", d, d.year, int(200 + slope * i + 30 * np.sin(d.month / 12 * 2 * np.pi))) for i, d in enumerate(days)]


SERIES = "e string, ds date, anio int, aten long"


def test_closed_form_forecast_follows_trend_and_season(frame):
    gated = forecast.eligible(frame(_seasonal(), SERIES), "e", S)
    rows = forecast.forecast(gated, "e", S).orderBy("ds").collect()
    assert [r.ds for r in rows] == months("2020-01-01", 6)
    want = _seasonal(66)[60:]
    for r, w in zip(rows, want):
        assert r.yhat == pytest.approx(w[3], rel=0.03)


def plain_backtest(data, s):
    """Score of one entity by plain loops, and how many months were scored."""
    ds = [r[1] for r in data]
    y = np.array([r[3] for r in data], float)
    t = np.array([d.year * 12 + d.month for d in ds], float)
    month = np.array([d.month for d in ds])
    errors, cutoff = [], ds[-1] - timedelta(s.cv_horizon_days)
    while cutoff - timedelta(s.cv_initial_days) >= ds[0]:
        past = np.array([d <= cutoff for d in ds])
        b, a = np.polyfit(t[past], y[past], 1)
        season = {m: np.mean((y - a - b * t)[past & (month == m)]) for m in range(1, 13)}
        for i, d in enumerate(ds):
            if 0 < (d - cutoff).days <= s.cv_horizon_days:
                p = a + b * t[i] + season[month[i]]
                errors.append(((d - cutoff).days, abs(y[i] - p) / y[i]))
        cutoff -= timedelta(s.cv_period_days)
    horizons = sorted({h for h, _ in errors})
    # Every scored month with the mean of its horizon, in order; the last w of them per horizon.
    mean = {h: np.mean([e for k, e in errors if k == h]) for h in horizons}
    rows = [mean[h] for h in sorted(h for h, _ in errors)]
    window, rolled, upto = max(1, len(rows) // 10), [], 0
    for h in horizons:
        upto += sum(k == h for k, _ in errors)
        if upto >= window:
            rolled.append(np.mean(rows[upto - window : upto]))
    return np.mean(rolled) * 100, len(rows)


@pytest.mark.parametrize(("period", "scored"), [(183, 18), (61, 50), (31, 100)])
def test_backtest_matches_brute_force(frame, period, scored):
    random.seed(5)
    data = [(e, d, y, v + random.randint(0, 40)) for e, d, y, v in _seasonal()]
    s = replace(S, cv_period_days=period)
    got = forecast.backtest(forecast.eligible(frame(data, SERIES), "e", s), "e", s).first().mape
    want, n = plain_backtest(data, s)
    assert n >= scored or period == 183
    assert got == pytest.approx(want)


def test_backtest_copies_no_month_and_deals_rows_once(frame):
    gated = forecast.eligible(frame(_seasonal(), SERIES), "e", S)
    plan = forecast.backtest(gated, "e", replace(S, cv_period_days=31))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "Generate" not in text
    assert text.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("penalties", [(0.0, 0.0), (1.0, 2.5e-5)])
def test_waves_equal_penalised_least_squares(frame, penalties):
    model = waves.Model(3, 2, 0.8, *penalties)
    rng = np.random.default_rng(2)
    data = [(e, d, y, int(v * scale + rng.integers(0, 40)))
            for e, scale in (("a", 1), ("b", 7)) for _, d, y, v in _seasonal(50)]
    gated = frame(data, SERIES).withColumnRenamed("aten", "y")
    got = {(r.e, r.ds): r for r in waves.forecast(gated, "e", S, model).collect()}
    assert len(got) == 12
    for e in ("a", "b"):
        own = [r for r in data if r[0] == e]
        t = np.array([(r[1].year - 2000) * 12 + r[1].month for r in own], float)
        y = np.array([r[3] for r in own], float)

        def design(at):
            u = (at - t[0]) / (t[-1] - t[0])
            hinges = [np.maximum(u - 0.8 * j / 4, 0) for j in (1, 2, 3)]
            angles = [2 * np.pi * k / 12 * at for k in (1, 2)]
            return np.stack([np.ones_like(u), u, *hinges, *[
                f(a) for a in angles for f in (np.sin, np.cos)]], 1)

        x, scale = design(t), y.max()
        # A penalty is a further row whose wanted value is nothing.
        extra = np.diag(np.sqrt(model.penalties))
        beta = np.linalg.lstsq(
            np.concatenate([x, extra]), np.concatenate([y / scale, np.zeros(9)]), rcond=None)[0]
        left = y / scale - x @ beta
        sigma = np.sqrt(left @ left / (len(y) - 9))
        cover = np.linalg.inv(x.T @ x + np.diag(model.penalties))
        for h in range(1, 7):
            at = design(np.array([t[-1] + h]))[0]
            day = months("2015-01-01", 50 + h)[-1]
            assert got[e, day].yhat == pytest.approx(scale * at @ beta, rel=1e-7)
            spread = scale * sigma * np.sqrt(1 + at @ cover @ at)
            assert got[e, day].sigma == pytest.approx(spread, rel=1e-6)


def test_waves_follow_a_change_of_trend(frame):
    days = months("2015-01-01", 60)
    level = [300 + (5 * i if i < 30 else 150 - 3 * (i - 30)) for i in range(66)]
    gated = frame([("a", d, d.year, v) for d, v in zip(days, level)], SERIES).withColumnRenamed(
        "aten", "y")
    rows = waves.forecast(gated, "e", S, waves.Model(change_penalty=1e-3)).orderBy("ds").collect()
    for r, want in zip(rows, level[60:]):
        assert r.yhat == pytest.approx(want, rel=0.05)
    flat = frame([("z", d, d.year, 0) for d in days[:3]], SERIES).withColumnRenamed("aten", "y")
    assert [(r.yhat, r.sigma) for r in waves.forecast(flat, "e", S).collect()] == [(0.0, 0.0)] * 6
    assert waves.forecast(gated.limit(0), "e", S).count() == 0


def test_waves_deal_rows_once(frame):
    gated = frame(_seasonal(), SERIES).withColumnRenamed("aten", "y")
    text = waves.forecast(gated, "e", S)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert "Python" not in text


def test_backtest_of_a_zero_actual_is_null(frame):
    data = [(e, d, y, 0 if d == date(2019, 10, 1) else v) for e, d, y, v in _seasonal()]
    gated = forecast.eligible(frame(data, SERIES), "e", S)
    assert forecast.backtest(gated, "e", S).first().mape is None


def test_recovery_without_rows_is_null(frame):
    gated = forecast.eligible(frame(_seasonal(), SERIES), "e", S)
    row = forecast.recovery(gated, "e", S).first()
    assert (row.n_months, row.mape) == (0, None)


def test_summary_states(frame):
    series = frame(_seasonal() + [("b", d, d.year, 5) for d in months("2015-01-01", 47)], SERIES)
    gated = forecast.eligible(series, "e", S)
    names = frame([("a", "Alfa")], "e string, nombre string")
    got = forecast.summary(
        series, names, forecast.backtest(gated, "e", S), forecast.recovery(gated, "e", S), "e", S
    ).orderBy("e").collect()
    assert [(r.departamento, r.meses_estables, r.estado) for r in got] == [
        ("Alfa", 60, "OK"), ("b", 47, "SIN_CV")
    ]


def test_summary_names_the_cause_of_a_missing_score(frame):
    zero = [("z", d, y, 0 if d == date(2019, 10, 1) else v) for _, d, y, v in _seasonal()]
    s = replace(S, min_stable=30)
    short = [("s", d, d.year, 5) for d in months("2017-06-01", 31)]
    series = frame(zero + short, SERIES)
    gated = forecast.eligible(series, "e", s)
    got = forecast.summary(
        series, frame([], "e string, nombre string"), forecast.backtest(gated, "e", s),
        forecast.recovery(gated, "e", s), "e", s).collect()
    assert {r.e: r.estado for r in got} == {"z": "ERROR:ZERO_ACTUAL", "s": "ERROR:NO_CUTOFF"}


@pytest.mark.parametrize(("smallest", "folds"), [(1, 2), (3, 3), (40, 5)])
def test_fold_count(frame, smallest, folds):
    rows = [("Normal",)] * 50 + [("Saturado",)] * smallest
    train = frame(rows, "nivel string")
    assert train.select(classify.fold_count(train, S).alias("k")).first().k == folds


def test_report_scores_undefined_as_zero(frame):
    pairs = [("A", "A")] * 3 + [("A", "B"), ("C", "A")]
    report = classify.class_report(frame(pairs, "nivel string, predicted string"))
    got = {r.nivel: r for r in report.collect()}
    assert (got["A"].precision, got["A"].recall, got["A"].support) == (0.75, 0.75, 4)
    assert (got["B"].precision, got["B"].recall, got["B"].f1, got["B"].support) == (0, 0, 0, 0)
    assert (got["C"].precision, got["C"].recall, got["C"].support) == (0, 0, 1)
    scores = classify.f1_scores(report).first()
    assert scores.f1_macro == pytest.approx(25.0)
    assert scores.f1_weighted == pytest.approx(60.0)
    closing = {r.nivel: r for r in classify.report_averages(report).collect()}
    assert closing["accuracy"].f1 == pytest.approx(0.6)


def test_quality_checks_find_violations(frame):
    df = frame([("a", 1), ("a", None), ("bbb", 3)], "k string, v int")
    assert quality.unique_violations(df, "t", ["k"]).first().n_violations == 1
    assert quality.null_violations(df, "t", ["v"]).first().n_violations == 1
    assert quality.length_violations(df, "t", {"k": 2}).first().n_violations == 1
    parent = frame([(1,)], "v int")
    assert quality.foreign_key_violations(df, parent, "t", "v").first().n_violations == 1
    wrong = quality.domain_violations(df, "t", "k", ["a"])
    assert wrong.first().n_violations == 1
    with pytest.raises(quality.QualityError):
        quality.enforce(wrong)
    quality.enforce(quality.domain_violations(df, "t", "k", ["a", "bbb"]))


def test_value_counts_top(frame):
    df = frame([("a",), ("b",), ("b",), ("c",)], "x string")
    assert [(r.x, r.n) for r in ingest.value_counts(df, "x", top=2).collect()] == [("b", 2), ("a", 1)]


def test_unmatched_lookups_do_not_depend_on_broadcast(spark, frame):
    """Over the broadcast threshold the same rows come out of sort-merge joins, hot key or not."""
    rows = [("201501", "hot" if i % 3 else f"c{i}", "" if i % 4 else "s", "010101", i) for i in range(600)]
    fact = frame(
        rows,
        "periodo string, nombre_centro string, especialidad string, ubigeo string, cantidad_atenciones long",
    )
    dims = (
        frame([(1, 201501)], "id_tiempo long, periodo int"),
        frame([(1, "hot")] + [(i + 2, f"c{i}") for i in range(0, 600, 6)],
              "id_establecimiento long, nombre_centro string"),
        frame([(1, "s")], "id_especialidad long, especialidad string"),
        frame([(1, "010101")], "id_geografia long, ubigeo string"),
    )
    want = sorted(map(tuple, facts.resolve_keys(fact, *dims).collect()))
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    try:
        for name in names:
            spark.conf.set(name, "-1")
        assert sorted(map(tuple, facts.resolve_keys(fact, *dims).collect())) == want
    finally:
        for name in names:
            spark.conf.unset(name)


def test_load_refuses_a_dimension_that_breaks_its_rules(frame):
    schema = "id_especialidad long, especialidad string, area string"
    good = frame([(1, "a", None)], schema)
    quality.enforce(quality.check_declared({"dim_especialidad": good}))
    for bad in ([(1, "a", None), (1, "b", None)], [(1, None, None)], [(1, "x" * 61, None)]):
        with pytest.raises(quality.QualityError):
            quality.enforce(quality.check_declared({"dim_especialidad": frame(bad, schema)}))
