"""Every query with an oracle gives the same names, types and values as DuckDB."""

import os
import shutil
import subprocess
import sys
import tempfile

import __spark_entry__ as entry
import compare
import pytest
from conftest import ROOT, SF, SF_SMALL

from satmart.plans import catalogue, oracle

QUERIES, ORACLES = catalogue.QUERIES, oracle.oracle_sql()
WITHOUT_ORACLE = {"sat_oof", "sat_classify"}


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF)


def test_every_query_has_an_oracle_but_the_models():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_ORACLE
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, duck, name):
    df = QUERIES[name](spark, SF)
    assert compare.type_difference(df, duck, ORACLES[name]) is None
    assert compare.difference(df, duck, ORACLES[name]) is None


def test_entry_returns_levels(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "codigo_departamento", "ds", "ratio", "nivel_binario", "nivel_tres", "nivel_cuatro"
    ]
    assert df.count() == 777


def test_without_eligible_departments_nothing_is_forecast(spark):
    assert QUERIES["forecast_seasonal"](spark, SF_SMALL).count() == 0
    states = QUERIES["forecast_summary"](spark, SF_SMALL).select("estado").distinct().collect()
    assert [r.estado for r in states] == ["SIN_CV"]


def test_known_counts(spark):
    counts = {r.metric: r.value for r in QUERIES["ingest_profile"](spark, SF).collect()}
    assert counts["filas_leidas"] == 60_000
    assert counts["filas_consultas"] == 29_936
    assert counts["cantidad_no_numerica"] == 1_478
    assert counts["especialidad_vacia"] == 4_260
    assert counts["filas_hecho"] == 22_425
    assert counts["cantidad_total"] == 724_318
    levels = QUERIES["level_distribution"](spark, SF).where("scheme = 'cuatro'").collect()
    assert {r.nivel: r.n for r in levels} == {
        "Bajo": 1113, "Normal": 560, "Alto": 291, "Critico": 94
    }


def test_entry_lists_every_query_and_oracle():
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLES.items() <= entry.oracle_sql().items()
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_rest_imports_without_the_text_operators():
    """In a fresh process, on a copy without that package, with and without its pipeline."""
    copy = tempfile.mkdtemp(prefix="satmart-copy-")
    shutil.copytree(
        f"{ROOT}/satmart", f"{copy}/satmart", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    show = "import __spark_entry__ as e, bench; print(len(e.queries()), len(e.oracle_sql()))"
    expected = f"{len(QUERIES)} {len(ORACLES)}"
    for names in (["__spark_entry__.py", "bench.py"], ["corpus_pipeline.py"]):
        for name in names:
            if os.path.exists(f"{ROOT}/{name}"):
                shutil.copy(f"{ROOT}/{name}", copy)
        run = subprocess.run(
            [sys.executable, "-c", show], cwd=copy, capture_output=True, text=True,
            env={**os.environ, "PYTHONPATH": copy, "PYTHONDONTWRITEBYTECODE": "1"})
        assert run.stdout.strip() == expected, run.stderr


def test_out_of_fold_covers_every_training_row_once(spark):
    scored = QUERIES["sat_oof"](spark, SF).collect()
    folded = QUERIES["stratified_folds"](spark, SF).collect()
    key = ("codigo_departamento", "ds", "nivel", "fold")
    assert sorted(tuple(r[k] for k in key) for r in scored) == sorted(
        tuple(r[k] for k in key) for r in folded
    )
    assert {r.prediction for r in scored} <= {"Normal", "Saturado"}
    hits = sum(r.nivel == r.prediction for r in scored)
    assert hits / len(scored) > 0.5


def test_classified_months_are_the_complete_projected_ones(spark):
    rows = QUERIES["sat_classify"](spark, SF).collect()
    spliced = QUERIES["splice_features"](spark, SF).collect()
    assert {(r.codigo_departamento, r.mes_clasificado) for r in rows} == {
        (r.codigo_departamento, r.ds) for r in spliced
    }
    assert {r.nivel_saturacion for r in rows} <= {"Normal", "Saturado"}
    assert len({r.f1_score_validacion for r in rows}) == 1
    assert 0 < rows[0].f1_score_validacion <= 100
