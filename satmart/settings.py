"""Business parameters. Every operator takes them as arguments; nothing reads a global."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class Settings:
    # Row selection
    institution: str | None = None  # registry owner to keep; None keeps every owner
    active_state: str = "ACTIVO"
    activity: str = "Consultas"
    # Periods of other years are bad ones: a stray year would stretch every calendar panel
    first_year: int = 1990
    last_year: int = 2050
    # Year regimes
    excluded_years: tuple[int, ...] = (2020, 2021)
    stable_years: tuple[int, ...] = (2015, 2016, 2017, 2018, 2019)
    train_years: tuple[int, ...] = (2016, 2017, 2018, 2019)
    recovery_year: int = 2022
    splice_start: date = date(2022, 1, 1)
    # Baseline
    baseline_percentile: float = 0.90
    baseline_use_mean: bool = False
    min_months: int = 24
    # Saturation levels
    low: float = 70.0
    normal: float = 90.0
    high: float = 110.0
    scheme: str = "binario"  # binario | tres | cuatro
    # Forecast and backtest
    forecast_model: str = "meses"  # meses: trend and month effect | ondas: changes of trend, waves
    horizon: int = 6
    min_stable: int = 48
    cv_initial_days: int = 1095
    cv_period_days: int = 183
    cv_horizon_days: int = 183
    # Classifier
    trees: int = 300
    max_depth: int = 30  # the deepest that Spark's trees may be; fits rarely need it
    seed: int = 42
    max_folds: int = 5
    # Gates
    valid_rate: float = 0.95
    mape_limit: float = 10.0
    f1_limit: float = 80.0
    expected_rows: int | None = None
    expected_institution_rows: int | None = None
