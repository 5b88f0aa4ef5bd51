"""Command line: python -m satmart <job> --warehouse PATH [...]"""

from __future__ import annotations

import argparse
import json
from datetime import date

from pyspark.sql import SparkSession

from satmart.plans import jobs
from satmart.settings import Settings
from satmart.sources.delimited import read_delimited
from satmart.sources.guards import require
from satmart.sources.storage import Stage
from satmart.sources.warehouse import Warehouse


def _settings(path: str | None) -> Settings:
    if path is None:
        return Settings()
    with open(path, encoding="utf-8") as file:
        given = json.load(file)
    fixed = {k: tuple(v) if isinstance(v, list) else v for k, v in given.items()}
    if "splice_start" in fixed:
        fixed["splice_start"] = date.fromisoformat(fixed["splice_start"])
    return Settings(**fixed)


def session() -> SparkSession:
    """The session as it was submitted; master and settings are the cluster's."""
    return SparkSession.builder.getOrCreate()


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="satmart", description=jobs.__doc__)
    parser.add_argument(
        "job", choices=[
            "stage", "load", "add", "replay", "baseline", "departments", "forecast", "classify"]
    )
    parser.add_argument("--warehouse", required=True, help="folder of the published tables")
    parser.add_argument("--settings", help="JSON file with values that replace the defaults")
    parser.add_argument("--attendance", help="delimited attendance extract (stage, load, add)")
    parser.add_argument("--registry", help="delimited facility registry (stage, load, add; optional)")
    parser.add_argument("--batch", help="name of the rows, which then count once (load, add)")
    parser.add_argument("--strict", action="store_true", help="stop under the valid rate (load)")
    args = parser.parse_args(argv)

    spark = session()
    warehouse, s = Warehouse(spark, args.warehouse), _settings(args.settings)
    stage = Stage(spark)
    try:
        report = _run(args, spark, warehouse, s, stage)
        if report is not None:
            report.show(100, truncate=False)
    finally:
        stage.clear()


def _run(args, spark, warehouse: Warehouse, s: Settings, stage: Stage):
    if args.job in ("stage", "load", "add"):
        require(spark, *[p for p in (args.attendance, args.registry) if p])
        known = read_delimited(spark, args.registry) if args.registry else None
        attendance = read_delimited(spark, args.attendance)
        if args.job == "load":
            return jobs.load_star(
                attendance, known, warehouse, s, args.strict, stage, args.batch)
        if args.job == "add":
            return jobs.add_attendance(attendance, known, warehouse, s, stage, args.batch)
        folder = f"{args.warehouse}/staging"
        print(*jobs.export_staging(attendance, known, folder, s, stage))
        return None
    if args.job == "replay":
        return jobs.replay_quarantine(warehouse)
    if args.job == "baseline":
        return jobs.compute_baseline(warehouse, s, stage)
    if args.job == "departments":
        return jobs.load_departments(warehouse, stage)
    if args.job == "forecast":
        return jobs.run_forecast(warehouse, s, stage)
    return jobs.run_classification(warehouse, s, stage)


if __name__ == "__main__":
    main()
