"""Delimited text, guards, the versioned warehouse, and the batch jobs end to end."""

import json
import os
import subprocess
import sys
import threading
from dataclasses import asdict, replace
from multiprocessing.pool import ThreadPool

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from satmart.plans import jobs, roles
from satmart.plans.catalogue import QUERIES
from satmart.sources import guards, schemas, storage
from satmart.sources.delimited import read_delimited, write_delimited
from satmart.sources.warehouse import ConflictError, Warehouse

S = replace(
    roles.ROLE_SETTINGS, trees=5, max_depth=4, min_stable=36, expected_rows=None
)


def test_reads_bom_padding_empty_and_na(spark, workdir):
    path = os.path.join(workdir, "extract.csv")
    with open(path, "w", encoding="utf-8-sig", newline="") as file:
        file.write(' A ;B;C\n x ;;NA\n"q;""1""";2;\n')
    df = read_delimited(spark, path)
    assert df.columns == ["A", "B", "C"]
    assert all(kind == "string" for _, kind in df.dtypes)
    assert [tuple(r) for r in df.collect()] == [(" x ", "", "NA"), ('q;"1"', "2", "")]
    named = read_delimited(spark, path, columns=["a", "b", "c"])
    assert named.columns == ["a", "b", "c"] and named.count() == 2


def test_written_text_reads_back(spark, frame, workdir):
    df = frame([("á", None, 1), ('x;"y', "", 2)], "a string, b string, n int")
    path = os.path.join(workdir, "out")
    write_delimited(df, path)
    back = read_delimited(spark, path)
    assert back.columns == ["a", "b", "n"]
    assert sorted(tuple(r) for r in back.collect()) == sorted([("á", "", "1"), ('x;"y', "", "2")])
    part = next(f for f in os.listdir(path) if f.endswith(".csv"))
    with open(os.path.join(path, part), "rb") as file:
        assert file.read(3) == b"\xef\xbb\xbf"


def test_a_large_extract_is_read_by_several_tasks(spark, workdir):
    path = os.path.join(workdir, "wide.csv")
    with open(path, "w", encoding="utf-8-sig") as file:
        file.write("K;V\n" + "".join(f"{i % 7};{i}\n" for i in range(40_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = read_delimited(spark, path)
        assert df.rdd.getNumPartitions() > 1
        total = df.agg(F.sum(F.col("V").cast("bigint")).alias("t"), F.count("*").alias("n")).first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert (total.t, total.n) == (sum(range(40_000)), 40_000)


def test_guards(spark, frame, workdir):
    with pytest.raises(guards.MissingInputError, match="nowhere"):
        guards.require(spark, workdir, f"{workdir}/nowhere")
    with pytest.raises(guards.EmptyTableError, match="fact"):
        guards.require_rows(frame([], "a int"), "fact")
    with pytest.warns(UserWarning):
        assert guards.parquet_or_empty(spark, f"{workdir}/nowhere", "a int").count() == 0


def test_conform_adds_missing_columns_as_null(frame):
    df = frame([(1, 2, "x")], "b int, a int, extra string")
    got = schemas.conform(df, "a bigint, b int, c decimal(8,2)")
    assert got.dtypes == [("a", "bigint"), ("b", "int"), ("c", "decimal(8,2)")]
    assert tuple(got.first()) == (2, 1, None)


def test_shared_dir_follows_the_session(spark):
    assert storage.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_warehouse_replaces_whole_versions(spark, frame, workdir):
    house = Warehouse(spark, workdir)
    with pytest.raises(guards.MissingInputError):
        house.read("a")
    house.replace({"a": frame([(1,)], "x int"), "b": frame([(5,)], "x int")})
    before = house.read("a")
    house.replace({"a": frame([(2,), (3,)], "x int")})
    assert sorted(r.x for r in house.read("a").collect()) == [2, 3]
    assert [r.x for r in before.collect()] == [1]  # an open reader keeps its version
    assert [r.x for r in house.read("b").collect()] == [5]
    house.append("a", frame([(4,)], "x int"))
    assert house.read("a").count() == 3
    house.append("a", frame([(4,)], "x int"))
    assert sorted(r.x for r in house.read("a").collect()) == [2, 3, 4, 4]
    assert before.count() == 1
    house.replace({"b": frame([], "x int")}, drop=("a",))
    assert house.tables() == ["b"] and house.read("b").isEmpty()


def test_an_unfinished_release_is_not_seen(spark, frame, workdir):
    house = Warehouse(spark, workdir)
    house.replace({"a": frame([(1,)], "x int")})
    # A run that died between writing its manifest aside and giving it its name.
    with open(f"{workdir}/_releases/00000002.json.lost", "w", encoding="utf-8") as file:
        file.write('{"a": {"": ["lost"]}}')
    assert [r.x for r in house.read("a").collect()] == [1]
    house.replace({"a": frame([(2,)], "x int")})
    assert [r.x for r in house.read("a").collect()] == [2]


@pytest.mark.parametrize("same", [False, True])
def test_two_publishers_at_once(spark, frame, workdir, monkeypatch, same):
    """Both read release 1 and write before either publishes: other tables are both right, of the
    same table one publisher is refused."""
    house = Warehouse(spark, workdir)
    house.replace({"a": frame([(1,)], "x int"), "b": frame([(1,)], "x int")})
    meet, first = threading.Barrier(2), threading.local()
    published = Warehouse._published

    def after_meeting(self, number, tables):
        if not getattr(first, "passed", False):
            first.passed = True
            meet.wait(60)
        return published(self, number, tables)

    monkeypatch.setattr(Warehouse, "_published", after_meeting)

    def publish(job):
        table, x = job
        try:
            Warehouse(spark, workdir).replace({table: frame([(x,), (x,)], "x int")})
            return "done"
        except ConflictError:
            return "refused"

    jobs_ = [("a", 2), ("a" if same else "b", 3)]
    with ThreadPool(2) as pool:
        ends = pool.map(publish, jobs_, chunksize=1)
    got = {t: sorted(r.x for r in house.read(t).collect()) for t in ("a", "b")}
    if same:
        assert sorted(ends) == ["done", "refused"]
        winner = jobs_[ends.index("done")][1]
        assert got == {"a": [winner] * 2, "b": [1]}
    else:
        assert ends == ["done", "done"] and got == {"a": [2, 2], "b": [3, 3]}


def test_a_release_made_from_changed_tables_is_refused(spark, frame, workdir):
    house = Warehouse(spark, workdir)
    house.replace({"a": frame([(1,)], "x int")})
    base = house.snapshot()
    sums = base.read("a").groupBy().sum("x").toDF("x")
    house.append("a", frame([(5,)], "x int"))
    with pytest.raises(ConflictError, match="a was changed"):
        house.replace({"total": sums}, since=base)
    house.append("a", frame([(6,)], "x int"))
    assert house.tables() == ["a"] and house.read("a").count() == 3


def test_a_month_of_the_fact_is_replaced_alone(spark, frame, workdir):
    house, columns = Warehouse(spark, workdir), "id_tiempo long, cantidad_atenciones long"
    house.replace({"fact_atenciones": frame([(1, 10), (2, 20), (2, 21), (3, 30)], columns)})
    before = set(house.read("fact_atenciones").inputFiles())
    base = house.snapshot()
    month = {"fact_atenciones": ["id_tiempo=2"]}
    house.replace({"fact_atenciones": frame([(2, 25)], columns)}, partitions=month, since=base)
    rows = house.read("fact_atenciones")
    assert sorted((r.id_tiempo, r.cantidad_atenciones) for r in rows.collect()) == [
        (1, 10), (2, 25), (3, 30)]
    assert len(before & set(rows.inputFiles())) == 2  # the files of the other months
    # Another month may be replaced by someone who began earlier; the same one may not.
    other = {"fact_atenciones": ["id_tiempo=3"]}
    house.replace({"fact_atenciones": frame([(3, 35)], columns)}, partitions=other, since=base)
    with pytest.raises(ConflictError):
        house.replace({"fact_atenciones": frame([(2, 1)], columns)}, partitions=month, since=base)
    with pytest.raises(ValueError, match="other partitions"):
        house.replace({"fact_atenciones": frame([(3, 1)], columns)}, partitions=month)
    house.replace({"fact_atenciones": frame([], columns)}, partitions=month)
    assert sorted(r.id_tiempo for r in house.read("fact_atenciones").collect()) == [1, 3]
    house.remove_old_versions()
    assert sorted(r.cantidad_atenciones for r in house.read("fact_atenciones").collect()) == [10, 35]
    house.replace({"fact_atenciones": frame([], columns)})
    assert house.read("fact_atenciones").isEmpty()


def test_reads_of_some_months_prune_the_fact(spark, loaded):
    months = loaded.read("dim_tiempo").where(F.col("anio").isin(*S.train_years))
    joined = loaded.read("fact_atenciones").join(months, "id_tiempo")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert 0 < joined.count() < loaded.read("fact_atenciones").count()


def _natural(house):
    """The fact under its natural keys."""
    return (
        house.read("fact_atenciones").join(house.read("dim_tiempo"), "id_tiempo")
        .join(house.read("dim_establecimiento").drop("id_geografia"), "id_establecimiento")
        .join(house.read("dim_especialidad"), "id_especialidad")
        .join(house.read("dim_geografia"), "id_geografia")
        .select("periodo", "nombre_centro", "especialidad", "ubigeo", "cantidad_atenciones"))


def test_arrivals_one_by_one_equal_one_load(spark, extracts, loaded, workdir):
    attendance = read_delimited(spark, f"{extracts}/attendance")
    known = read_delimited(spark, f"{extracts}/registry")
    late = F.crc32(F.concat("PERIODO", "SES_DESCAS", "DES_SER").cast("binary")) % 40 == 0
    parts = {
        "first": (F.col("PERIODO") >= "199601") & (F.col("PERIODO") < "200001") & ~late,
        "second": (F.col("PERIODO") < "199601") | (F.col("PERIODO") < "200001") & late,
        "third": F.col("PERIODO") >= "200001",
    }
    house = Warehouse(spark, workdir)
    jobs.load_star(attendance.where(parts["first"]), known, house, S)
    keys = {t: {tuple(r) for r in house.read(t).select(*c).collect()} for t, c in (
        ("dim_tiempo", ("id_tiempo", "periodo")), ("dim_geografia", ("id_geografia", "ubigeo")))}
    open_ = house.read("fact_atenciones")
    n = open_.count()
    for name in ("second", "third", "third"):
        jobs.add_attendance(attendance.where(parts[name]), known, house, S, batch=name)
    assert open_.count() == n  # a reader under way keeps its release
    assert _natural(house).exceptAll(_natural(loaded)).isEmpty()
    assert _natural(loaded).exceptAll(_natural(house)).isEmpty()
    for table, columns in (("dim_tiempo", ("id_tiempo", "periodo")),
                           ("dim_geografia", ("id_geografia", "ubigeo"))):
        assert keys[table] <= {tuple(r) for r in house.read(table).select(*columns).collect()}
    plain = ["nombre_centro", "red_asistencial", "cod_ipress", "categoria"]
    assert sorted(map(str, house.read("dim_establecimiento").select(*plain).collect())) == sorted(
        map(str, loaded.read("dim_establecimiento").select(*plain).collect()))
    assert house.read("fact_cuarentena").count() == loaded.read("fact_cuarentena").count()
    assert house.read("observaciones").agg(F.sum("n_rows")).first()[0] == 6000
    assert [r.lote for r in house.read("lotes").orderBy("lote").collect()] == ["second", "third"]


def test_rejected_rows_join_the_fact_once_their_keys_are_there(spark, extracts, loaded, workdir):
    house = Warehouse(spark, workdir)
    jobs.load_star(read_delimited(spark, f"{extracts}/attendance"), None, house, S)
    whole, some = house.read("dim_especialidad"), F.crc32(F.col("especialidad").cast("binary")) % 3 == 0
    fact = house.read("fact_atenciones").join(whole.where(~some), "id_especialidad", "left_semi")
    lost = _natural(house).where(some)
    n = lost.count()
    assert n > 0
    rows = lost.select(
        F.col("periodo").cast("string").alias("periodo"), "nombre_centro", "especialidad", "ubigeo",
        "cantidad_atenciones", F.lit("id_especialidad").alias("reason"))
    quarantine = house.read("fact_cuarentena").unionByName(rows, allowMissingColumns=True)
    house.replace({"fact_atenciones": fact, "fact_cuarentena": quarantine,
                   "dim_especialidad": whole.where(~some)})
    assert jobs.replay_quarantine(house).agg(F.sum("n")).first()[0] == 356 + n
    house.replace({"dim_especialidad": whole})
    assert jobs.replay_quarantine(house).agg(F.sum("n")).first()[0] == 356
    assert _natural(house).exceptAll(_natural(loaded)).isEmpty()
    assert _natural(loaded).exceptAll(_natural(house)).isEmpty()


def test_a_failed_append_leaves_the_old_rows(spark, frame, workdir):
    house = Warehouse(spark, workdir)
    house.replace({"a": frame([(1,), (2,)], "x int")})
    good = frame([(3,)], "x int")
    broken = good.unionAll(good.select(F.raise_error(F.lit("lost")).cast("int").alias("x")))
    with pytest.raises(Exception, match="lost"):
        house.append("a", broken)
    assert sorted(r.x for r in house.read("a").collect()) == [1, 2]
    house.append("a", good)
    assert sorted(r.x for r in house.read("a").collect()) == [1, 2, 3]


def test_a_refused_load_leaves_the_quarantine(spark, extracts, workdir):
    house = Warehouse(spark, workdir)
    attendance = read_delimited(spark, f"{extracts}/attendance")
    jobs.load_star(attendance, None, house, S)
    before = house.read("fact_cuarentena").count()
    long_name = attendance.withColumn("SES_DESCAS", F.repeat(F.lit("x"), 200))
    with pytest.raises(ValueError, match="violations"):
        jobs.load_star(long_name, None, house, S)
    assert house.read("fact_cuarentena").count() == before > 0


def test_a_folder_that_only_executors_see_is_noticed(spark, workdir, monkeypatch):
    assert storage.reaches_driver(spark, workdir, 3)
    monkeypatch.setattr(storage, "child_names", lambda spark, path: ["_SUCCESS"])
    assert not storage.reaches_driver(spark, workdir, 3)


def test_old_versions_can_be_removed(spark, frame, workdir):
    house = Warehouse(spark, workdir)
    for x in (1, 2, 3):
        house.replace({"a": frame([(x,)], "x int")})
    assert len(storage.child_names(spark, f"{workdir}/a")) == 3
    house.remove_old_versions()
    assert len(storage.child_names(spark, f"{workdir}/a")) == 1
    assert [r.x for r in house.read("a").collect()] == [3]


def test_stage_clears_its_tables(spark, frame):
    stage = storage.Stage(spark)
    assert stage(frame([(1,)], "x int"), "t").count() == 1
    stage.clear()
    assert not storage.exists(spark, stage.root)


def test_a_table_can_be_rebuilt_from_itself(spark, frame, workdir):
    house = Warehouse(spark, workdir)
    house.replace({"a": frame([(1,)], "x int")})
    house.replace({"a": house.read("a").selectExpr("x + 1 AS x")})
    assert [r.x for r in house.read("a").collect()] == [2]


@pytest.fixture(scope="module")
def extracts(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("extracts"))
    write_delimited(roles.raw_attendance(spark, SF_SMALL), f"{root}/attendance")
    write_delimited(roles.raw_registry(spark, SF_SMALL), f"{root}/registry")
    return root


@pytest.fixture(scope="module")
def loaded(spark, extracts, tmp_path_factory):
    house = Warehouse(spark, str(tmp_path_factory.mktemp("house")))
    report = jobs.load_star(
        read_delimited(spark, f"{extracts}/attendance"),
        read_delimited(spark, f"{extracts}/registry"), house, S,
    )
    values = {(r.section, r.metric): r.value for r in report.collect()}
    assert (values["carga", "n_total"], values["carga", "n_rejected"]) == (2253, 356)
    assert values["claves_fallidas", "id_especialidad"] == 356
    assert values["atenciones", "filas_leidas"] == 6000
    assert {s for s, _ in values} >= {"cruce", "registro", "grano_repetido"}
    jobs.load_departments(house)
    return house


def test_loaded_star_equals_the_queries(spark, loaded):
    fact = loaded.read("fact_atenciones")
    named = (
        fact.join(loaded.read("dim_tiempo"), "id_tiempo")
        .join(loaded.read("dim_establecimiento").drop("id_geografia"), "id_establecimiento")
        .join(loaded.read("dim_especialidad"), "id_especialidad")
        .join(loaded.read("dim_geografia"), "id_geografia")
        .select(F.col("periodo").cast("string").alias("periodo"), "nombre_centro", "especialidad",
                "ubigeo", "cantidad_atenciones")
    )
    want = QUERIES["fact_load"](spark, SF_SMALL)
    assert named.exceptAll(want).isEmpty() and want.exceptAll(named).isEmpty()
    assert fact.where("ratio_saturacion IS NOT NULL").isEmpty()
    reasons = loaded.read("fact_cuarentena").groupBy("reason").count().collect()
    assert [(r.reason, r["count"]) for r in reasons] == [("id_especialidad", 356)]


def test_published_fact_is_clustered_by_time(spark, loaded):
    files = loaded.read("fact_atenciones").groupBy(F.input_file_name().alias("f")).agg(
        F.min("id_tiempo").alias("lo"), F.max("id_tiempo").alias("hi")
    )
    spans = sorted((r.lo, r.hi) for r in files.collect())
    assert all(hi <= lo for (_, hi), (lo, _) in zip(spans, spans[1:]))


def test_staging_export_reads_back(spark, extracts, workdir):
    known = read_delimited(spark, f"{extracts}/registry")
    attendance = read_delimited(spark, f"{extracts}/attendance")
    names = jobs.export_staging(attendance, known, workdir, S)
    assert len(names) == 7
    fact = read_delimited(spark, f"{workdir}/fact_atenciones_consultas")
    want = QUERIES["fact_aggregate"](spark, SF_SMALL)
    assert fact.select(want.columns).exceptAll(
        want.select([F.col(c).cast("string") for c in want.columns])
    ).isEmpty()
    assert fact.count() == 2253


def test_baseline_job_is_idempotent(spark, loaded):
    jobs.compute_baseline(loaded, S)
    first = sorted(map(tuple, loaded.read("dim_establecimiento").collect()))
    jobs.compute_baseline(loaded, S)
    assert sorted(map(tuple, loaded.read("dim_establecimiento").collect())) == first
    want = {r.nombre_centro: r.linea_base for r in QUERIES["facility_baseline"](spark, SF_SMALL).collect()}
    got = {r.nombre_centro: float(r.linea_base_operativa)
           for r in loaded.read("dim_establecimiento").collect()}
    assert got == want


def test_forecast_and_classification_jobs(loaded):
    summary = jobs.run_forecast(loaded, S)
    modelled = [r for r in summary.collect() if r.estado == "OK"]
    projected = loaded.read("resultado_proyeccion")
    assert projected.count() == S.horizon * len(modelled) > 0
    bad = projected.where(
        "limite_inferior_ic95 > atenciones_proyectadas OR limite_inferior_ic95 < 0 "
        "OR atenciones_proyectadas > limite_superior_ic95 OR mape_validacion IS NULL"
    )
    assert bad.isEmpty()
    report = jobs.run_classification(loaded, S).collect()
    assert {"accuracy", "macro avg", "weighted avg"} < {r.metric for r in report if r.section == "f1"}
    assert {r.section for r in report} >= {"pliegues", "proyectados", "niveles", "support"}
    result = loaded.read("resultado_clasificacion")
    assert 0 < result.count() <= projected.count()
    assert {r.nivel_saturacion for r in result.collect()} <= {"Normal", "Saturado"}
    assert result.select("f1_score_validacion").distinct().count() == 1


def test_loading_again_drops_old_results(spark, extracts, workdir):
    house = Warehouse(spark, workdir)
    attendance = read_delimited(spark, f"{extracts}/attendance")
    jobs.load_star(attendance, None, house, S)
    assert house.read("dim_establecimiento").where("cod_ipress IS NOT NULL").isEmpty()
    jobs.load_departments(house)
    assert "dim_departamento" in house.tables()
    jobs.load_star(attendance, None, house, S)
    assert "dim_departamento" not in house.tables()


def test_strict_load_publishes_nothing(spark, extracts, workdir):
    house = Warehouse(spark, workdir)
    with pytest.raises(ValueError, match="valid rate"):
        jobs.load_star(read_delimited(spark, f"{extracts}/attendance"), None, house, S, strict=True)
    assert house.tables() == []


def test_command_line(spark, extracts, workdir, capsys):
    from satmart.__main__ import main

    given = {k: v for k, v in asdict(S).items() if k != "splice_start"}
    path = os.path.join(workdir, "settings.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(given | {"splice_start": S.splice_start.isoformat()}, file)
    common = ["--warehouse", f"{workdir}/house", "--settings", path]
    main(["load", *common, "--attendance", f"{extracts}/attendance",
          "--registry", f"{extracts}/registry"])
    main(["departments", *common])
    main(["baseline", *common])
    assert "n_rejected" in capsys.readouterr().out


def test_command_line_keeps_the_submitted_session():
    code = ("from satmart.__main__ import session; s = session(); "
            "print(s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'))")
    submit = ("--master local[2] --conf spark.sql.shuffle.partitions=3000 "
              "--conf spark.ui.enabled=false pyspark-shell")
    got = subprocess.run(
        [sys.executable, "-c", code], env=os.environ | {"PYSPARK_SUBMIT_ARGS": submit},
        cwd=os.path.dirname(os.path.dirname(__file__)), capture_output=True, text=True, check=True)
    assert got.stdout.split() == ["local[2]", "3000"]
