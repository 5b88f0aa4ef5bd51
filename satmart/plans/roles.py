"""The reference inputs, played by the test tables: line items are attendance rows,
suppliers are facilities, nations are departments and part types are specialties.
Dirt (padding, short codes, blank keys, text quantities) is put in by expression."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from satmart.settings import Settings

ROLE_SETTINGS = Settings(
    institution="OWN",
    excluded_years=(1999, 2000),
    stable_years=(1995, 1996, 1997, 1998),
    train_years=(1996, 1997, 1998),
    recovery_year=2001,
    splice_start=date(2001, 1, 1),
    cv_initial_days=730,
    expected_rows=110,
    expected_institution_rows=99,
)


# Given, so that building a query does not open file footers to infer them.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _period(ts: Column) -> Column:
    day = ts.cast("date")
    return F.year(day) * 100 + F.month(day)


def _code() -> Column:
    return ((F.col("n_nationkey") + 1) * 10000 + F.col("s_suppkey") % 100).cast("string")


def _with_place(rows: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adds nation and region to rows with supplier columns."""
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return rows.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).join(
        regions, F.col("n_regionkey") == F.col("r_regionkey")
    )


def attendance_of(
    lines: DataFrame, spark: SparkSession, sf_dir: str, *carried: str
) -> DataFrame:
    """Attendance rows from line items, a batch table or a stream, with some of their columns."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    quantity_missing = (F.col("l_linenumber") == 6) & (F.col("l_returnflag") == "A")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    # One table after the other: each right side is a plain scan whose size Catalyst knows.
    with_supplier = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
        suppliers, F.col("l_suppkey") == F.col("s_suppkey")
    )
    return (
        _with_place(with_supplier, spark, sf_dir)
        .select(
            _period(F.col("l_shipdate")).cast("string").alias("PERIODO"),
            F.concat(F.lit("Red "), "l_returnflag").alias("SES_DESRED"),
            F.concat(F.lit("  "), "s_name", F.lit(" ")).alias("SES_DESCAS"),
            F.lit("").alias("DES_GRU"),
            F.when(F.col("l_linestatus") == "F", "Consultas")
            .otherwise("Procedimientos")
            .alias("DES_ACT"),
            F.when(F.col("l_linenumber") == 7, "").otherwise(F.col("p_type")).alias("DES_SER"),
            F.when(quantity_missing, "S/D")
            .otherwise(F.col("l_quantity").cast("bigint").cast("string"))
            .alias("CANTIDAD"),
            F.col("n_name").alias("DEPARTAMENTO"),
            F.col("r_name").alias("PROVINCIA"),
            F.concat(F.lit("D"), (F.col("s_suppkey") % 100).cast("string")).alias("DISTRITO"),
            _code().alias("UBIGEO"),
            F.lit("").alias("FECHA_CORTE"),
            *carried,
        )
    )


def raw_attendance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attendance_of(table(spark, sf_dir, "lineitem"), spark, sf_dir)


def dirty_attendance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attendance with what the checks are there to find: periods of no month, of a stray year and
    in a second form, geo codes that resolve to nothing, and texts over their width."""
    lines = table(spark, sf_dir, "lineitem")
    raw = attendance_of(lines, spark, sf_dir, "l_orderkey", "l_suppkey")
    order, supplier = F.col("l_orderkey"), F.col("l_suppkey")
    period = (
        F.when(order % 97 == 0, "199513")
        .when(order % 97 == 1, F.concat(F.lit("0"), "PERIODO"))
        .when(order % 97 == 2, "000101")
        .otherwise(F.col("PERIODO"))
    )
    long_name = F.concat(F.col("SES_DESCAS"), F.repeat(F.lit("anexo "), 30), F.lit("z"))
    return raw.withColumns({
        "PERIODO": period,
        "UBIGEO": F.when(order % 89 == 0, "X").when(order % 89 == 1, "1234567")
        .otherwise(F.col("UBIGEO")),
        "SES_DESCAS": F.when(supplier % 17 == 0, long_name).otherwise(F.col("SES_DESCAS")),
        "DES_SER": F.when(order % 83 == 0, F.concat("DES_SER", F.repeat(F.lit("x"), 60)))
        .otherwise(F.col("DES_SER")),
    }).drop("l_orderkey", "l_suppkey")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def raw_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    # Every eleventh facility is registered a second time under another code.
    prefixes = F.when(key % 11 == 0, F.array(F.lit("0"), F.lit("1"))).otherwise(F.array(F.lit("0")))
    other_name = F.concat(F.lit("Otro "), "s_name")
    own_name = F.replace(F.lower("s_name"), F.lit("supplier"), F.lit("  süpplíer"))
    moved = _code().cast("int") + F.when(key % 3 == 0, 100).otherwise(0)
    return (
        _with_place(table(spark, sf_dir, "supplier"), spark, sf_dir)
        .withColumn("prefix", F.explode(prefixes))
        .select(
            F.concat("prefix", F.lpad(key.cast("string"), 7, "0")).alias("COD_IPRESS"),
            F.when(key % 5 == 0, other_name).otherwise(own_name).alias("NOMBRE"),
            F.when(key % 10 == 9, "OTHER").otherwise("OWN").alias("INSTITUCION"),
            F.when(key % 7 == 0, "INACTIVO").otherwise("ACTIVO").alias("ESTADO"),
            F.when(key % 6 == 0, "0")
            .otherwise(F.concat(F.lit("I-"), (key % 4 + 1).cast("string")))
            .alias("CATEGORIA"),
            F.when(key % 13 == 0, "").otherwise(moved.cast("string")).alias("UBIGEO"),
            F.lower("n_name").alias("DEPARTAMENTO"),
            F.col("r_name").alias("PROVINCIA"),
            F.concat(F.lit("R"), (key % 100).cast("string")).alias("DISTRITO"),
        )
    )
