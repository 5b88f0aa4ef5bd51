"""Warehouse tables: their columns, declared widths, keys and links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Column names, types, widths, keys and links of the warehouse tables.
# Column list of each table, in DDL form.
SCHEMAS = {
    "dim_tiempo": (
        "id_tiempo bigint, periodo int, anio int, mes int, nombre_mes string, "
        "trimestre int, semestre int, fecha_inicio date"
    ),
    "dim_geografia": (
        "id_geografia bigint, ubigeo string, departamento string, provincia string, "
        "distrito string, id_departamento bigint"
    ),
    "dim_establecimiento": (
        "id_establecimiento bigint, nombre_centro string, red_asistencial string, "
        "cod_ipress string, categoria string, id_geografia bigint, "
        "linea_base_operativa decimal(12,2)"
    ),
    "dim_especialidad": "id_especialidad bigint, especialidad string, area string",
    "dim_departamento": "id_departamento bigint, codigo_departamento string, nombre string",
    "fact_atenciones": (
        "id_tiempo bigint, id_establecimiento bigint, id_especialidad bigint, "
        "id_geografia bigint, cantidad_atenciones bigint, ratio_saturacion decimal(8,2)"
    ),
    "fact_cuarentena": (
        "periodo string, nombre_centro string, especialidad string, ubigeo string, "
        "cantidad_atenciones bigint, id_tiempo bigint, id_establecimiento bigint, "
        "id_especialidad bigint, id_geografia bigint, reason string"
    ),
    # What the star is made of and its lasting keys; neither is read by analyses.
    "observaciones": (
        "actividad string, periodo string, nombre_centro string, especialidad string, "
        "ubigeo string, red_asistencial string, departamento string, provincia string, "
        "distrito string, cantidad bigint, n bigint, n_bad bigint, n_rows bigint, mes int"
    ),
    "registro_claves": "dimension string, clave string, id bigint",
    "resultado_proyeccion": (
        "id_departamento bigint, mes_proyectado date, atenciones_proyectadas bigint, "
        "limite_inferior_ic95 bigint, limite_superior_ic95 bigint, "
        "mape_validacion decimal(6,2), fecha_ejecucion timestamp"
    ),
    "resultado_clasificacion": (
        "id_departamento bigint, mes_clasificado date, ratio_saturacion decimal(8,2), "
        "nivel_saturacion string, f1_score_validacion decimal(5,2), fecha_ejecucion timestamp"
    ),
}

# Parents before children, so a reader never sees a link into a table not yet written.
LOAD_ORDER = (
    "dim_departamento", "dim_geografia", "dim_tiempo", "dim_especialidad",
    "dim_establecimiento", "fact_atenciones", "resultado_proyeccion", "resultado_clasificacion",
)

# The fact has a folder per month, so that a month is replaced alone and a join with some months of
# the time dimension reads those only. Inside, rows lie in key order, so that file and row-group
# statistics prune reads by geography: a month or district of any size is still divisible.
PARTITIONING = {
    "fact_cuarentena": ("reason",), "fact_atenciones": ("id_tiempo",), "observaciones": ("mes",),
}

CLUSTERING = {
    "fact_atenciones": ("id_tiempo", "id_geografia", "id_establecimiento", "id_especialidad"),
}

UNIQUE_KEYS = {
    "dim_tiempo": ("id_tiempo", "periodo"),
    "dim_geografia": ("id_geografia", "ubigeo"),
    "dim_establecimiento": ("id_establecimiento", "nombre_centro"),
    "dim_especialidad": ("id_especialidad", "especialidad"),
    "dim_departamento": ("id_departamento", "codigo_departamento"),
    "fact_atenciones": ("id_tiempo,id_establecimiento,id_especialidad,id_geografia",),
}

# (child table, child column, parent table); the parent column has the same name.
FOREIGN_KEYS = (
    ("dim_geografia", "id_departamento", "dim_departamento"),
    ("dim_establecimiento", "id_geografia", "dim_geografia"),
    ("fact_atenciones", "id_tiempo", "dim_tiempo"),
    ("fact_atenciones", "id_establecimiento", "dim_establecimiento"),
    ("fact_atenciones", "id_especialidad", "dim_especialidad"),
    ("fact_atenciones", "id_geografia", "dim_geografia"),
    ("resultado_proyeccion", "id_departamento", "dim_departamento"),
    ("resultado_clasificacion", "id_departamento", "dim_departamento"),
)

NOT_NULL = {
    "dim_tiempo": (
        "id_tiempo", "periodo", "anio", "mes", "nombre_mes",
        "trimestre", "semestre", "fecha_inicio",
    ),
    "dim_geografia": ("id_geografia", "ubigeo", "departamento", "provincia", "distrito"),
    "dim_establecimiento": ("id_establecimiento", "nombre_centro"),
    "dim_especialidad": ("id_especialidad", "especialidad"),
    "dim_departamento": ("id_departamento", "codigo_departamento", "nombre"),
    "fact_atenciones": (
        "id_tiempo", "id_establecimiento", "id_especialidad",
        "id_geografia", "cantidad_atenciones",
    ),
    "resultado_proyeccion": (
        "id_departamento", "mes_proyectado", "atenciones_proyectadas", "fecha_ejecucion",
    ),
    "resultado_clasificacion": (
        "id_departamento", "mes_clasificado", "ratio_saturacion",
        "nivel_saturacion", "fecha_ejecucion",
    ),
}

# Declared text widths.
WIDTHS = {
    "dim_tiempo": {"nombre_mes": 12},
    "dim_geografia": {"ubigeo": 6, "departamento": 50, "provincia": 100, "distrito": 100},
    "dim_establecimiento": {
        "nombre_centro": 150, "red_asistencial": 100, "cod_ipress": 8, "categoria": 10,
    },
    "dim_especialidad": {"especialidad": 60, "area": 30},
    "dim_departamento": {"codigo_departamento": 2, "nombre": 50},
    "resultado_clasificacion": {"nivel_saturacion": 10},
}


def conform(df: DataFrame, schema: str) -> DataFrame:
    """The declared columns in order and type; a column the input lacks is added as null."""
    columns = [column.split(" ", 1) for column in schema.split(", ")]
    return df.select(
        [
            (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in columns
        ]
    )
