"""The same queries as plain SQL for DuckDB, over the pre-registered test tables.

Common table expressions build the star step by step; a query pulls in those it names.
"""

from __future__ import annotations

import re

# Regressors of the forecast by waves at month t of a series that goes from month t0 to t1.
_TIME = "((t - t0) / greatest(t1 - t0, 1)::DOUBLE)"
_WAVES = ", ".join([
    "1.0::DOUBLE", _TIME,
    *[f"greatest({_TIME} - 0.8 * {j + 1} / 7, 0)" for j in range(6)],
    *[f"{f}(2 * pi() * {k} / 12 * t)" for k in range(1, 5) for f in ("sin", "cos")],
])

_STEPS: dict[str, str] = {
    # Role views
    "facility_rows": """
        SELECT s_suppkey, s_name, n_nationkey, n_name, r_name
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "raw_attendance": """
        SELECT strftime(l_shipdate, '%Y%m') AS PERIODO,
               'Red ' || l_returnflag AS SES_DESRED,
               '  ' || s_name || ' ' AS SES_DESCAS,
               CASE WHEN l_linestatus = 'F' THEN 'Consultas' ELSE 'Procedimientos' END AS DES_ACT,
               CASE WHEN l_linenumber = 7 THEN '' ELSE p_type END AS DES_SER,
               CASE WHEN l_linenumber = 6 AND l_returnflag = 'A' THEN 'S/D'
                    ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS CANTIDAD,
               n_name AS DEPARTAMENTO, r_name AS PROVINCIA,
               'D' || CAST(s_suppkey % 100 AS VARCHAR) AS DISTRITO,
               CAST((n_nationkey + 1) * 10000 + s_suppkey % 100 AS VARCHAR) AS UBIGEO
        FROM lineitem JOIN part ON l_partkey = p_partkey
        JOIN facility_rows ON l_suppkey = s_suppkey""",
    "dirty_attendance": """
        SELECT CASE l_orderkey % 97 WHEN 0 THEN '199513'
                    WHEN 1 THEN '0' || strftime(l_shipdate, '%Y%m') WHEN 2 THEN '000101'
                    ELSE strftime(l_shipdate, '%Y%m') END AS PERIODO,
               'Red ' || l_returnflag AS SES_DESRED,
               '  ' || s_name || ' ' || CASE WHEN s_suppkey % 17 = 0
                    THEN repeat('anexo ', 30) || 'z' ELSE '' END AS SES_DESCAS,
               CASE WHEN l_linestatus = 'F' THEN 'Consultas' ELSE 'Procedimientos' END AS DES_ACT,
               CASE WHEN l_linenumber = 7 THEN '' ELSE p_type END
                   || CASE WHEN l_orderkey % 83 = 0 THEN repeat('x', 60) ELSE '' END AS DES_SER,
               CASE WHEN l_linenumber = 6 AND l_returnflag = 'A' THEN 'S/D'
                    ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS CANTIDAD,
               n_name AS DEPARTAMENTO, r_name AS PROVINCIA,
               'D' || CAST(s_suppkey % 100 AS VARCHAR) AS DISTRITO,
               CASE l_orderkey % 89 WHEN 0 THEN 'X' WHEN 1 THEN '1234567'
                    ELSE CAST((n_nationkey + 1) * 10000 + s_suppkey % 100 AS VARCHAR) END AS UBIGEO
        FROM lineitem JOIN part ON l_partkey = p_partkey
        JOIN facility_rows ON l_suppkey = s_suppkey""",
    "raw_registry": """
        SELECT prefix || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS COD_IPRESS,
               CASE WHEN s_suppkey % 5 = 0 THEN 'Otro ' || s_name
                    ELSE replace(lower(s_name), 'supplier', '  süpplíer') END AS NOMBRE,
               CASE WHEN s_suppkey % 10 = 9 THEN 'OTHER' ELSE 'OWN' END AS INSTITUCION,
               CASE WHEN s_suppkey % 7 = 0 THEN 'INACTIVO' ELSE 'ACTIVO' END AS ESTADO,
               CASE WHEN s_suppkey % 6 = 0 THEN '0'
                    ELSE 'I-' || CAST(s_suppkey % 4 + 1 AS VARCHAR) END AS CATEGORIA,
               CASE WHEN s_suppkey % 13 = 0 THEN ''
                    ELSE CAST((n_nationkey + 1) * 10000 + s_suppkey % 100
                              + CASE WHEN s_suppkey % 3 = 0 THEN 100 ELSE 0 END AS VARCHAR)
               END AS UBIGEO,
               lower(n_name) AS DEPARTAMENTO, r_name AS PROVINCIA,
               'R' || CAST(s_suppkey % 100 AS VARCHAR) AS DISTRITO
        FROM (SELECT *, '0' AS prefix FROM facility_rows
              UNION ALL
              SELECT *, '1' AS prefix FROM facility_rows WHERE s_suppkey % 11 = 0)""",
    # Cleaning
    "clean": """
        SELECT trim(PERIODO) AS periodo, trim(SES_DESCAS) AS nombre_centro,
               trim(DES_SER) AS especialidad, trim(SES_DESRED) AS red_asistencial,
               CASE WHEN code = '' THEN '' WHEN length(code) < 6 THEN lpad(code, 6, '0')
                    ELSE code END AS ubigeo,
               trim(DEPARTAMENTO) AS departamento, trim(PROVINCIA) AS provincia,
               trim(DISTRITO) AS distrito,
               CASE WHEN regexp_full_match(trim(CANTIDAD), '[+-]?[0-9]+')
                    THEN TRY_CAST(trim(CANTIDAD) AS BIGINT)
                    ELSE CAST(trunc(TRY_CAST(trim(CANTIDAD) AS DOUBLE)) AS BIGINT) END AS cantidad
        FROM (SELECT *, regexp_replace(UBIGEO, '[^0-9]', '', 'g') AS code FROM raw_attendance)
        WHERE trim(DES_ACT) = 'Consultas'""",
    "fact": """
        SELECT periodo, nombre_centro, especialidad, ubigeo,
               CAST(sum(cantidad) AS BIGINT) AS cantidad_atenciones
        FROM clean WHERE cantidad IS NOT NULL GROUP BY ALL""",
    "active": """
        SELECT trim(COD_IPRESS) AS cod_ipress,
               regexp_replace(strip_accents(replace(upper(trim(NOMBRE)), 'ẞ', 'SS')),
                              '\\s+', ' ', 'g') AS nombre_norm,
               trim(CATEGORIA) AS categoria, ubigeo,
               regexp_full_match(ubigeo, '[0-9]{6}') AS ubigeo_valido,
               trim(CATEGORIA) <> '0' AS categoria_valida,
               trim(DEPARTAMENTO) AS departamento, trim(PROVINCIA) AS provincia,
               trim(DISTRITO) AS distrito
        FROM (SELECT * EXCLUDE (UBIGEO),
                     CASE WHEN code = '' THEN '' WHEN length(code) < 6 THEN lpad(code, 6, '0')
                          ELSE code END AS ubigeo
              FROM (SELECT *, regexp_replace(UBIGEO, '[^0-9]', '', 'g') AS code
                    FROM raw_registry))
        WHERE trim(INSTITUCION) = 'OWN' AND trim(ESTADO) = 'ACTIVO'""",
    # Dimensions
    "geo_seen": """
        SELECT ubigeo, departamento, provincia, distrito, n FROM (
            SELECT *, row_number() OVER (PARTITION BY ubigeo
                                         ORDER BY n DESC, departamento, provincia, distrito) AS rn
            FROM (SELECT ubigeo, departamento, provincia, distrito, count(*) AS n
                  FROM clean WHERE cantidad IS NOT NULL GROUP BY ALL))
        WHERE rn = 1""",
    "facility_seen": """
        SELECT nombre_centro, red_asistencial, ubigeo, n FROM (
            SELECT *, row_number() OVER (PARTITION BY nombre_centro
                                         ORDER BY n DESC, red_asistencial, ubigeo) AS rn
            FROM (SELECT nombre_centro, red_asistencial, ubigeo, count(*) AS n
                  FROM clean WHERE cantidad IS NOT NULL GROUP BY ALL))
        WHERE rn = 1""",
    "registry_places": """
        SELECT DISTINCT ubigeo, departamento, provincia, distrito
        FROM active WHERE ubigeo_valido""",
    "registry_names": """
        SELECT nombre_norm, cod_ipress, categoria FROM (
            SELECT *, row_number() OVER (PARTITION BY nombre_norm
                                         ORDER BY cod_ipress, categoria) AS rn FROM active)
        WHERE rn = 1""",
    "geo": """
        SELECT ubigeo, departamento, provincia, distrito, source FROM (
            SELECT *, row_number() OVER (PARTITION BY ubigeo
                       ORDER BY source, departamento, provincia, distrito) AS rn
            FROM (SELECT ubigeo, departamento, provincia, distrito, 'atenciones' AS source
                  FROM geo_seen
                  UNION ALL
                  SELECT ubigeo, departamento, provincia, distrito, 'registro'
                  FROM registry_places)
            WHERE regexp_full_match(ubigeo, '[0-9]{6}'))
        WHERE rn = 1""",
    "times": """
        SELECT row_number() OVER (ORDER BY periodo) AS id_tiempo, periodo,
               CAST(year(d) AS INTEGER) AS anio, CAST(month(d) AS INTEGER) AS mes,
               ['Enero', 'Febrero', 'Marzo', 'Abril', 'Mayo', 'Junio', 'Julio', 'Agosto',
                'Septiembre', 'Octubre', 'Noviembre', 'Diciembre'][month(d)] AS nombre_mes,
               CAST(quarter(d) AS INTEGER) AS trimestre,
               CAST(CASE WHEN month(d) > 6 THEN 2 ELSE 1 END AS INTEGER) AS semestre,
               d AS fecha_inicio
        FROM (SELECT DISTINCT CAST(periodo AS INTEGER) AS periodo,
                     CAST(try_strptime(periodo || '01', '%Y%m%d') AS DATE) AS d
              FROM fact WHERE regexp_full_match(periodo, '[0-9]{6}'))
        WHERE year(d) BETWEEN 1990 AND 2050""",
    "specialties": """
        SELECT DISTINCT especialidad, CAST(NULL AS VARCHAR) AS area
        FROM fact WHERE especialidad <> ''""",
    "facilities": """
        SELECT f.nombre_centro, f.red_asistencial, f.ubigeo, f.nombre_norm, r.cod_ipress,
               r.categoria, length(f.nombre_centro) > 150 AS nombre_excede_150
        FROM (SELECT *, regexp_replace(strip_accents(replace(upper(nombre_centro), 'ẞ', 'SS')),
                                       '\\s+', ' ', 'g') AS nombre_norm
              FROM facility_seen) f
        LEFT JOIN registry_names r ON f.nombre_norm = r.nombre_norm""",
    # Fact load
    "resolved": """
        SELECT f.*, t.id_tiempo, t.anio, t.fecha_inicio, e.nombre_centro AS key_e,
               s.especialidad AS key_s, g.ubigeo AS key_g, g.departamento
        FROM fact f
        LEFT JOIN times t ON TRY_CAST(f.periodo AS INTEGER) = t.periodo
        LEFT JOIN facilities e ON f.nombre_centro = e.nombre_centro
        LEFT JOIN specialties s ON f.especialidad = s.especialidad
        LEFT JOIN geo g ON f.ubigeo = g.ubigeo""",
    "loaded": """
        SELECT * FROM resolved
        WHERE id_tiempo IS NOT NULL AND key_e IS NOT NULL AND key_s IS NOT NULL
          AND key_g IS NOT NULL AND cantidad_atenciones IS NOT NULL""",
    "departments": """
        SELECT codigo_departamento, nombre, n FROM (
            SELECT *, row_number() OVER (PARTITION BY codigo_departamento
                                         ORDER BY n DESC, nombre) AS rn
            FROM (SELECT substr(ubigeo, 1, 2) AS codigo_departamento, departamento AS nombre,
                         count(*) AS n
                  FROM loaded GROUP BY ALL))
        WHERE rn = 1""",
    "districts": """
        SELECT g.ubigeo, d.codigo_departamento
        FROM geo g LEFT JOIN departments d ON substr(g.ubigeo, 1, 2) = d.codigo_departamento""",
    # Facility baseline
    "monthly": """
        SELECT nombre_centro, CAST(periodo AS INTEGER) AS periodo, anio,
               CAST(sum(cantidad_atenciones) AS BIGINT) AS total
        FROM loaded GROUP BY ALL""",
    "facility_base": """
        SELECT nombre_centro, count(*) AS meses,
               CASE WHEN count(*) >= 24 THEN round_even(quantile_cont(total, 0.9), 2) END
                   AS linea_base
        FROM monthly WHERE anio NOT IN (1999, 2000) GROUP BY nombre_centro""",
    "facility_ratio": """
        SELECT m.nombre_centro, periodo, total, total / nullif(linea_base, 0) * 100 AS ratio
        FROM monthly m LEFT JOIN facility_base b ON m.nombre_centro = b.nombre_centro""",
    # Department series
    "series": """
        SELECT codigo_departamento, fecha_inicio AS ds, anio,
               CAST(sum(cantidad_atenciones) AS BIGINT) AS aten
        FROM loaded JOIN districts ON loaded.ubigeo = districts.ubigeo
        WHERE codigo_departamento IS NOT NULL GROUP BY ALL""",
    "dept_base": """
        SELECT codigo_departamento, quantile_cont(aten, 0.9) AS linea_base
        FROM series WHERE anio NOT IN (1999, 2000) GROUP BY codigo_departamento""",
    "dept_ratio": """
        SELECT s.codigo_departamento, ds, anio, aten, aten / nullif(linea_base, 0) * 100 AS ratio
        FROM series s LEFT JOIN dept_base b ON s.codigo_departamento = b.codigo_departamento""",
    "levels": """
        SELECT codigo_departamento, ds, ratio,
               CASE WHEN ratio >= 90 THEN 'Saturado' ELSE 'Normal' END AS nivel_binario,
               CASE WHEN ratio < 70 THEN 'Bajo' WHEN ratio < 90 THEN 'Normal'
                    ELSE 'Saturado' END AS nivel_tres,
               CASE WHEN ratio < 70 THEN 'Bajo' WHEN ratio < 90 THEN 'Normal'
                    WHEN ratio <= 110 THEN 'Alto' ELSE 'Critico' END AS nivel_cuatro
        FROM dept_ratio WHERE ratio IS NOT NULL""",
    # Dense panel
    "panel": """
        SELECT d.codigo_departamento, CAST(c.ds AS DATE) AS ds, s.aten, s.ratio
        FROM (SELECT unnest(generate_series(min(ds), max(ds), INTERVAL 1 MONTH)) AS ds
              FROM series) c
        CROSS JOIN (SELECT DISTINCT codigo_departamento FROM series) d
        LEFT JOIN dept_ratio s
          ON s.codigo_departamento = d.codigo_departamento AND s.ds = CAST(c.ds AS DATE)""",
    "features": """
        SELECT p.codigo_departamento, p.ds, CAST(month(p.ds) AS INTEGER) AS mes,
               CAST(year(p.ds) AS INTEGER) AS anio, p.ratio,
               a.ratio AS ratio_lag1, b.ratio AS ratio_lag2, c.ratio AS ratio_lag3,
               e.ratio AS ratio_lag12, a.aten AS aten_lag1, e.aten AS aten_lag12
        FROM panel p
        LEFT JOIN panel a ON a.codigo_departamento = p.codigo_departamento
                         AND a.ds = p.ds - INTERVAL 1 MONTH
        LEFT JOIN panel b ON b.codigo_departamento = p.codigo_departamento
                         AND b.ds = p.ds - INTERVAL 2 MONTH
        LEFT JOIN panel c ON c.codigo_departamento = p.codigo_departamento
                         AND c.ds = p.ds - INTERVAL 3 MONTH
        LEFT JOIN panel e ON e.codigo_departamento = p.codigo_departamento
                         AND e.ds = p.ds - INTERVAL 12 MONTH""",
    # Forecast
    "stable_count": """
        SELECT codigo_departamento,
               count(*) FILTER (WHERE anio BETWEEN 1995 AND 1998) AS meses_estables
        FROM series GROUP BY codigo_departamento""",
    "gated": """
        SELECT s.codigo_departamento, ds, anio, aten AS y,
               (year(ds) - 2000) * 12 + month(ds) AS t, month(ds) AS m
        FROM series s JOIN stable_count c ON s.codigo_departamento = c.codigo_departamento
        WHERE meses_estables >= 48""",
    "fit_line": """
        SELECT codigo_departamento, regr_slope(y, t) AS b, regr_intercept(y, t) AS a,
               max(ds) AS last_ds
        FROM gated WHERE anio NOT IN (1999, 2000) GROUP BY codigo_departamento""",
    "fit_season": """
        SELECT g.codigo_departamento, g.m, avg(y - (a + b * t)) AS s
        FROM gated g JOIN fit_line f ON g.codigo_departamento = f.codigo_departamento
        WHERE anio NOT IN (1999, 2000) GROUP BY ALL""",
    "fit_noise": """
        SELECT g.codigo_departamento, stddev_samp(y - (a + b * t + s)) AS sigma
        FROM gated g JOIN fit_line f ON g.codigo_departamento = f.codigo_departamento
        JOIN fit_season z ON z.codigo_departamento = g.codigo_departamento AND z.m = g.m
        WHERE anio NOT IN (1999, 2000) GROUP BY ALL""",
    "future": """
        SELECT codigo_departamento, CAST(last_ds + to_months(CAST(h AS INTEGER)) AS DATE) AS ds
        FROM fit_line, range(1, 7) r(h)""",
    "predicted": """
        SELECT u.codigo_departamento, u.ds, sigma,
               a + b * ((year(u.ds) - 2000) * 12 + month(u.ds)) + coalesce(s, 0) AS yhat
        FROM future u JOIN fit_line f ON u.codigo_departamento = f.codigo_departamento
        LEFT JOIN fit_season z
          ON z.codigo_departamento = u.codigo_departamento AND z.m = month(u.ds)
        JOIN fit_noise q ON q.codigo_departamento = u.codigo_departamento""",
    # Forecast by waves: normal equations of 16 regressors, solved by elimination
    "wave_rows": """
        SELECT codigo_departamento, t, min(t) OVER own AS t0, max(t) OVER own AS t1,
               max(abs(y)) OVER own AS scale, y / max(abs(y)) OVER own AS v
        FROM gated WHERE anio NOT IN (1999, 2000)
        WINDOW own AS (PARTITION BY codigo_departamento)""",
    "wave_design": f"""
        SELECT codigo_departamento, t0, t1, scale, v, [{_WAVES}] AS x FROM wave_rows""",
    "wave_series": """
        SELECT codigo_departamento, any_value(t0) AS t0, any_value(t1) AS t1,
               any_value(scale) AS scale, count(*) AS n, sum(v * v) AS vv
        FROM wave_design GROUP BY codigo_departamento""",
    "wave_cells": """
        SELECT codigo_departamento, i, j, sum(x[i] * x[j]) AS cell, sum(x[i] * v) AS b
        FROM wave_design, range(1, 17) r(i), range(1, 17) q(j) GROUP BY ALL""",
    "wave_lines": """
        SELECT codigo_departamento, i, any_value(b) AS b, list(cell ORDER BY j) AS plain,
               list(cell + CASE WHEN i <> j OR i < 3 THEN 0 WHEN i < 9 THEN 1 ELSE 2.5e-5 END
                    ORDER BY j)
               || [any_value(b)] || list(CASE WHEN i = j THEN 1.0 ELSE 0 END::DOUBLE ORDER BY j)
                   AS line
        FROM wave_cells GROUP BY codigo_departamento, i""",
    "wave_steps": """
        SELECT codigo_departamento, 0 AS k, list(line ORDER BY i) AS m
        FROM wave_lines GROUP BY codigo_departamento
        UNION ALL
        SELECT codigo_departamento, k + 1,
               list_transform(m, lambda r, i: CASE
                   WHEN i = k + 1 THEN list_transform(r, lambda x: x / m[k + 1][k + 1])
                   ELSE list_transform(r, lambda x, j:
                       x - r[k + 1] * (m[k + 1][j] / m[k + 1][k + 1])) END)
        FROM wave_steps WHERE k < 16""",
    "wave_solved": """
        SELECT codigo_departamento, list_transform(m, lambda r: r[17]) AS beta,
               list_transform(m, lambda r: r[18:33]) AS inverse
        FROM wave_steps WHERE k = 16""",
    "wave_noise": """
        SELECT s.codigo_departamento, any_value(t0) AS t0, any_value(t1) AS t1,
               any_value(scale) AS scale, any_value(beta) AS beta, any_value(inverse) AS inverse,
               sqrt(greatest(any_value(vv) - sum(beta[i] * (2 * b
                    - list_dot_product(plain, beta))), 0)
                    / greatest(any_value(n) - 16, 1)) AS sigma
        FROM wave_series s JOIN wave_solved USING (codigo_departamento)
        JOIN wave_lines USING (codigo_departamento) GROUP BY s.codigo_departamento""",
    "wave_future": f"""
        SELECT *, [{_WAVES}] AS x
        FROM (SELECT *, t1 + h AS t FROM wave_noise, range(1, 7) r(h))""",
    "wave_forecast": """
        SELECT codigo_departamento, make_date((2000 + (t - 1) // 12)::BIGINT, (t - 1) % 12 + 1, 1)
                   AS mes_proyectado,
               scale * list_dot_product(x, beta) AS yhat,
               scale * sigma * sqrt(1 + list_dot_product(
                   x, list_transform(inverse, lambda r: list_dot_product(r, x)))) AS sigma
        FROM wave_future""",
    # Backtest
    "stable_span": """
        SELECT codigo_departamento, min(ds) AS lo, max(ds) AS hi
        FROM gated WHERE anio BETWEEN 1995 AND 1998 GROUP BY codigo_departamento""",
    "cuts": """
        SELECT codigo_departamento, hi - CAST(183 + 183 * k AS INTEGER) AS cutoff
        FROM stable_span, range(0, 40) r(k)
        WHERE hi - CAST(183 + 183 * k AS INTEGER) >= lo + 730""",
    "cut_line": """
        SELECT c.codigo_departamento, cutoff, regr_slope(y, t) AS b, regr_intercept(y, t) AS a
        FROM cuts c JOIN gated g ON g.codigo_departamento = c.codigo_departamento
        WHERE anio BETWEEN 1995 AND 1998 AND ds <= cutoff GROUP BY ALL""",
    "cut_season": """
        SELECT c.codigo_departamento, cutoff, m, avg(y - (a + b * t)) AS s
        FROM cut_line c JOIN gated g ON g.codigo_departamento = c.codigo_departamento
        WHERE anio BETWEEN 1995 AND 1998 AND ds <= cutoff GROUP BY ALL""",
    "cut_error": """
        SELECT c.codigo_departamento, g.ds - c.cutoff AS days, y,
               abs((y - (a + b * t + coalesce(s, 0))) / nullif(y, 0)) AS error
        FROM cut_line c JOIN gated g ON g.codigo_departamento = c.codigo_departamento
        LEFT JOIN cut_season z ON z.codigo_departamento = c.codigo_departamento
                              AND z.cutoff = c.cutoff AND z.m = g.m
        WHERE anio BETWEEN 1995 AND 1998 AND ds > c.cutoff AND ds <= c.cutoff + 183""",
    "horizons": """
        SELECT *, sum(n) OVER (PARTITION BY codigo_departamento ORDER BY days) AS upto,
               greatest(1, floor(sum(n) OVER (PARTITION BY codigo_departamento) / 10)) AS w
        FROM (SELECT codigo_departamento, days, avg(error) AS error, min(abs(y)) AS least_y,
                     count(*) AS n
              FROM cut_error GROUP BY ALL)""",
    "primary_score": """
        SELECT codigo_departamento,
               CASE WHEN min(least_y) >= 1e-8 THEN avg(error) * 100 END AS mape
        FROM (SELECT h.codigo_departamento, h.days, any_value(h.least_y) AS least_y,
                     -- rows h.upto - w + 1 .. h.upto, each with the mean of its horizon
                     CASE WHEN any_value(h.upto) >= any_value(h.w) THEN
                       sum(p.error * greatest(0, least(p.upto, h.upto)
                           - greatest(p.upto - p.n, h.upto - h.w))) / any_value(h.w) END AS error
              FROM horizons h JOIN horizons p
                ON p.codigo_departamento = h.codigo_departamento AND p.days <= h.days
              GROUP BY h.codigo_departamento, h.days)
        GROUP BY codigo_departamento""",
    "stable_line": """
        SELECT codigo_departamento, regr_slope(y, t) AS b, regr_intercept(y, t) AS a
        FROM gated WHERE anio BETWEEN 1995 AND 1998 GROUP BY codigo_departamento""",
    "stable_season": """
        SELECT g.codigo_departamento, m, avg(y - (a + b * t)) AS s
        FROM gated g JOIN stable_line f ON g.codigo_departamento = f.codigo_departamento
        WHERE anio BETWEEN 1995 AND 1998 GROUP BY ALL""",
    "recovery_score": """
        SELECT f.codigo_departamento, count(g.y) AS n_months,
               avg(abs((y - (a + b * t + coalesce(s, 0))) / nullif(y, 0))) * 100 AS mape
        FROM stable_line f
        LEFT JOIN gated g ON g.codigo_departamento = f.codigo_departamento AND anio = 2001
        LEFT JOIN stable_season z
          ON z.codigo_departamento = f.codigo_departamento AND z.m = g.m
        GROUP BY f.codigo_departamento""",
    "run_summary": """
        SELECT c.codigo_departamento,
               coalesce(d.nombre, c.codigo_departamento) AS departamento, c.meses_estables,
               round_even(p.mape, 2) AS mape_principal,
               round_even(r.mape, 2) AS mape_recuperacion,
               CASE WHEN c.meses_estables < 48 THEN 'SIN_CV' WHEN p.mape IS NOT NULL THEN 'OK'
                    WHEN p.codigo_departamento IS NULL THEN 'ERROR:NO_CUTOFF'
                    ELSE 'ERROR:ZERO_ACTUAL' END AS estado
        FROM stable_count c
        LEFT JOIN departments d ON d.codigo_departamento = c.codigo_departamento
        LEFT JOIN primary_score p ON p.codigo_departamento = c.codigo_departamento
        LEFT JOIN recovery_score r ON r.codigo_departamento = c.codigo_departamento""",
    "forecast_rows": """
        SELECT p.codigo_departamento, ds AS mes_proyectado,
               CAST(greatest(round_even(yhat, 0), 0) AS BIGINT) AS atenciones_proyectadas,
               CAST(greatest(round_even(yhat - 1.96 * sigma, 0), 0) AS BIGINT)
                   AS limite_inferior_ic95,
               CAST(greatest(round_even(yhat + 1.96 * sigma, 0), 0) AS BIGINT)
                   AS limite_superior_ic95,
               mape_principal AS mape_validacion
        FROM predicted p JOIN run_summary r ON r.codigo_departamento = p.codigo_departamento
        WHERE estado = 'OK'""",
    # Splice
    "spliced": """
        SELECT codigo_departamento, ds, max(actual) AS actual, max(projected) AS projected
        FROM (SELECT codigo_departamento, ds, CAST(aten AS DOUBLE) AS actual,
                     CAST(NULL AS DOUBLE) AS projected
              FROM series WHERE ds >= DATE '2001-01-01'
              UNION ALL
              SELECT codigo_departamento, mes_proyectado, NULL, atenciones_proyectadas
              FROM forecast_rows)
        GROUP BY ALL""",
    "spliced_ratio": """
        SELECT s.codigo_departamento, ds, projected IS NOT NULL AS is_projected,
               coalesce(actual, projected) AS aten,
               coalesce(actual, projected) / nullif(linea_base, 0) * 100 AS ratio
        FROM spliced s LEFT JOIN dept_base b ON b.codigo_departamento = s.codigo_departamento""",
    "spliced_features": """
        SELECT p.codigo_departamento, p.ds, p.ratio, a.ratio AS ratio_lag1,
               b.ratio AS ratio_lag2, c.ratio AS ratio_lag3, e.ratio AS ratio_lag12,
               a.aten AS aten_lag1, e.aten AS aten_lag12
        FROM spliced_ratio p
        LEFT JOIN spliced_ratio a ON a.codigo_departamento = p.codigo_departamento
                                 AND a.ds = p.ds - INTERVAL 1 MONTH
        LEFT JOIN spliced_ratio b ON b.codigo_departamento = p.codigo_departamento
                                 AND b.ds = p.ds - INTERVAL 2 MONTH
        LEFT JOIN spliced_ratio c ON c.codigo_departamento = p.codigo_departamento
                                 AND c.ds = p.ds - INTERVAL 3 MONTH
        LEFT JOIN spliced_ratio e ON e.codigo_departamento = p.codigo_departamento
                                 AND e.ds = p.ds - INTERVAL 12 MONTH
        WHERE p.is_projected""",
    "spliced_whole": """
        SELECT * FROM spliced_features
        WHERE ratio IS NOT NULL AND ratio_lag1 IS NOT NULL AND ratio_lag2 IS NOT NULL
          AND ratio_lag3 IS NOT NULL AND ratio_lag12 IS NOT NULL AND aten_lag1 IS NOT NULL
          AND aten_lag12 IS NOT NULL""",
    # Classification
    "train": """
        SELECT *, CASE WHEN ratio >= 90 THEN 'Saturado' ELSE 'Normal' END AS nivel,
               CASE WHEN ratio_lag1 >= 90 THEN 'Saturado' ELSE 'Normal' END AS predicted
        FROM features
        WHERE anio BETWEEN 1996 AND 1998 AND ratio IS NOT NULL AND ratio_lag1 IS NOT NULL
          AND ratio_lag2 IS NOT NULL AND ratio_lag3 IS NOT NULL AND ratio_lag12 IS NOT NULL
          AND aten_lag1 IS NOT NULL AND aten_lag12 IS NOT NULL""",
    "folds": """
        SELECT codigo_departamento, ds, nivel,
               CAST((row_number() OVER (PARTITION BY nivel
                        ORDER BY md5('42|' || codigo_departamento || '|'
                                     || strftime(ds, '%Y-%m-%d'))) - 1)
                    % (SELECT greatest(2, least(5, min(n)))
                       FROM (SELECT count(*) AS n FROM train GROUP BY nivel)) AS INTEGER) AS fold
        FROM train""",
    "report": """
        SELECT c.nivel,
               coalesce(count(*) FILTER (WHERE predicted = c.nivel AND t.nivel = c.nivel)
                   / nullif(count(*) FILTER (WHERE predicted = c.nivel), 0), 0) AS precision,
               coalesce(count(*) FILTER (WHERE predicted = c.nivel AND t.nivel = c.nivel)
                   / nullif(count(*) FILTER (WHERE t.nivel = c.nivel), 0), 0) AS recall,
               coalesce(2 * count(*) FILTER (WHERE predicted = c.nivel AND t.nivel = c.nivel)
                   / nullif(count(*) FILTER (WHERE predicted = c.nivel)
                            + count(*) FILTER (WHERE t.nivel = c.nivel), 0), 0) AS f1,
               count(*) FILTER (WHERE t.nivel = c.nivel) AS support
        FROM (SELECT nivel FROM train UNION SELECT predicted FROM train) c CROSS JOIN train t
        GROUP BY c.nivel""",
}


def _again(suffix: str, names: tuple[str, ...], changed: str, into: str) -> dict[str, str]:
    """Steps once more under other names, with one expression changed."""
    own = rf"\b({'|'.join(names)})\b"
    return {
        f"{name}_{suffix}": re.sub(own, rf"\1_{suffix}", re.sub(changed, into, _STEPS[name]))
        for name in names
    }


# The backtest with cutoffs 31 days apart, and the star over attendance with faults.
_BACKTEST = ("cuts", "cut_line", "cut_season", "cut_error", "horizons", "primary_score")
_STAR = (
    "clean", "fact", "geo_seen", "facility_seen", "geo", "times", "specialties", "facilities",
    "resolved", "loaded", "departments", "districts",
)
_STEPS |= _again("31", _BACKTEST, r"183 \* k", "31 * k")
_STEPS |= _again("dirty", _STAR, r"\braw_attendance\b", "dirty_attendance")

_FEATURES = ", ".join(
    f"round({c}, 6) AS {c}"
    for c in (
        "ratio", "ratio_lag1", "ratio_lag2", "ratio_lag3", "ratio_lag12",
        "aten_lag1", "aten_lag12",
    )
)


def _counted(table: str, columns: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{column}' AS check_column, "
        f"count(*) FILTER (WHERE {violation}) AS n_violations FROM {source}"
        for column, violation in columns.items()
    )


def _nulls(table: str, columns: dict[str, str], source: str) -> str:
    return _counted(table, {c: f"{e} IS NULL" for c, e in columns.items()}, source)


def _repeats(table: str, key: str, expression: str, source: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{key}' AS check_column, count(*) AS n_violations "
        f"FROM (SELECT {expression} AS k FROM {source} GROUP BY ALL HAVING count(*) > 1)"
    )


def _orphans(child: str, column: str, key: str, source: str, parent: str, parent_key: str) -> str:
    return (
        f"SELECT '{child}' AS table_name, '{column}' AS check_column, count(*) AS n_violations "
        f"FROM {source} c WHERE {key} IS NOT NULL "
        f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_key} = c.{key})"
    )


def _all(*parts: str) -> str:
    return " UNION ALL ".join(parts)


_LEVEL_DOMAINS = {
    "binario": "('Normal', 'Saturado')",
    "tres": "('Bajo', 'Normal', 'Saturado')",
    "cuatro": "('Bajo', 'Normal', 'Alto', 'Critico')",
}

_SELECTS: dict[str, str] = {
    "clean_attendance": """
        SELECT periodo, nombre_centro, especialidad, red_asistencial, ubigeo, cantidad,
               count(*) AS n
        FROM clean GROUP BY ALL""",
    "fact_aggregate": "SELECT * FROM fact",
    "stream_fact_aggregate": "SELECT * FROM fact",
    "name_norm": r"""
        SELECT doc_id, regexp_replace(strip_accents(replace(replace(replace(replace(replace(upper(
                   trim(coalesce(text, '') || CASE WHEN doc_id % 97 = 0 THEN
                            ' ' || chr(160) || 'ﬁnal½' || chr(8195) || 'ﬀ Ⅷ ' ELSE '' END,
                        ' ' || chr(9) || chr(10) || chr(13) || chr(160) || chr(8195))),
                   'ẞ', 'SS'), 'ﬁ', 'FI'), 'ﬀ', 'FF'), '½', '1⁄2'), 'Ⅷ', 'VIII')),
                   '[\s\x{a0}\x{2003}]+', ' ', 'g') AS text_norm
        FROM documents""",
    "geo_code_norm": """
        SELECT raw_code, ubigeo, regexp_full_match(ubigeo, '[0-9]{6}') AS valid
        FROM (SELECT raw_code, CASE WHEN code = '' THEN '' WHEN length(code) < 6
                     THEN lpad(code, 6, '0') ELSE code END AS ubigeo
              FROM (SELECT UBIGEO AS raw_code, regexp_replace(UBIGEO, '[^0-9]', '', 'g') AS code
                    FROM (SELECT UBIGEO FROM raw_attendance UNION SELECT UBIGEO FROM raw_registry)))
        """,
    "ingest_profile": """
        SELECT 'filas_leidas' AS metric, count(*) AS value FROM raw_attendance
        UNION ALL SELECT 'filas_consultas', count(*) FROM clean
        UNION ALL SELECT 'cantidad_no_numerica', count(*) FROM clean WHERE cantidad IS NULL
        UNION ALL SELECT 'especialidad_vacia', count(*) FROM clean WHERE especialidad = ''
        UNION ALL SELECT 'filas_hecho', count(*) FROM fact
        UNION ALL SELECT 'periodo_min', min(periodo) FROM times
        UNION ALL SELECT 'periodo_max', max(periodo) FROM times
        UNION ALL SELECT 'cantidad_total', CAST(sum(cantidad_atenciones) AS BIGINT) FROM fact
        UNION ALL SELECT 'establecimientos', count(*) FROM facilities
        UNION ALL SELECT 'nombre_centro_excede_150', count(*) FROM facilities
                  WHERE nombre_excede_150
        UNION ALL SELECT 'especialidades', count(*) FROM specialties
        UNION ALL SELECT 'periodos', count(*) FROM times
        UNION ALL SELECT 'ubigeos', count(*) FROM geo""",
    "delimited_fact": "SELECT * FROM fact",
    "published_fact": """
        SELECT periodo, nombre_centro, especialidad, ubigeo, cantidad_atenciones FROM loaded""",
    "incremental_fact": """
        SELECT periodo, nombre_centro, especialidad, ubigeo, cantidad_atenciones FROM loaded""",
    "streamed_star_fact": """
        SELECT periodo, nombre_centro, especialidad, ubigeo, cantidad_atenciones FROM loaded""",
    "replayed_fact": """
        SELECT periodo, nombre_centro, especialidad, ubigeo, cantidad_atenciones FROM loaded""",
    "training_month_totals": """
        SELECT CAST(periodo AS INTEGER) AS periodo, CAST(sum(cantidad_atenciones) AS BIGINT) AS total
        FROM loaded WHERE left(periodo, 4) IN ('1996', '1997', '1998') GROUP BY periodo""",
    "activity_counts": """
        SELECT trim(DES_ACT) AS des_act, count(*) AS n,
               count(*) FILTER (WHERE trim(DES_SER) = '') AS n_blank_specialty
        FROM raw_attendance GROUP BY ALL""",
    "specialty_top": """
        SELECT especialidad, count(*) AS n FROM clean GROUP BY ALL
        ORDER BY n DESC, especialidad LIMIT 5""",
    "dim_time": "SELECT * FROM times",
    "dim_specialty": "SELECT * FROM specialties",
    "facility_dominant": "SELECT * FROM facility_seen",
    "geo_dominant": "SELECT * FROM geo_seen",
    "registry_active": """
        SELECT cod_ipress, nombre_norm, categoria, ubigeo, ubigeo_valido, categoria_valida
        FROM active""",
    "registry_dedupe": "SELECT * FROM registry_names",
    "registry_geo": "SELECT * FROM registry_places",
    "registry_categories": "SELECT categoria, count(*) AS n FROM active GROUP BY ALL",
    "registry_profile": """
        SELECT metric, value, expected, value = expected AS ok FROM (
            SELECT 'filas_totales' AS metric, count(*) AS value, CAST(110 AS BIGINT) AS expected
            FROM raw_registry
            UNION ALL SELECT 'institucion', count(*), 99 FROM raw_registry
                      WHERE trim(INSTITUCION) = 'OWN'
            UNION ALL SELECT 'activos', count(*), NULL FROM active
            UNION ALL SELECT 'categoria_0', count(*), NULL FROM active WHERE categoria = '0'
            UNION ALL SELECT 'ubigeo_invalido', count(*), NULL FROM active
                      WHERE NOT ubigeo_valido
            UNION ALL SELECT 'cod_ipress_duplicados', count(*) - count(DISTINCT cod_ipress), NULL
                      FROM active
            UNION ALL SELECT 'nombre_norm_duplicados', count(*) - count(DISTINCT nombre_norm),
                      NULL FROM active)""",
    "geo_union": "SELECT * FROM geo",
    "facility_enrich": """
        SELECT nombre_centro, nombre_norm, cod_ipress, categoria FROM facilities""",
    "facility_match_rate": """
        SELECT count(*) AS n_total, count(cod_ipress) AS n_matched,
               round(count(cod_ipress) / count(*), 6) AS match_rate,
               count(*) FILTER (WHERE g.ubigeo IS NULL) AS n_without_geography
        FROM facilities f LEFT JOIN geo g ON f.ubigeo = g.ubigeo""",
    "facility_dim": """
        SELECT nombre_centro, nullif(red_asistencial, '') AS red_asistencial, cod_ipress,
               categoria, g.ubigeo AS ubigeo_resolved, nombre_excede_150
        FROM facilities f LEFT JOIN geo g ON f.ubigeo = g.ubigeo""",
    "dim_department": "SELECT * FROM departments",
    "geo_department_backfill": "SELECT * FROM districts",
    "fact_load": """
        SELECT periodo, nombre_centro, especialidad, ubigeo, cantidad_atenciones FROM loaded""",
    "fact_quarantine": """
        SELECT periodo, nombre_centro, especialidad, ubigeo, reason
        FROM (SELECT *, concat_ws(',',
                  CASE WHEN id_tiempo IS NULL THEN 'id_tiempo' END,
                  CASE WHEN key_e IS NULL THEN 'id_establecimiento' END,
                  CASE WHEN key_s IS NULL THEN 'id_especialidad' END,
                  CASE WHEN key_g IS NULL THEN 'id_geografia' END,
                  CASE WHEN cantidad_atenciones IS NULL THEN 'cantidad_atenciones' END) AS reason
              FROM resolved)
        WHERE reason <> ''""",
    "quarantine_reasons": """
        SELECT 'id_tiempo' AS key_name, count(*) AS n_failed FROM resolved
        WHERE id_tiempo IS NULL
        UNION ALL SELECT 'id_establecimiento', count(*) FROM resolved WHERE key_e IS NULL
        UNION ALL SELECT 'id_especialidad', count(*) FROM resolved WHERE key_s IS NULL
        UNION ALL SELECT 'id_geografia', count(*) FROM resolved WHERE key_g IS NULL
        UNION ALL SELECT 'cantidad_atenciones', count(*) FROM resolved
                  WHERE cantidad_atenciones IS NULL""",
    "fact_valid_rate": """
        SELECT n_total, n_loaded, n_total - n_loaded AS n_rejected,
               round(n_loaded / n_total, 6) AS valid_rate, n_loaded / n_total >= 0.95 AS passes
        FROM (SELECT (SELECT count(*) FROM resolved) AS n_total,
                     (SELECT count(*) FROM loaded) AS n_loaded)""",
    "facility_monthly": "SELECT * FROM monthly",
    "facility_baseline": "SELECT * FROM facility_base",
    "facility_baseline_mean": """
        SELECT nombre_centro, count(*) AS meses,
               CASE WHEN count(*) >= 24 THEN round_even(avg(total), 2) END AS linea_base
        FROM monthly WHERE anio NOT IN (1999, 2000) GROUP BY nombre_centro""",
    "customer_baseline": """
        SELECT o_custkey, count(*) AS meses,
               CASE WHEN count(*) >= 8 THEN round_even(quantile_cont(total, 0.9), 2) END
                   AS linea_base
        FROM (SELECT o_custkey, date_trunc('month', o_orderdate) AS ds,
                     CAST(sum(floor(o_totalprice)) AS BIGINT) AS total
              FROM orders GROUP BY ALL)
        WHERE year(ds) NOT IN (1999, 2000) GROUP BY o_custkey""",
    "facility_dim_with_baseline": """
        SELECT f.nombre_centro, linea_base AS linea_base_operativa
        FROM facilities f LEFT JOIN facility_base b ON f.nombre_centro = b.nombre_centro""",
    "baseline_distribution": """
        SELECT count(linea_base) AS n, round(avg(linea_base), 6) AS mean,
               round(stddev_samp(linea_base), 6) AS std, round(min(linea_base), 6) AS min,
               round(quantile_cont(linea_base, 0.25), 6) AS p25,
               round(quantile_cont(linea_base, 0.5), 6) AS p50,
               round(quantile_cont(linea_base, 0.75), 6) AS p75, round(max(linea_base), 6) AS max
        FROM facility_base""",
    "baseline_coverage": """
        SELECT count(*) AS n_total, count(linea_base) AS n_with_base,
               count(*) - count(linea_base) AS n_without_base
        FROM facility_base""",
    "facility_saturation": """
        SELECT nombre_centro, periodo, total, round(ratio, 6) AS ratio FROM facility_ratio""",
    "facility_levels": """
        SELECT nombre_centro, periodo, round(ratio, 6) AS ratio,
               CASE WHEN ratio < 70 THEN 'Bajo' WHEN ratio < 90 THEN 'Normal'
                    WHEN ratio <= 110 THEN 'Alto' ELSE 'Critico' END AS nivel
        FROM facility_ratio WHERE ratio IS NOT NULL""",
    "dept_series": "SELECT * FROM series",
    "dept_baseline": """
        SELECT codigo_departamento, round(linea_base, 6) AS linea_base FROM dept_base""",
    "dept_saturation": """
        SELECT codigo_departamento, ds, aten, round(ratio, 6) AS ratio FROM dept_ratio""",
    "dept_levels": "SELECT * REPLACE (round(ratio, 6) AS ratio) FROM levels",
    "level_distribution": """
        SELECT 'binario' AS scheme, nivel_binario AS nivel, count(*) AS n FROM levels GROUP BY ALL
        UNION ALL SELECT 'tres', nivel_tres, count(*) FROM levels GROUP BY ALL
        UNION ALL SELECT 'cuatro', nivel_cuatro, count(*) FROM levels GROUP BY ALL""",
    "dept_panel": "SELECT codigo_departamento, ds, aten FROM panel",
    "panel_features": f"SELECT codigo_departamento, ds, mes, anio, {_FEATURES} FROM features",
    "dq_unique": _all(
        _repeats("dim_tiempo", "id_tiempo", "id_tiempo", "times"),
        _repeats("dim_tiempo", "periodo", "periodo", "times"),
        _repeats("dim_geografia", "id_geografia", "ubigeo", "geo"),
        _repeats("dim_geografia", "ubigeo", "ubigeo", "geo"),
        _repeats("dim_establecimiento", "id_establecimiento", "nombre_centro", "facilities"),
        _repeats("dim_establecimiento", "nombre_centro", "nombre_centro", "facilities"),
        _repeats("dim_especialidad", "id_especialidad", "especialidad", "specialties"),
        _repeats("dim_especialidad", "especialidad", "especialidad", "specialties"),
        _repeats("dim_departamento", "id_departamento", "codigo_departamento", "departments"),
        _repeats("dim_departamento", "codigo_departamento", "codigo_departamento", "departments"),
        _repeats("fact_atenciones", "id_tiempo,id_establecimiento,id_especialidad,id_geografia",
                 "(id_tiempo, key_e, key_s, key_g)", "loaded"),
        _repeats("registro_activo", "cod_ipress", "cod_ipress", "active"),
        _repeats("registro_activo", "nombre_norm", "nombre_norm", "active"),
        _repeats("geografia_registro", "ubigeo", "ubigeo", "registry_places"),
    ),
    "dq_foreign_key": _all(
        _orphans("dim_geografia", "id_departamento", "codigo_departamento",
                 "districts", "departments", "codigo_departamento"),
        _orphans("dim_establecimiento", "id_geografia", "ubigeo",
                 "(SELECT g.ubigeo FROM facilities f LEFT JOIN geo g ON f.ubigeo = g.ubigeo)",
                 "geo", "ubigeo"),
        _orphans("fact_atenciones", "id_tiempo", "id_tiempo", "loaded", "times", "id_tiempo"),
        _orphans("fact_atenciones", "id_establecimiento", "key_e",
                 "loaded", "facilities", "nombre_centro"),
        _orphans("fact_atenciones", "id_especialidad", "key_s",
                 "loaded", "specialties", "especialidad"),
        _orphans("fact_atenciones", "id_geografia", "key_g", "loaded", "geo", "ubigeo"),
        _orphans("fact_agregado", "periodo", "periodo",
                 "(SELECT TRY_CAST(periodo AS INTEGER) AS periodo FROM fact)", "times", "periodo"),
        _orphans("fact_agregado", "nombre_centro", "nombre_centro", "fact", "facilities",
                 "nombre_centro"),
        _orphans("fact_agregado", "especialidad", "especialidad", "fact", "specialties",
                 "especialidad"),
        _orphans("fact_agregado", "ubigeo", "ubigeo", "fact", "geo", "ubigeo"),
    ),
    "dq_not_null": _all(
        _nulls("dim_tiempo", {c: c for c in (
            "id_tiempo", "periodo", "anio", "mes", "nombre_mes", "trimestre", "semestre",
            "fecha_inicio")}, "times"),
        _nulls("dim_geografia", {
            "id_geografia": "ubigeo", "ubigeo": "ubigeo", "departamento": "departamento",
            "provincia": "provincia", "distrito": "distrito"}, "geo"),
        _nulls("dim_establecimiento", {
            "id_establecimiento": "nombre_centro", "nombre_centro": "nombre_centro"},
            "facilities"),
        _nulls("dim_especialidad", {
            "id_especialidad": "especialidad", "especialidad": "especialidad"}, "specialties"),
        _nulls("dim_departamento", {
            "id_departamento": "codigo_departamento",
            "codigo_departamento": "codigo_departamento", "nombre": "nombre"}, "departments"),
        _nulls("fact_atenciones", {
            "id_tiempo": "id_tiempo", "id_establecimiento": "key_e", "id_especialidad": "key_s",
            "id_geografia": "key_g", "cantidad_atenciones": "cantidad_atenciones"}, "resolved"),
    ),
    "dq_length": _all(
        _counted("dim_tiempo", {"nombre_mes": "length(nombre_mes) > 12"}, "times"),
        _counted("dim_geografia", {
            "ubigeo": "length(ubigeo) > 6", "departamento": "length(departamento) > 50",
            "provincia": "length(provincia) > 100", "distrito": "length(distrito) > 100"}, "geo"),
        _counted("dim_establecimiento", {
            "nombre_centro": "length(nombre_centro) > 150",
            "red_asistencial": "length(red_asistencial) > 100",
            "cod_ipress": "length(cod_ipress) > 8", "categoria": "length(categoria) > 10"},
            "facilities"),
        _counted("dim_especialidad", {
            "especialidad": "length(especialidad) > 60", "area": "length(area) > 30"},
            "specialties"),
        _counted("dim_departamento", {
            "codigo_departamento": "length(codigo_departamento) > 2",
            "nombre": "length(nombre) > 50"}, "departments"),
    ),
    "dq_domain": _all(*[
        _counted(f"niveles_{scheme}", {"nivel_cuatro": f"nivel_cuatro NOT IN {domain}"}, "levels")
        for scheme, domain in _LEVEL_DOMAINS.items()
    ]),
    "forecast_seasonal": "SELECT * EXCLUDE (mape_validacion) FROM forecast_rows",
    "forecast_waves": """
        SELECT codigo_departamento, mes_proyectado, round(yhat, 3) AS yhat,
               round(sigma, 3) AS sigma,
               CAST(greatest(round_even(yhat, 0), 0) AS BIGINT) AS atenciones_proyectadas,
               CAST(greatest(round_even(yhat - 1.96 * sigma, 0), 0) AS BIGINT)
                   AS limite_inferior_ic95,
               CAST(greatest(round_even(yhat + 1.96 * sigma, 0), 0) AS BIGINT)
                   AS limite_superior_ic95
        FROM wave_forecast""",
    "forecast_published": """
        SELECT codigo_departamento, mes_proyectado, atenciones_proyectadas, mape_validacion
        FROM forecast_rows""",
    "backtest_mape": "SELECT codigo_departamento, round(mape, 4) AS mape FROM primary_score",
    "recovery_mape": """
        SELECT codigo_departamento, n_months, round(mape, 4) AS mape FROM recovery_score""",
    "forecast_summary": "SELECT * FROM run_summary",
    "forecast_acceptance": """
        SELECT count(*) AS n_total, count(*) FILTER (WHERE estado = 'OK') AS n_ok,
               count(*) FILTER (WHERE estado = 'OK' AND mape_principal < 10) AS n_under_limit,
               round(quantile_cont(mape_principal, 0.5) FILTER (WHERE estado = 'OK'), 6)
                   AS mediana_principal,
               round(quantile_cont(mape_recuperacion, 0.5) FILTER (WHERE estado = 'OK'), 6)
                   AS mediana_recuperacion
        FROM run_summary""",
    "splice_features": f"SELECT codigo_departamento, ds, {_FEATURES} FROM spliced_whole",
    "splice_dropped": """
        SELECT n_projected, n_kept, n_projected - n_kept AS n_dropped
        FROM (SELECT (SELECT count(*) FROM spliced_features) AS n_projected,
                     (SELECT count(*) FROM spliced_whole) AS n_kept)""",
    "class_weights": """
        SELECT nivel, count(*) AS n,
               round((SELECT count(*) FROM train)
                     / ((SELECT count(DISTINCT nivel) FROM train) * count(*)), 6) AS weight
        FROM train GROUP BY nivel""",
    "stratified_folds": "SELECT codigo_departamento, ds, nivel, fold FROM folds",
    "class_vectors": """
        SELECT t.codigo_departamento, t.ds, t.nivel,
               CASE WHEN t.nivel = 'Saturado' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
               round((SELECT count(*) FROM train) / ((SELECT count(DISTINCT nivel) FROM train)
                     * (SELECT count(*) FROM train u WHERE u.nivel = t.nivel)), 6) AS weight,
               round(ratio_lag1, 6) AS x_ratio_lag1, round(ratio_lag2, 6) AS x_ratio_lag2,
               round(ratio_lag3, 6) AS x_ratio_lag3, round(ratio_lag12, 6) AS x_ratio_lag12,
               round(aten_lag1::DOUBLE, 6) AS x_aten_lag1,
               round(aten_lag12::DOUBLE, 6) AS x_aten_lag12, mes::DOUBLE AS x_mes,
               (SELECT count(DISTINCT codigo_departamento) FROM series s
                WHERE s.codigo_departamento <= t.codigo_departamento) AS entity_at,
               8 + (SELECT count(DISTINCT codigo_departamento) FROM series) AS n_features,
               1.0::DOUBLE AS entity_sum
        FROM train t""",
    "oof_majority": """
        SELECT f.codigo_departamento, f.ds, f.nivel, f.fold,
               (SELECT o.nivel FROM folds o WHERE o.fold <> f.fold
                GROUP BY o.nivel ORDER BY count(*) DESC, o.nivel LIMIT 1) AS prediction
        FROM folds f""",
    "publish_persistence": """
        SELECT codigo_departamento, ds AS mes_clasificado,
               round_even(ratio, 2) AS ratio_saturacion,
               CASE WHEN ratio_lag1 >= 90 THEN 'Saturado' ELSE 'Normal' END AS nivel_saturacion,
               (SELECT round_even(avg(f1) * 100, 2) FROM report) AS f1_score_validacion
        FROM spliced_whole""",
    "backtest_long_era": """
        SELECT codigo_departamento, round(mape, 4) AS mape FROM primary_score_31""",
    "f1_scores": """
        SELECT round(avg(f1) * 100, 6) AS f1_macro,
               round(sum(f1 * support) / sum(support) * 100, 6) AS f1_weighted
        FROM report""",
    "f1_acceptance": """
        SELECT round(avg(f1) * 100, 6) AS f1_macro,
               round(sum(f1 * support) / sum(support) * 100, 6) AS f1_weighted,
               avg(f1) * 100 >= 80 AS passes
        FROM report""",
    "class_report": """
        SELECT nivel, round(precision, 6) AS precision, round(recall, 6) AS recall,
               round(f1, 6) AS f1, support
        FROM report
        UNION ALL
        SELECT 'accuracy', round(a, 6), round(a, 6), round(a, 6), n
        FROM (SELECT count(*) FILTER (WHERE nivel = predicted) / count(*) AS a, count(*) AS n
              FROM train)
        UNION ALL
        SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
               CAST(sum(support) AS BIGINT)
        FROM report
        UNION ALL
        SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
               round(sum(recall * support) / sum(support), 6),
               round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT)
        FROM report""",
}


_ON_DIRTY = {"quarantine_reasons", "dq_unique", "dq_foreign_key", "dq_not_null", "dq_length"}


def _used(sql: str, found: frozenset[str] = frozenset()) -> frozenset[str]:
    for name in set(re.findall(r"\w+", sql)) & _STEPS.keys() - found:
        found = _used(_STEPS[name], found | {name})
    return found


def oracle_sql() -> dict[str, str]:
    result = {}
    for key, select in _SELECTS.items():
        if key in _ON_DIRTY:
            select = re.sub(rf"\b({'|'.join(_STAR)})\b(?!')", r"\1_dirty", select)
        used = _used(select)
        steps = ",\n".join(f"{name} AS ({_STEPS[name]})" for name in _STEPS if name in used)
        recursive = "RECURSIVE " * ("wave_steps" in used)
        result[key] = f"WITH {recursive}{steps}\n{select}" if steps else select
    return result
