"""Scalar rules on their edge values, and against the plain-Python rule on generated text."""

import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from satmart.functions import levels, numbers, periods, text


def values(frame, rows, expression, kind="string"):
    df = frame([(i, r) for i, r in enumerate(rows)], f"i int, c {kind}")
    return [r.v for r in df.select("i", expression.alias("v")).orderBy("i").collect()]


def python_name(value):
    value = (value or "").upper().strip()
    value = "".join(
        c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c)
    )
    return re.sub(r"\s+", " ", value)


NAMES = ["  Ñandú \t  Güe x ", None, "straße", "Nº 1", "1ª", "36°", " a\x1fb ", "ﬁ ½ …", "한국 가각힣", "🄐 ㌀ 𝐀 ﷺ ǆ"]


def test_names_of_any_script(frame):
    got = values(frame, NAMES, text.normalize_name_exact(F.col("c")))
    assert got == [python_name(n) for n in NAMES]
    assert got[:3] == ["NANDU GUE X", "", "STRASSE"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], max_codepoint=0x17F)), min_size=20))
def test_native_names_equal_the_python_rule(frame, names):
    expanding = set(text._folding()[2])
    names = [n for n in names if not expanding & set(n.upper())]
    if names:
        got = values(frame, names, text.normalize_name(F.col("c")))
        assert got == [python_name(n) for n in names]


def test_every_expanding_letter(frame):
    letters = [f"a{c}b" for c in text._folding()[2][::7]]
    assert values(frame, letters, text.normalize_name_exact(F.col("c"))) == [
        python_name(n) for n in letters]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.sampled_from(text.WHITESPACE + "aé.~!\x7f\x00ñ")), min_size=30))
def test_trim_equals_strip(frame, names):
    assert values(frame, names, text.trim_ws(F.col("c"))) == [n.strip() for n in names]


def test_geo_codes(frame):
    codes = [" 15-01 ", "", None, "1234567", "AB", "90102", "010101"]
    got = values(frame, codes, text.normalize_geo_code(F.col("c")))
    assert got == ["001501", "", "", "1234567", "", "090102", "010101"]
    valid = values(frame, ["001501", "", "1234567", "12345a", "123456\n"],
                   text.is_six_digits(F.col("c")))
    assert valid == [True, False, False, False, False]


def test_lenient_numbers(frame):
    given_text = ["3.7", "12", "", "S/D", "1d", "1e3", "-2.9", "NaN", "inf", "1e300", None,
                  "9007199254740993", "-9223372036854775808", "9223372036854775808", "+7"]
    got = values(frame, given_text, numbers.lenient_long(F.col("c")))
    assert got == [3, 12, None, None, None, 1000, -2, None, None, None, None,
                   9007199254740993, -9223372036854775808, None, 7]


def test_rounding_is_half_even(frame):
    got = values(frame, [0.125, 0.135, 2.5], numbers.half_even(F.col("c"), 2), "double")
    assert got == [0.12, 0.14, 2.5]
    whole = values(frame, [2.5, 3.5, -7.2], numbers.whole_not_negative(F.col("c")), "double")
    assert whole == [2, 4, 0]


def test_percent_of_zero_is_null(frame):
    assert values(frame, [0.0, 10.0], numbers.percent(F.lit(5), F.col("c")), "double") == [
        None, 50.0
    ]


def test_periods(frame):
    got = values(frame, ["201501", "201513", "20151", ""], periods.period_start(F.col("c")))
    assert [str(v) for v in got] == ["2015-01-01", "None", "None", "None"]
    months = [1, 3, 4, 6, 7, 12]
    assert values(frame, months, periods.semester(F.col("c")), "int") == [1, 1, 1, 1, 2, 2]
    assert values(frame, [1, 9, 12], periods.month_name(F.col("c")), "int") == [
        "Enero", "Septiembre", "Diciembre"
    ]


RATIOS = [69.99, 70.0, 89.99, 90.0, 110.0, 110.01, float("nan"), None]


@pytest.mark.parametrize(
    ("scheme", "want"),
    [
        ("cuatro", ["Bajo", "Normal", "Normal", "Alto", "Alto", "Critico", None, None]),
        ("tres", ["Bajo", "Normal", "Normal", "Saturado", "Saturado", "Saturado", None, None]),
        ("binario", ["Normal", "Normal", "Normal", "Saturado", "Saturado", "Saturado", None, None]),
    ],
)
def test_levels(frame, scheme, want):
    assert values(frame, RATIOS, levels.level(F.col("c"), scheme), "double") == want
    assert {w for w in want if w} <= set(levels.DOMAINS[scheme])


def test_unknown_scheme_is_refused(spark):
    with pytest.raises(ValueError):
        levels.level(F.col("c"), "cinco")


def test_columns_containing(frame):
    df = frame([], "n_consultas int, otro int, MEDICOS int")
    assert text.columns_containing(df, "consult", "medic") == ["n_consultas", "MEDICOS"]


def python_code(value):
    digits = re.sub(r"\D", "", (value or "").strip())
    return digits and digits.zfill(6)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.sampled_from("0123456789 -٣A\n"), max_size=9), min_size=40))
def test_geo_codes_equal_the_python_rule(frame, codes):
    got = values(frame, codes, text.normalize_geo_code(F.col("c")))
    assert got == [python_code(c) for c in codes]
    valid = values(frame, got, text.is_six_digits(F.col("c")))
    assert valid == [re.fullmatch(r"\d{6}", c) is not None for c in got]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(0, 200), min_size=40))
def test_levels_equal_the_python_rule(frame, ratios):
    def four(r):
        return "Bajo" if r < 70 else "Normal" if r < 90 else "Alto" if r <= 110 else "Critico"

    assert values(frame, ratios, levels.level(F.col("c"), "cuatro"), "double") == list(map(four, ratios))
    merged = {"Alto": "Saturado", "Critico": "Saturado"}
    three = [merged.get(four(r), four(r)) for r in ratios]
    assert values(frame, ratios, levels.level(F.col("c"), "tres"), "double") == three
    two = ["Saturado" if t == "Saturado" else "Normal" for t in three]
    assert values(frame, ratios, levels.level(F.col("c"), "binario"), "double") == two
