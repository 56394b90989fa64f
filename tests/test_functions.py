"""Unit vectors of the column functions, one job per table of cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapmart.functions import codes, dates
from snapmart.operators.aggregate import AGE_BANDS, banded


def apply(spark, fn, values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[1] for r in sorted(df.select("i", fn(F.col("v"))).collect())]


CASES = [
    (codes.normalise_code, [" 01 ", "1.0", None, "1.05"], ["01", "1", None, "1.05"]),
    (lambda c: codes.pad_code(c, 7), ["123", "12345678", "A1", None, "1.0"], ["0000123", "12345678", "A1", None, "0000001"]),
    (codes.strip_zeros, ["07", "10", "00", "A0", None], ["7", "10", "0", "A0", None]),
    (lambda c: codes.digits_code(c, 6), ["3222-05", "3222 05", "--", "51", "322205.0"], ["322205", "322205", None, "000051", "322205"]),
    (codes.catalog_code, [" a00.1", "b00.0", None], ["A001", "B000", None]),
    (codes.is_yes, [" sim ", "1", "true", "N", None], [True, True, True, False, False]),
    (codes.is_placeholder, ["", "0", "00", "nan", "x", None, "0.0"], [True, True, True, True, False, True, True]),
    (lambda c: codes.starts_with_any(c, ["51", "41"]), ["515105", "225125", None], [True, False, False]),
    (lambda c: codes.replace_sentinel(c, "0000", "none", "unknown"), ["0000", None, "0012"], ["none", "unknown", "0012"]),
    (codes.slug, ["  Título da Ocupação ", "A--b"], ["titulo_da_ocupacao", "a_b"]),
    (codes.to_amount, ["0.25", "0.35", "x"], [0.2, 0.4, None]),
    (codes.blank_to_null, ["  ", "a ", None], [None, "a", None]),
    (dates.parse_period, ["202509", "092025", "202513", "092010", "2025", "20259", None, "202509.0"],
     [dt.date(2025, 9, 1), dt.date(2025, 9, 1), None, dt.date(2010, 9, 1), None, None, None, dt.date(2025, 9, 1)]),
    (dates.parse_ymd, ["20250228", "20250231", "2025-02-28", "2025", None, "20250228.0"],
     [dt.date(2025, 2, 28), None, None, None, None, dt.date(2025, 2, 28)]),
    (lambda c: dates.year_month_date(F.lit("2025"), c), ["9", "09", "13", "9.0", None],
     [dt.date(2025, 9, 1), dt.date(2025, 9, 1), None, dt.date(2025, 9, 1), None]),
    (dates.key_period, ["2026068239592", "20x", None], ["202606", None, None]),
    (dates.is_period, ["202501", "202513", "189912", "20251", None], [True, False, False, False, False]),
]


@pytest.mark.parametrize("fn, given, wanted", CASES)
def test_vectors(spark, fn, given, wanted):
    assert apply(spark, fn, given) == wanted


def test_join_code_text(spark):
    df = spark.createDataFrame(
        [("07", "Odontologia"), ("07", None), (None, "x"), ("nan", None), (" ", "<NA>")], "c string, t string"
    )
    got = [r[0] for r in df.select(codes.join_code_text("c", "t", "- ")).collect()]
    assert got == ["07- Odontologia", "07", "x", None, None]


def test_snapshot_key(spark):
    df = spark.createDataFrame([(dt.date(2026, 6, 1), "8239592"), (None, "8239592")], "d date, c string")
    key = dates.snapshot_key("d", "c", fallback=F.lit("202606"))
    assert [r[0] for r in df.select(key).collect()] == ["2026068239592"] * 2


def test_age_bands(spark):
    got = apply(spark, lambda c: banded(c, AGE_BANDS), [0.0, 17.0, 18.0, 74.0, 75.0, 17.5, -1.0], "double")
    assert got == ["0-17", "0-17", "18-29", "60-74", "75+", None, None]


def test_calendar(spark):
    cols = dates.calendar_columns("v")
    days = [dt.date(2021, 1, 1), dt.date(2025, 8, 7), dt.date(2025, 8, 31)]
    assert apply(spark, lambda c: cols["week_of_year"], days, "date") == ["53", "32", "35"]
    assert apply(spark, lambda c: cols["week_of_month"], days, "date") == ["1", "1", "5"]
    assert apply(spark, lambda c: cols["weekday_name"], days, "date") == ["Sexta-feira", "Quinta-feira", "Domingo"]
    assert apply(spark, lambda c: cols["two_month"], days, "date") == ["1", "4", "4"]


def test_ranges(spark):
    times = [dt.datetime(2025, 1, 31, 23, 59), dt.datetime(2025, 2, 1), dt.datetime(2024, 12, 31)]
    jan = (dt.date(2025, 1, 1), dt.date(2025, 1, 31))
    assert apply(spark, lambda c: dates.day_range(c, *jan), times, "timestamp_ntz") == [True, False, False]
    assert apply(spark, lambda c: dates.month_range(c, dt.date(2024, 12, 9), dt.date(2025, 1, 2)), times, "timestamp_ntz") == [True, False, True]
    with pytest.raises(ValueError):
        dates.day_range("v", jan[1], jan[0])


def test_same_period_drops_null_dates(spark):
    df = spark.createDataFrame(
        [(dt.date(2025, 9, 30), "202509"), (dt.date(2025, 10, 1), "202509"), (None, "202509")], "d date, p string"
    )
    assert df.where(dates.same_period("d", "p")).count() == 1


def test_parameters():
    assert dates.last_complete_periods(dt.date(2026, 9, 15), 12)[::11] == ["202509", "202608"]
    assert dates.last_complete_periods(dt.date(2026, 1, 31), 1) == ["202512"]
    assert dates.retention_limit(dt.date(2026, 9, 15), 12) == dt.date(2025, 9, 1)
    assert dates.year_to_date(dt.date(2026, 9, 15)) == (dt.date(2026, 1, 1), dt.date(2026, 9, 15))
    assert codes.header_slug(" Código da Ocupação ") == "codigo_da_ocupacao"
    for bad in ("2025-13", "2025-1", "202501"):
        with pytest.raises(ValueError):
            dates.parse_month(bad)
    with pytest.raises(ValueError):
        dates.check_month_range("2025-02", "2025-01")


def test_slug_agrees_with_header_slug(spark):
    texts = ["Ação e Reação", "  Å ý Ž ñ  ", "São-Paulo (SP)", "ß ﬁ Ĳ ½ x²", "ＡＢ c", "日本", "", "a__b", "ÀÉÎÕÜ Ç", "e\u0301te"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", codes.slug("t").alias("s")).collect()
    assert {r.t: r.s or "" for r in got} == {t: codes.header_slug(t) for t in texts}


def test_names_period_is_same_period_of_the_parsed_text(spark):
    texts = ["202501", "012025", "202502", "022025", "2025-01", " 202501", "202501.0", "120110", "011201", "010112", "202513", "", "x", None]
    periods = ["202501", "202513", "120110", "120101", "011201", "2025-01", "2025-1", "2025", "20250", "", None]
    df = spark.createDataFrame([(t, p) for t in texts for p in periods], "t string, p string")
    told = df.select("t", "p", dates.names_period("t", "p").alias("a"), dates.same_period(dates.parse_period("t"), "p").alias("b")).collect()
    assert [r for r in told if r.a != r.b] == [] and sum(r.a for r in told) >= 4
    parts = [("2025", "1"), ("2025", "01"), ("2025", "10"), ("2025.0", "1.0"), (" 2025", "1"), ("1201", "10"), ("2025", ""), (None, "1"), ("2025", None)]
    df = spark.createDataFrame([(y, m, p) for y, m in parts for p in [*periods, "202510"]], "y string, m string, p string")
    here = dates.same_period(dates.year_month_date("y", "m"), "p")
    told = df.select("y", "m", "p", dates.year_month_names_period("y", "m", "p").alias("a"), here.alias("b")).collect()
    assert [r for r in told if r.a != r.b] == [] and sum(r.a for r in told) >= 4


def test_cheap_forms_of_codes_keep_odd_text(spark):
    texts = ["x", "Infinity", "-inf", "NaN", "nan", " 5 ", "1e3", "+3", ".5", "1d", "0x1p3", "e5", "", None]
    plain = apply(spark, lambda c: F.trim(c).try_cast("double"), texts)
    assert list(map(repr, apply(spark, codes.to_number, texts))) == list(map(repr, plain))
    short = lambda c: F.when(c.rlike("^[0-9]{1,2}$"), F.lpad(c, 3, "0")).otherwise(c)
    digits = ["7", "07", "007", "0007", "é", "7\n", "x", "", None]
    assert apply(spark, lambda c: codes.pad_digits(c, 3), digits) == apply(spark, short, digits)
    assert apply(spark, lambda c: codes.starts_with_any(c, ["51", "4"]), ["515", "42", "15", None]) == [True, True, False, False]
    assert apply(spark, codes.number_text, [10.0, 0.5, 12.25, 100.0, None], "double") == ["10", "0.5", "12.25", "100", None]
