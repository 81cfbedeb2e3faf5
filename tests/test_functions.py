from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom.functions import numeric, temporal, text


@pytest.fixture
def value(texts):
    def compute(expression, *inputs):
        names = [f"c{i}" for i in range(len(inputs))]
        frame = texts(names, inputs)
        return frame.select(expression(*[F.col(n) for n in names])).first()[0]

    return compute


@pytest.mark.parametrize(
    "given, expected",
    [
        ("santa barbara d'oeste", "Santa Barbara D'Oeste"),
        ("embu-guacu", "Embu-Guacu"),
        ("s/a", "S/A"),
        ("r2d2 3com", "R2d2 3com"),
        ("3D-4x", "3d-4x"),
        ("SÃO joão", "São João"),
        ("x_y\tz", "X_Y\tZ"),
        ("ßig 'ßig maß", "ßig 'ßig Maß"),
        ("  two  blanks ", "  Two  Blanks "),
        ("line\nend", "Line\nEnd"),
        ("", ""),
        (None, None),
    ],
)
def test_title_case(value, given, expected):
    assert value(text.title_case, given) == expected


def test_category_label(value):
    assert value(text.category_label, " cool_stuff ") == "Cool Stuff"


def test_region_code(value):
    assert value(text.region_code, " sp ") == "SP"
    assert value(text.region_code, "spx") == "SPX"


@pytest.mark.parametrize(
    "given, expected", [("   ", None), (None, None), (" a ", "a"), ("\ta", "\ta"), ("", None)]
)
def test_blank_to_null_strips_blanks_only(value, given, expected):
    assert value(text.blank_to_null, given) == expected


@pytest.mark.parametrize(
    "given, expected",
    [("   ", None), (None, None), (" 5.00 ", "5.00"), ("2.345", "2.35"), ("-2.345", "-2.35")],
)
def test_money(value, given, expected):
    assert value(numeric.money, given) == (expected and Decimal(expected))


@pytest.mark.parametrize("given", ["123456789012", "abc", "1,5"])
def test_money_refuses(value, given):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|NUMERIC_VALUE_OUT_OF_RANGE"):
        value(numeric.money, given)


@pytest.mark.parametrize("given", ["1.23456", "0.00004", "12345678901234567890.123456789012345678"])
def test_measure_keeps_every_digit(value, given):
    assert value(numeric.measure, f" {given} ") == Decimal(given)


@pytest.mark.parametrize("given", ["0.1234567890123456789", "1e-19", "1.5e3", "123456789012345678901"])
def test_measure_refuses_what_it_cannot_keep(value, given):
    with pytest.raises(Exception, match="more than 18 decimals|NUMERIC_VALUE_OUT_OF_RANGE"):
        value(numeric.measure, given)


def test_money_sum(value):
    def add(a, b):
        return numeric.money_sum(numeric.money(a), numeric.money(b))

    assert value(add, "10.00", "2.50") == Decimal("12.50")
    assert value(add, "10.00", None) is None
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        value(add, "99999999.99", "0.01")


def test_whole_number(value):
    assert value(numeric.whole_number, " 12 ") == 12


@pytest.mark.parametrize("given", ["1.0", "", "1e3"])
def test_whole_number_refuses(value, given):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|not a full date"):
        value(numeric.whole_number, given)


def test_dates(value):
    assert value(temporal.calendar_date, "2017-10-02 10:56:33") == date(2017, 10, 2)
    assert value(temporal.midnight, "2017-10-18 05:00:00") == datetime(2017, 10, 18)


@pytest.mark.parametrize("given", ["   ", "2017-10-02 garbage", "2017", "2017-10", "10:00"])
@pytest.mark.parametrize("function", [temporal.wall_clock, temporal.calendar_date])
def test_malformed_times_fail(value, function, given):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|not a full date"):
        value(function, given)


def test_wall_clock_ignores_the_session_zone(spark, value):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        # This local time was skipped when summer time began.
        assert value(temporal.wall_clock, "2017-10-15 00:30:00") == datetime(2017, 10, 15, 0, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_padded_names(value):
    def month(day):
        return temporal.month_name(day.cast("date"))

    def weekday(day):
        return temporal.day_name(day.cast("date"))

    assert value(month, "2017-05-03") == "May      "
    assert value(weekday, "2017-05-03") == "Wednesday"
    assert value(weekday, "2017-05-07") == "Sunday   "


def test_iso_weekday(value):
    assert value(lambda d: temporal.iso_weekday(d.cast("date")), "2017-01-01") == 7
    assert value(lambda d: temporal.iso_weekday(d.cast("date")), "2017-01-02") == 1


@pytest.mark.parametrize(
    "start, end, days",
    [
        ("2017-01-01 02:00:00", "2017-01-03 01:00:00", 1),
        ("2017-01-03 02:00:00", "2017-01-01 03:00:00", -1),
        ("2017-01-01 00:00:00", "2017-01-01 23:59:59", 0),
        ("2017-01-01 00:00:00", "2017-01-02 00:00:00", 1),
        ("2017-01-01 00:00:00", None, None),
    ],
)
def test_whole_days(value, start, end, days):
    def between(a, b):
        return temporal.whole_days(temporal.wall_clock(a), temporal.wall_clock(b))

    assert value(between, start, end) == days
