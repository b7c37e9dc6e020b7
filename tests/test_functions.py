"""Column functions and period arithmetic, on rows that each hold one trap."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tillroll.functions import keys, labels, money, text, weeks
from tillroll.plans import calendar as cal


def one(df, *cols):
    row = df.select(*cols).first()
    return row[0] if len(cols) == 1 else tuple(row)


@pytest.fixture(scope="module")
def row(spark):
    return spark.range(1)


def test_ratio_modes(row):
    a, zero = F.lit(6), F.lit(0)
    assert one(row, money.safe_div(a, zero, "zero")) == 0.0
    assert one(row, money.safe_div(a, zero, "one")) == 6.0
    assert one(row, money.safe_div(a, zero, "null")) is None
    assert one(row, money.safe_div(F.lit(7), F.lit(2))) == 3.5
    with pytest.raises(ValueError):
        money.safe_div(a, zero, "other")


def test_rate_zero_and_missing_count_as_one(row):
    amount = F.lit(Decimal("10.00"))
    for rate, expected in ((Decimal("0.00"), 10), (None, 10), (Decimal("1.50"), 15)):
        assert one(row, money.in_home_currency(amount, F.lit(rate).cast("decimal(6,2)"))) == expected


def test_unit_value_rounds_half_up_and_survives_zero(row):
    assert one(row, money.unit_value(F.lit(Decimal("0.0100")), F.lit(Decimal("2.00")))) == Decimal("0.01")
    assert one(row, money.unit_value(F.lit(Decimal("5.0000")), F.lit(Decimal("0.00")))) == 0


def test_returned_quantities_net_and_moved(spark):
    df = spark.createDataFrame([(5, 2)], "qty_sold int, qty_return int")
    assert one(df, money.net_qty(), money.net_qty(mode="moved")) == (3, 7)


def test_receipt_keys(row):
    k = keys.receipt_row_key(F.lit(123456), F.lit(7))
    assert one(row, k, keys.receipt_head(k), keys.receipt_line(k)) == (123456007, 123456, 7)


def test_unknown_member_has_no_value(row):
    assert one(row, keys.known(F.lit(-1), F.lit("x"))) is None
    assert one(row, keys.known(F.lit(None).cast("int"), F.lit("x"))) is None
    assert one(row, keys.known(F.lit(0), F.lit("x"))) == "x"


def test_date_key_round_trip(row):
    day = dt.date(2000, 2, 29)
    key = keys.date_key(F.lit(day))
    assert one(row, key, keys.key_date(key)) == (20000229, day)
    assert keys.key_of(day) == 20000229


@pytest.mark.parametrize("value,expected", [(None, None), ("", None), (" , ,", None), ("a, b,,a", ["a", "b", "a"]), ([1, 2], ["1", "2"])])
def test_list_parameter(value, expected):
    assert text.split_list(value) == expected


def test_numbers_in_text(row):
    assert one(row, text.as_bigint(F.lit("12")), text.as_bigint(F.lit("x1"), -1), text.as_bigint(F.lit(""), -1)) == (12, -1, -1)
    assert one(row, text.is_numeric(F.lit("1.5")), text.is_numeric(F.lit("AVN"))) == (True, False)


def test_locale_formats(row):
    assert one(row, text.format_decimal(F.lit(Decimal("1234.5")))) == "1234,50"
    assert one(row, text.format_decimal(F.lit(Decimal("-0.10")))) == "-0,10"
    assert one(row, text.format_date(F.lit(dt.date(2021, 2, 3)))) == "03.02.2021"


@pytest.mark.parametrize("seconds,expected", [(0, "00:00:00"), (59, "00:00:59"), (86399, "23:59:59"), (90061, "25:01:01"), (360000, "100:00:00")])
def test_durations_run_past_a_day(row, seconds, expected):
    assert one(row, text.hhmmss(F.lit(seconds))) == expected


def test_text_comparison_and_length(row):
    assert one(row, text.same_text(F.lit("Abc "), F.lit("aBC")), text.sql_len(F.lit("ab  "))) == (True, 2)
    assert one(row, text.label(F.lit(None).cast("string"), F.lit("n"))) is None


def test_labels_default(row):
    assert one(row, labels.label_of(F.lit("Z"), labels.FLIGHT_TYPE, "Extra")) == "Extra"
    assert one(row, labels.label_of(F.lit(None).cast("string"), labels.FLIGHT_TYPE, "Extra")) == "Extra"
    assert one(row, labels.label_of(F.lit(5), labels.AGE_CHECK_APPROVED)) == "Passport"


@pytest.mark.parametrize(
    "day,weekday,iso,simple,stamp",
    [
        (dt.date(2021, 1, 1), 5, 53, 1, "2021010353"),
        (dt.date(2021, 1, 4), 1, 1, 2, "2021011001"),
        (dt.date(2020, 12, 31), 4, 53, 53, "2021010353"),
        (dt.date(2018, 1, 1), 1, 1, 1, "2018010701"),
        (dt.date(2017, 1, 1), 7, 52, 1, "2017010152"),
    ],
)
def test_weeks(row, day, weekday, iso, simple, stamp):
    d = F.lit(day)
    assert one(row, weeks.weekday_no(d), weeks.iso_week(d), weeks.calendar_week(d), weeks.week_stamp(d)) == (weekday, iso, simple, stamp)
    start, end = one(row, weeks.week_start(d), weeks.week_end(d))
    assert start.weekday() == 0 and end - start == dt.timedelta(days=6) and start <= day <= end


# -- periods ----------------------------------------------------------------------------------

AS_OF = dt.date(2024, 3, 31)


@pytest.mark.parametrize(
    "period,expected",
    [
        (cal.Period("Y"), (dt.date(2024, 1, 1), dt.date(2024, 3, 31))),
        (cal.Period("Y", ytd=-1), (dt.date(2023, 1, 1), dt.date(2023, 3, 31))),
        (cal.Period("R", unit="D", start=-10, duration=10), (dt.date(2024, 3, 21), dt.date(2024, 3, 30))),
        (cal.Period("R", unit="W", start=-1), (dt.date(2024, 3, 18), dt.date(2024, 3, 24))),
        (cal.Period("R", unit="M", start=-1), (dt.date(2024, 2, 1), dt.date(2024, 2, 29))),
        (cal.Period("R", unit="Q", start=-1), (dt.date(2023, 10, 1), dt.date(2023, 12, 31))),
        (cal.Period("R", unit="Y", start=-1, duration=2), (dt.date(2023, 1, 1), dt.date(2024, 12, 31))),
    ],
)
def test_period_bounds(period, expected):
    assert period.bounds(AS_OF) == expected


@settings(max_examples=60, deadline=None)
@given(
    as_of=st.dates(dt.date(1999, 1, 1), dt.date(2030, 12, 31)), unit=st.sampled_from("DWMQY"),
    start=st.integers(-6, 6), duration=st.integers(1, 5),
)
def test_relative_units_tile_the_calendar(as_of, unit, start, duration):
    whole = cal.Period("R", unit=unit, start=start, duration=duration).bounds(as_of)
    parts = [cal.Period("R", unit=unit, start=start + i).bounds(as_of) for i in range(duration)]
    assert (parts[0][0], parts[-1][1]) == whole
    for before, after in zip(parts, parts[1:]):
        assert after[0] - before[1] == dt.timedelta(days=1)
    first, last = cal.Period("R", unit=unit).bounds(as_of)
    assert first <= as_of <= last


def test_leap_day_a_year_earlier():
    windows = cal.YearWindows.of(dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert windows.last_year == (dt.date(2023, 2, 1), dt.date(2023, 2, 28))
    assert windows.last_ytd == (dt.date(2023, 1, 1), dt.date(2023, 2, 28))


def test_second_period_has_the_same_length():
    first = (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert cal.same_length(dt.date(2023, 2, 1), *first) == (dt.date(2023, 2, 1), dt.date(2023, 3, 1))


def test_calendar_offsets_agree_with_period_bounds(spark):
    days = cal.calendar(spark, dt.date(2022, 12, 25), dt.date(2024, 12, 31), AS_OF)
    for unit, column in (("D", "relative_day"), ("W", "relative_week"), ("M", "relative_month"), ("Q", "relative_quarter"), ("Y", "relative_year")):
        for offset in (-1, 0):
            found = cal.bounds_from_calendar(days, F.col(column) == offset).first()
            assert (found.date_from, found.date_to) == cal.Period("R", unit=unit, start=offset).bounds(AS_OF)
    ytd = cal.bounds_from_calendar(days, F.col("relative_ytd") == -1).first()
    assert (ytd.date_from, ytd.date_to) == cal.Period("Y", ytd=-1).bounds(AS_OF)
