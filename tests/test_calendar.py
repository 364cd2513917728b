"""Holidays, working days, vacations and time zones against known facts."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from chronogrid.functions import numbers, timeparts
from chronogrid.operators import calendar

HOLIDAYS_2023 = "01-01 04-07 04-09 04-10 04-27 05-05 05-18 05-28 05-29 12-25 12-26"
HOLIDAYS_2024 = "01-01 03-29 03-31 04-01 04-27 05-05 05-09 05-19 05-20 12-25 12-26"
REGIONS = ("north", "middle", "south")


def periods_2023(spark, with_christmas=False):
    d = date
    rows = [
        ("spring", "south", 2023, d(2023, 2, 18), d(2023, 2, 26)),
        ("spring", "middle", 2023, d(2023, 2, 25), d(2023, 3, 5)),
        ("spring", "north", 2023, d(2023, 2, 25), d(2023, 3, 5)),
        ("summer", "middle", 2023, d(2023, 7, 8), d(2023, 8, 20)),
        ("summer", "south", 2023, d(2023, 7, 15), d(2023, 8, 27)),
        ("summer", "north", 2023, d(2023, 7, 22), d(2023, 9, 3)),
        ("fall", "middle", 2023, d(2023, 10, 14), d(2023, 10, 22)),
        ("fall", "south", 2023, d(2023, 10, 14), d(2023, 10, 22)),
        ("fall", "north", 2023, d(2023, 10, 21), d(2023, 10, 29)),
    ]
    rows += [("may", r, 2023, d(2023, 4, 29), d(2023, 5, 7)) for r in REGIONS]
    if with_christmas:
        rows += [("christmas", r, 2023, d(2023, 1, 1), d(2023, 12, 31)) for r in REGIONS]
    return calendar.vacation_table(spark, rows)


@pytest.fixture
def year_2023(spark):
    return spark.sql(
        "SELECT explode(sequence(timestamp'2023-01-01', timestamp'2023-12-31 23:00', interval 1 hour)) AS ts"
    )


def test_holidays_of_two_years(spark):
    years = spark.createDataFrame([(2023,), (2024,)], "year int")
    got = {r["date"].isoformat() for r in calendar.holidays(years).collect()}
    assert got == {f"2023-{d}" for d in HOLIDAYS_2023.split()} | {f"2024-{d}" for d in HOLIDAYS_2024.split()}


def test_two_holidays_on_one_date_the_later_listed_names_it(spark):
    rows = calendar.holidays(spark.createDataFrame([(2005,)], "year int")).filter("date = DATE'2005-05-05'").collect()
    assert [r["name"] for r in rows] == ["Ascension Thursday"]


def test_day_counts_2023(spark, year_2023):
    df = calendar.add_vacations(calendar.add_holidays(year_2023), periods_2023(spark))
    got = calendar.day_counts(df, ["is_holiday", "is_working_day", "is_school_vacation", "is_summer_vacation"]).first()
    assert tuple(got) == (365, 11, 252, 99, 58)


def test_christmas_envelope_covers_the_year_and_summer_keeps_its_name(spark, year_2023):
    df = calendar.add_vacations(year_2023, periods_2023(spark, with_christmas=True))
    assert df.filter("is_school_vacation = 1").count() == 365 * 24
    assert df.filter("vacation_type = 'summer'").count() == 58 * 24
    assert df.filter("vacation_type = 'none'").count() == 0


def test_envelope_of_days(spark):
    rows = [("fall", "north", 2023, date(2023, 10, d)) for d in (25, 21, 29)]
    days = spark.createDataFrame(rows, "type string, region string, year int, date date")
    got = calendar.vacation_envelope(days).first()
    assert (got["start_date"], got["end_date"]) == (date(2023, 10, 21), date(2023, 10, 29))


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


def test_daylight_saving_both_ways(spark):
    spring = one(spark, timeparts.to_local(F.lit("2024-03-31 01:00:00").cast("timestamp")))
    autumn = one(spark, timeparts.to_local(F.lit("2024-10-27 01:00:00").cast("timestamp")))
    assert (spring.hour, autumn.hour) == (3, 2)


def test_iso_weeks(spark):
    for day, week in (("2021-01-01", 53), ("2024-12-30", 1)):
        assert one(spark, timeparts.calendar_parts(F.lit(day).cast("timestamp"))["week_of_year"]) == week


def test_tolerant_parsing(spark):
    assert one(spark, timeparts.parse_timestamp(F.lit("31-02-2024 10:00"))) is None
    assert one(spark, timeparts.parse_timestamp(F.lit("28-02-2024 10:00"))) == datetime(2024, 2, 28, 10)
    assert one(spark, timeparts.parse_timestamp(F.lit("2024-02-28T10:00:00+00:00"))) == datetime(2024, 2, 28, 10)
    assert one(spark, numbers.decimal_comma(F.lit("0,123"))) == 0.123
    assert one(spark, numbers.decimal_comma(F.lit("0.5"))) == 0.5
    assert one(spark, numbers.decimal_comma(F.lit("n/a"))) is None


def test_ratio_with_zero_and_labels(spark):
    assert one(spark, numbers.ratio(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, numbers.title_label(F.lit("early_crisis"))) == "Early Crisis"
    assert one(spark, numbers.vacation_name(F.lit("Fall holiday"))) == "fall"
    assert one(spark, numbers.vacation_name(F.lit("Easter"))) is None
    assert one(spark, timeparts.date_ordinal(F.lit("2024-01-01").cast("timestamp"))) == date(2024, 1, 1).toordinal()
