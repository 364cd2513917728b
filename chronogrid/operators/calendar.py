"""Public holidays, working days and school vacations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Holidays on a fixed date, as (month, day, name).
FIXED_HOLIDAYS = [
    (1, 1, "New year"),
    (4, 27, "King's day"),
    (5, 5, "Liberation Day"),
    (12, 25, "Christmas Day"),
    (12, 26, "Boxing Day"),
]
# Holidays at a distance in days from Easter Sunday.
EASTER_HOLIDAYS = [
    (-2, "Good Friday"),
    (0, "Easter Sunday"),
    (1, "Easter Monday"),
    (39, "Ascension Thursday"),
    (49, "Whit Sunday"),
    (50, "Whit Monday"),
]
# Vacation types, the first has precedence over the later ones.
VACATION_PRIORITY = ["summer", "christmas", "spring", "may", "fall"]


def easter(year: Column) -> Column:
    """Easter Sunday of a Gregorian year (anonymous computus, integer arithmetic)."""
    def div(a: Column, b: int) -> Column:
        return F.floor(a / F.lit(b)).cast("bigint")

    golden = year % 19
    century = div(year, 100)
    in_century = year % 100
    moon_shift = div(century - div(century + 8, 25) + 1, 3)
    full_moon = (golden * 19 + century - div(century, 4) - moon_shift + 15) % 30
    to_sunday = (
        (century % 4) * 2 + div(in_century, 4) * 2 + 32 - full_moon - in_century % 4
    ) % 7
    late = div(golden + full_moon * 11 + to_sunday * 22, 451)
    after = (full_moon + to_sunday - late * 7).cast("int")
    return F.date_add(F.make_date(year.cast("int"), F.lit(3), F.lit(22)), after)


def holidays(years: DataFrame) -> DataFrame:
    """Holiday dimension (date, name, year) for a frame with a `year` column.

    Where two holidays share a date the one listed last names it.
    """
    year = F.col("year").cast("bigint")
    sunday = easter(year)
    entries = [
        (F.make_date(year.cast("int"), F.lit(m), F.lit(d)), name) for m, d, name in FIXED_HOLIDAYS
    ] + [(F.date_add(sunday, shift), name) for shift, name in EASTER_HOLIDAYS]
    rows = F.array(
        *[
            F.struct(day.alias("date"), F.lit(name).alias("name"), F.lit(i).alias("rank"))
            for i, (day, name) in enumerate(entries)
        ]
    )
    return (
        years.select(year.alias("year")).distinct()
        .select("year", F.explode(rows).alias("h"))
        .groupBy("year", "h.date")
        .agg(F.max_by("h.name", "h.rank").alias("name"))
        .select("date", "name", "year")
    )


def years_of(df: DataFrame, ts: str = "ts") -> DataFrame:
    """The years between the first and last row, as one row each."""
    ends = df.agg(F.year(F.min(ts)).alias("lo"), F.year(F.max(ts)).alias("hi"))
    return ends.filter("lo IS NOT NULL").select(F.explode(F.sequence("lo", "hi")).alias("year"))


def holiday_name(ts: Column) -> Column:
    """Name of the holiday a timestamp falls on, else NULL, worked out row by row.

    A holiday tied to Easter names a date it shares with a fixed one, as in
    `holidays`.
    """
    day = F.to_date(ts)

    def lookup(entries: list[tuple[int, str]]) -> Column:
        return F.create_map(*[F.lit(x) for entry in entries for x in entry])

    moving = lookup([(shift, name) for shift, name in EASTER_HOLIDAYS])
    fixed = lookup([(month * 100 + dom, name) for month, dom, name in FIXED_HOLIDAYS])
    from_easter = F.datediff(day, easter(F.year(day).cast("bigint")))
    return F.coalesce(
        F.try_element_at(moving, from_easter),
        F.try_element_at(fixed, F.month(day) * 100 + F.dayofmonth(day)),
    )


def add_holidays(df: DataFrame, ts: str = "ts", table: DataFrame | None = None) -> DataFrame:
    """Columns is_holiday, holiday_name and is_working_day.

    The national calendar needs no join and no pass over the data to find its years.
    A user's own `table` of (date, name) is reduced to one name per calendar day,
    which bounds the broadcast.
    """
    if table is None:
        named = df.withColumn("_name", holiday_name(F.col(ts)))
    else:
        own = table.groupBy(F.col("date").alias("_day")).agg(F.max("name").alias("_name"))
        named = df.withColumn("_day", F.to_date(ts)).join(F.broadcast(own), "_day", "left").drop("_day")
    known = F.col("_name").isNotNull()
    return named.withColumns(
        {
            "is_holiday": known.cast("bigint"),
            "holiday_name": F.coalesce(F.col("_name"), F.lit("")),
            "is_working_day": (~known & (F.weekday(ts) < 5)).cast("bigint"),
        }
    ).drop("_name")


def on_holidays(df: DataFrame, dates: DataFrame, ts: str = "ts") -> DataFrame:
    """Only the rows whose day is among the `date` values of a holiday table."""
    wanted = dates.select(F.col("date").alias("_day")).distinct()
    return df.withColumn("_day", F.to_date(ts)).join(F.broadcast(wanted), "_day", "left_semi").drop("_day")


def vacation_envelope(days: DataFrame) -> DataFrame:
    """Day rows (type, region, year, date) to one period per type, region and year."""
    return days.groupBy("type", "region", "year").agg(
        F.min("date").alias("start_date"), F.max("date").alias("end_date")
    )


def vacation_days(periods: DataFrame) -> DataFrame:
    """Vacation days, one row per date whatever the number of regions.

    The type with the highest precedence names the day. Exploding each period into
    days turns the range condition into an equality on the date.
    """
    rank = F.array_position(F.array(*[F.lit(t) for t in VACATION_PRIORITY]), F.col("type"))
    order = F.when(rank > 0, rank).otherwise(F.lit(len(VACATION_PRIORITY) + 1))
    exploded = periods.select(
        "type", order.alias("rank"), F.explode(F.sequence("start_date", "end_date")).alias("date")
    )
    return exploded.groupBy("date").agg(
        F.min_by("type", F.struct("rank", "type")).alias("vacation_type"),
        F.max((F.col("type") == "summer").cast("bigint")).alias("is_summer_vacation"),
    )


def add_vacations(df: DataFrame, periods: DataFrame, ts: str = "ts") -> DataFrame:
    """Columns is_school_vacation, is_summer_vacation and vacation_type.

    `periods` has (type, region, year, start_date, end_date); a day is a vacation
    day when it is one in any region. The broadcast holds at most one row per
    calendar day.
    """
    by_day = vacation_days(periods).withColumnRenamed("date", "_day")
    joined = df.withColumn("_day", F.to_date(ts)).join(
        F.broadcast(
            by_day.withColumnsRenamed({"vacation_type": "_type", "is_summer_vacation": "_summer"})
        ),
        "_day",
        "left",
    )
    return joined.withColumns(
        {
            "is_school_vacation": F.col("_type").isNotNull().cast("bigint"),
            "is_summer_vacation": F.coalesce("_summer", F.lit(0).cast("bigint")),
            "vacation_type": F.coalesce("_type", F.lit("none")),
        }
    ).drop("_day", "_type", "_summer")


def vacation_table(spark: SparkSession, rows: list[tuple[str, str, int, date, date]]) -> DataFrame:
    """A period table from Python rows (type, region, year, start_date, end_date)."""
    return spark.createDataFrame(
        rows, "type string, region string, year bigint, start_date date, end_date date"
    )


def day_counts(df: DataFrame, flags: list[str], ts: str = "ts") -> DataFrame:
    """Distinct days in total and per flag that is 1."""
    day = F.to_date(ts)
    per_day = df.groupBy(day.alias("day")).agg(*[F.max(f).alias(f) for f in flags])
    return per_day.agg(
        F.count("*").alias("total_days"), *[F.count_if(F.col(f) == 1).alias(f"{f}_days") for f in flags]
    )
