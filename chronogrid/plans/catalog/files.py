"""Sources and sinks: files are derived from the given tables, written and read back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from chronogrid.functions.numbers import decimal_comma, tidy
from chronogrid.functions.timeparts import parse_timestamp
from chronogrid.operators import calendar, features, model
from chronogrid.plans.catalog.aggregates import tidied
from chronogrid.plans.catalog.alignment import UPSAMPLED
from chronogrid.plans.catalog.base import Tables, query, with_views
from chronogrid.plans.catalog.calendars import (
    HOLIDAY_SQL,
    JANUARY,
    JANUARY_FLAG,
    JANUARY_PHASE,
    MERGED,
    PRICE_SQL,
    yearly_periods,
    PERIOD_SQL,
)
from chronogrid.sources import files, prices, sinks, utilisation, weather

# Columns of the wide view standing in for the columns of a combined history.
HISTORY = {
    "elec_price": "total_volume",
    "emissionfactor": "emissionfactor",
    "temperature": "volume_sun",
    "humidity": "volume_land_wind",
    "gas_price": "volume_sea_wind",
}
HISTORY_SQL = ", ".join(f"tidy({k}) AS {v}" for k, v in HISTORY.items())
VOLUMES = ["volume_sun", "volume_land_wind", "volume_sea_wind"]


def history(t: Tables):
    """The wide view under the names of a combined history."""
    return t.wide.select("ts", *[tidy(F.col(k)).alias(v) for k, v in HISTORY.items()])


def written_split(t: Tables, label: str) -> str:
    folder = t.scratch(label)
    sinks.write_split(history(t), folder, "20240131")
    return folder


@query(
    "s1_mix_csv",
    with_views("wide") + "SELECT ts, tidy(elec_price) AS total_volume, tidy(emissionfactor) AS emissionfactor FROM wide",
)
def mix_csv(t: Tables):
    return utilisation.read_mix(t.spark, f"{written_split(t, 's1')}/{utilisation.HISTORY_GLOBS['mix']}")


@query("s2_production_csv", with_views("wide") + "SELECT ts, tidy(temperature) AS volume_sun FROM wide")
def production_csv(t: Tables):
    return utilisation.read_production(t.spark, f"{written_split(t, 's2')}/{utilisation.HISTORY_GLOBS['sun']}", "sun")


@query(
    "s3_many_files_newest_wins",
    with_views("wide")
    + """SELECT ts, CASE WHEN ts >= TIMESTAMP '2024-01-10' THEN tidy(tidy(temperature) * 2) ELSE tidy(tidy(temperature)) END AS volume_sun
    FROM wide""",
)
def many_files(t: Tables):
    folder = t.scratch("s3")
    old = history(t).select("ts", "volume_sun")
    new = old.filter(F.col("ts") >= F.lit("2024-01-10").cast("timestamp")).withColumn("volume_sun", F.col("volume_sun") * 2)
    sinks.write_split(old, folder, "20240115")
    swapped = sinks.split_sources(new)["sun"].select(
        utilisation.VOLUME_HEADER, F.lit("x").alias("remark"), utilisation.TIME_HEADER
    )
    sinks.write_table(swapped, f"{folder}/zon-20240131-uur-data.csv", "csv")
    return tidied(utilisation.read_source(t.spark, f"{folder}/{utilisation.HISTORY_GLOBS['sun']}", "sun"))


@query(
    "s1_mix_csv_under_several_headers",
    with_views("wide")
    + """SELECT ts, CASE WHEN ts >= TIMESTAMP '2024-01-10' THEN tidy(emissionfactor) ELSE tidy(elec_price) END AS total_volume,
    tidy(emissionfactor) AS emissionfactor FROM wide""",
)
def mix_under_several_headers(t: Tables):
    """The newer file has its columns in another order and one more."""
    folder = t.scratch("s1-headers")
    whole = history(t)
    sinks.write_split(whole, folder, "20240115")
    newer = whole.filter(F.col("ts") >= F.lit("2024-01-10").cast("timestamp"))
    part = sinks.split_sources(newer.withColumn("total_volume", F.col("emissionfactor")))["mix"].select(
        utilisation.FACTOR_HEADER, utilisation.VOLUME_HEADER, F.lit(1).alias("remark"), utilisation.TIME_HEADER
    )
    sinks.write_table(part, f"{folder}/electriciteitsmix-20240131-uur-data.csv", "csv")
    return utilisation.read_mix(t.spark, f"{folder}/{utilisation.HISTORY_GLOBS['mix']}")


@query("s4_history_scan", with_views("wide") + f"SELECT ts, {HISTORY_SQL} FROM wide")
def history_scan(t: Tables):
    return utilisation.read_history(t.spark, written_split(t, "s4"))


@query(
    "s5_forecast_scan",
    with_views("wide")
    + "SELECT ts, tidy(temperature) AS volume_sun, tidy(humidity) AS volume_land_wind, tidy(gas_price) AS volume_sea_wind FROM wide",
)
def forecast_scan(t: Tables):
    folder = t.scratch("s5")
    stems = {"sun": "zon", "land_wind": "wind", "sea_wind": "zeewind"}
    for which, part in sinks.split_sources(history(t).select("ts", *VOLUMES)).items():
        sinks.write_table(part, f"{folder}/{stems[which]}-uur-voorspelling-1.csv", "csv")
    return utilisation.read_forecast(t.spark, folder)


def landed_pages(t: Tables, label: str, which: str) -> str:
    """JSON pages of one day each, as a feed would deliver them."""
    folder = t.scratch(label)
    rows = history(t)
    volume = "total_volume" if which == "mix" else f"volume_{which}"
    member = [
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("validfrom"),
        F.col(volume).cast("string").alias("volume"),
    ]
    if which == "mix":
        member.append(F.col("emissionfactor").alias("emissionfactor"))
    days = rows.groupBy(F.to_date("ts").alias("page")).agg(
        F.sort_array(F.collect_list(F.struct(*member))).alias("hydra:member")
    )
    last = days.count()
    view = F.struct(F.concat(F.lit("/utilizations?type=1&page="), F.lit(str(last))).alias("hydra:last"))
    days.withColumn("hydra:view", view).repartition("page").write.partitionBy("page").json(folder)
    return folder


@query(
    "s6_json_members",
    with_views("wide") + "SELECT ts, tidy(elec_price) AS total_volume, tidy(emissionfactor) AS emissionfactor FROM wide",
)
def json_members(t: Tables):
    return utilisation.page_members(utilisation.read_pages(t.spark, landed_pages(t, "s6", "mix")), "mix")


@query(
    "s7_page_check",
    """SELECT count(DISTINCT CAST(ts AS DATE)) AS expected_pages, count(DISTINCT CAST(ts AS DATE)) AS landed_pages, true AS is_complete
    FROM events""",
)
def page_check(t: Tables):
    return utilisation.page_check(utilisation.read_pages(t.spark, landed_pages(t, "s7", "sun")))


@query(
    "s7_page_manifest",
    with_views("wide") + "SELECT CAST(ts AS DATE) AS day, CAST(1 AS BIGINT) AS n_files, count(*) AS members FROM wide GROUP BY 1",
)
def page_manifest(t: Tables):
    found = utilisation.page_manifest(utilisation.read_pages(t.spark, landed_pages(t, "s7-manifest", "sun")))
    return found.select("day", F.size("files").cast("bigint").alias("n_files"), "members")


@query(
    "s8_landed_filter",
    """SELECT event_id, ts, value FROM events WHERE event_type = 'click' AND user_id >= 75
    AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-17'""",
)
def landed_filter(t: Tables):
    path = t.scratch("s8")
    code = F.when(F.col("event_type") == "click", utilisation.TYPE_CODES["sun"]).otherwise(utilisation.TYPE_CODES["mix"])
    landed = t.events.select(
        "event_id",
        "ts",
        "value",
        code.alias("type"),
        F.when(F.col("user_id") >= 75, 2).otherwise(1).alias("classification"),
        F.to_date("ts").alias("date"),
    )
    sinks.write_table(landed, path, partition_by=["type", "classification", "date"])
    rows = t.spark.read.parquet(path)
    return utilisation.select_landed(rows, "sun", "history", date(2024, 1, 10), date(2024, 1, 17)).select(
        "event_id", "ts", "value"
    )


@query(
    "s9_feed_assembly",
    with_views("wide")
    + "SELECT ts, tidy(elec_price) AS total_volume, tidy(emissionfactor) AS emissionfactor, tidy(temperature) AS volume_sun FROM wide",
)
def feed_assembly(t: Tables):
    return utilisation.read_feed(t.spark, {k: landed_pages(t, f"s9-{k}", k) for k in ("mix", "sun")})


@query(
    "s10_date_windows",
    """SELECT 'runup' AS kind, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-29'
    UNION ALL SELECT 'forecast', count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-22'
    UNION ALL SELECT 'history', count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-02' AND o_orderdate < TIMESTAMP '2000-01-01'""",
)
def date_windows(t: Tables):
    orders = t.read("orders").select(F.col("o_orderdate").cast("timestamp").alias("ts"))
    asked = {
        "runup": (t.events, date(2024, 1, 29)),
        "forecast": (t.events, date(2024, 1, 15)),
        "history": (orders, date(2000, 1, 1)),
    }
    out = None
    for kind, (rows, today) in asked.items():
        start, end = (F.lit(d).cast("timestamp") for d in utilisation.window_of(kind, today))
        part = rows.filter((F.col("ts") >= start) & (F.col("ts") < end)).agg(
            F.lit(kind).alias("kind"), F.count("*").alias("n")
        )
        out = part if out is None else out.unionByName(part)
    return out


def _times(factor: int):
    return lambda x: x * F.lit(float(factor))


def landed_weather(t: Tables, label: str, drop_last: bool = False) -> str:
    """Payloads of one day and series each, with parallel arrays."""
    folder = t.scratch(label)
    rows = t.grid().withColumn("day", F.to_date("ts"))
    ordered = F.transform(
        F.array_sort(F.collect_list(F.struct(F.unix_seconds("ts").alias("t"), F.coalesce("y", F.lit(-1.0)).alias("y")))),
        lambda x: x["y"],
    )
    payload = rows.groupBy("item_id", "day").agg(
        F.unix_seconds(F.min("ts")).alias("time_start"),
        (F.unix_seconds(F.max("ts")) + 3600).alias("time_end"),
        F.lit(3600).alias("interval"),
        ordered.alias("temperature_2m"),
    )
    others = {
        name: F.transform("temperature_2m", _times(i + 1))
        for i, name in enumerate(weather.VARIABLES)
        if i
    }
    payload = payload.withColumns(others)
    if drop_last:
        payload = payload.withColumn("wind_direction_10m", F.slice("wind_direction_10m", 1, 12))
    payload.drop("day").write.json(folder)
    return folder


# The 23 variables are multiples of one measured series.
WEATHER_CELLS = {name: f"CAST(coalesce(y, -1) * {i + 1}.0::DOUBLE AS FLOAT)" for i, name in enumerate(weather.VARIABLES.values())}
WEATHER_SQL = "SELECT item_id, ts, " + ", ".join(f"tidy3({x}) AS {c}" for c, x in WEATHER_CELLS.items()) + " FROM grid"


def _variables(df):
    return df.select("item_id", "ts", *[tidy(F.col(c), 3).alias(c) for c in weather.VARIABLES.values()])


@query("s11_weather_history", with_views("grid") + WEATHER_SQL)
def weather_history(t: Tables):
    return _variables(weather.read_weather(t.spark, landed_weather(t, "s11")))


@query("s12_weather_forecast", with_views("grid") + WEATHER_SQL + " WHERE ts >= TIMESTAMP '2024-01-24'")
def weather_forecast(t: Tables):
    rows = weather.read_weather(t.spark, landed_weather(t, "s12"))
    return _variables(rows.filter(F.col("ts") >= F.lit("2024-01-24").cast("timestamp")))


@query(
    "s13_time_axis",
    with_views("grid")
    + "SELECT item_id, ts, "
    + ", ".join(
        f"tidy3(CASE WHEN row_number() OVER (PARTITION BY item_id, CAST(ts AS DATE) ORDER BY ts) <= 12 THEN {x} END) AS {c}"
        if c == "wind_direction"
        else f"tidy3({x}) AS {c}"
        for c, x in WEATHER_CELLS.items()
    )
    + " FROM grid",
)
def time_axis(t: Tables):
    return _variables(weather.read_weather(t.spark, landed_weather(t, "s13", drop_last=True)))


def written_prices(t: Tables, label: str) -> str:
    """Yearly price files in the `;` dialect with decimal commas and some bad rows."""
    folder = t.scratch(label)
    text = F.replace(F.format_number("price", 4), F.lit(","), F.lit(""))
    comma = F.replace(text, F.lit("."), F.lit(","))
    bad = F.dayofmonth("ts") == 31
    rows = t.daily.select(
        F.year("ts").alias("y"),
        F.when(bad, F.lit("31-02-2000 10:00")).otherwise(F.date_format("ts", "dd-MM-yyyy HH:mm")).alias("datum"),
        F.when(F.dayofmonth("ts") == 30, F.lit("n/a")).otherwise(comma).alias("prijs_excl"),
        F.lit("x").alias("opmerking"),
    )
    stem = F.concat(F.lit("dynamische_stroomprijzen_jaar_"), "y", F.lit(".csv"))
    one_a_year = rows.withColumn("file", stem).drop("y").repartition("file")
    one_a_year.write.option("header", True).option("sep", ";").partitionBy("file").csv(folder)
    return folder


PRICE_FILE_SQL = (
    with_views("daily")
    + """, p AS (SELECT ts, CASE WHEN day(ts) <> 30 THEN round(price, 4) END AS p FROM daily WHERE day(ts) <> 31)
    SELECT ts, tidy3(coalesce(p, (SELECT avg(p) FROM p))) AS elec_price FROM p"""
)


@query("s14_electricity_price_files", PRICE_FILE_SQL)
def electricity_files(t: Tables):
    return tidied(prices.read_electricity(t.spark, written_prices(t, "s14")), 3)


@query(
    "s15_gas_price_file",
    with_views("gas_daily") + "SELECT ts, tidy3(round(gas_price, 4)) AS gas_price FROM gas_daily",
)
def gas_file(t: Tables):
    folder = t.scratch("s15")
    rows = t.gas_daily.select(
        F.date_format("ts", "dd-MM-yyyy HH:mm").alias("datum"),
        F.replace(F.round("gas_price", 4).cast("string"), F.lit("."), F.lit(",")).alias("prijs"),
    )
    rows.unionByName(rows).write.option("header", True).option("sep", ";").csv(f"{folder}/dynamische_gasprijzen_alltime.csv")
    return tidied(prices.read_gas(t.spark, folder), 3)


FEATURE_SQL = (
    with_views("wide", "gas_daily", more=UPSAMPLED + ", " + MERGED)
    + "SELECT ts, tidy(elec_price) AS elec_price, tidy(gas_price) AS gas_price, "
    + ", ".join(f"tidy({e}) AS {n}" for n, e in PRICE_SQL if n in features.PRICE_COLUMNS)
    + f", CAST({JANUARY_FLAG} AS DOUBLE) AS energy_crisis, {JANUARY_PHASE} AS crisis_phase FROM prices"
)
FEATURE_COLUMNS = ["elec_price", "gas_price", "gas_to_elec_ratio", "elec_price_diff_1d", "elec_price_diff_1w"]


def _price_features(t: Tables):
    out = features.prepare_prices(t.wide, t.gas_daily, JANUARY)
    return tidied(out.select("ts", *FEATURE_COLUMNS, F.col("energy_crisis").cast("double").alias("energy_crisis"), "crisis_phase"))


@query("s16_price_features_parquet", FEATURE_SQL)
def price_features_parquet(t: Tables):
    path = sinks.write_table(_price_features(t), f"{t.scratch('s16')}.parquet")
    return files.read_price_features(t.spark, path)


@query("s17_price_features_csv", FEATURE_SQL)
def price_features_csv(t: Tables):
    path = t.scratch("s17")
    sinks.write_table(_price_features(t).withColumnRenamed("ts", "datetime"), path, "csv")
    return files.read_price_features(t.spark, path)


def written_history(t: Tables, label: str) -> str:
    """Three dated combined histories; the latest date holds half the values."""
    folder = t.scratch(label)
    for stamp, factor in (("20240115", 1.0), ("20240131", 0.5), ("2024-01-20", 3.0)):
        rows = history(t).withColumn("emissionfactor", F.col("emissionfactor") * factor)
        sinks.write_history(rows, f"{folder}/historical_combined_{stamp}.csv")
    return f"{folder}/historical_combined_*.csv"


@query(
    "s18_latest_file_by_name",
    with_views("wide") + "SELECT ts, tidy(emissionfactor) * 0.5 AS emissionfactor FROM wide",
)
def latest_by_name(t: Tables):
    raw = files.read_newest(t.spark, written_history(t, "s18"), "name")
    return raw.select(
        parse_timestamp(F.col("time")).alias("ts"), F.col("emissionfactor").cast("double").alias("emissionfactor")
    )


@query(
    "s19_latest_file_by_time",
    with_views("wide") + "SELECT ts, tidy(emissionfactor) * 3 AS emissionfactor FROM wide",
)
def latest_by_time(t: Tables):
    raw = files.read_newest(t.spark, written_history(t, "s19"), "time")
    return raw.select(
        parse_timestamp(F.col("time")).alias("ts"), F.col("emissionfactor").cast("double").alias("emissionfactor")
    )


@query(
    "o6_newest_files_first",
    """SELECT 'historical_combined_' || strftime(day, '%Y%m%d') || '.csv' AS name, row_number() OVER (ORDER BY day DESC) AS place
    FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)""",
)
def newest_files_first(t: Tables):
    """One dated file per day of the events, listed from the newest date in a name."""
    folder = t.scratch("o6")
    stamp = F.concat(F.lit("historical_combined_"), F.date_format("ts", "yyyyMMdd"), F.lit(".csv")).alias("file")
    t.events.groupBy(stamp).count().write.partitionBy("file").option("header", True).csv(folder)
    found = files.listing(t.spark, f"{folder}/file=*").select(F.regexp_replace("name", "^file=", "").alias("name"))
    order = Window.orderBy(files.name_date(F.col("name")).desc(), F.desc("name"))  # names alone, one row a file
    return found.withColumn("place", F.row_number().over(order).cast("bigint"))


@query(
    "s20_emission_files",
    with_views("wide")
    + """SELECT ts, tidy(elec_price) AS total_volume, tidy(tidy(emissionfactor) * 0.5) AS emission_factor, tidy(temperature) AS volume_sun,
    tidy(humidity) AS volume_land_wind, tidy(gas_price) AS volume_sea_wind FROM wide""",
)
def emission_files(t: Tables):
    return tidied(files.read_emissions(t.spark, written_history(t, "s20")))


@query(
    "s21_correlation_inputs",
    with_views("wide")
    + f"SELECT ts, {HISTORY_SQL}, tidy(temperature / 10) AS temperature_celsius FROM wide WHERE temperature IS NOT NULL",
)
def correlation_inputs(t: Tables):
    folder = t.scratch("s21")
    sinks.write_history(history(t), f"{folder}/history.csv")
    celsius = t.wide.filter("temperature IS NOT NULL").select(
        F.col("ts").alias("datetime"), tidy(F.col("temperature") / 10).alias("temperature_celsius")
    )
    sinks.write_table(celsius, f"{folder}/temperatures.csv", "csv")
    return files.read_correlation_inputs(t.spark, f"{folder}/history.csv", f"{folder}/temperatures.csv")


@query(
    "s22_forecast_and_prediction_files",
    with_views("wide", "grid")
    + """SELECT w.ts, tidy(temperature) AS volume_sun, '0' AS item_id, tidy(g.y) AS mean, tidy(g.y) - 1 AS q10, tidy(g.y) + 1 AS q90
    FROM wide w JOIN grid g ON g.ts = w.ts AND g.item_id = 'signup'""",
)
def forecast_pair(t: Tables):
    folder = t.scratch("s22")
    forecast = history(t).select("ts", "volume_sun")
    sinks.write_table(sinks.outside(forecast), f"{folder}/forecast_20240131.csv", "csv")
    y = tidy(F.col("y"))
    prediction = t.grid().filter("item_id = 'signup'").select(
        F.lit("0").alias("item_id"),
        F.col("ts").alias("timestamp"),
        y.alias("mean"),
        (y - 1).alias("0.1"),
        (y + 1).alias("0.9"),
    )
    sinks.write_table(prediction, f"{folder}/prediction_2024-01-31_1200.csv", "csv")
    return files.read_forecast_pair(t.spark, f"{folder}/forecast_*.csv", f"{folder}/prediction_*.csv")


@query(
    "s23_tolerant_timestamps",
    with_views("daily") + "SELECT ts, count(*) AS n FROM daily WHERE day(ts) <> 31 GROUP BY 1",
)
def tolerant_timestamps(t: Tables):
    raw = t.spark.read.option("header", True).option("sep", ";").csv(
        f"{written_prices(t, 's23')}/{prices.ELECTRICITY_GLOB}"
    )
    return prices.parse_prices(raw, "price").groupBy("ts").agg(F.count("*").alias("n"))


@query(
    "s24_decimal_dialects",
    "SELECT o_orderkey, o_totalprice AS price FROM orders",
)
def decimal_dialects(t: Tables):
    text = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    mixed = F.when(F.col("o_orderstatus") == "F", F.replace(text, F.lit("."), F.lit(","))).otherwise(text)
    return t.read("orders").select("o_orderkey", decimal_comma(mixed).alias("price"))


@query(
    "s25_lookback",
    with_views("series", more="ends AS (SELECT item_id, max(ts) AS hi FROM series GROUP BY 1)")
    + "SELECT item_id, ts, n FROM series JOIN ends USING (item_id) WHERE ts >= hi - INTERVAL 10 DAY",
)
def lookback(t: Tables):
    return utilisation.lookback(t.series, 10).select("item_id", "ts", "n")


@query("k1_history_csv", with_views("wide") + f"SELECT ts, {HISTORY_SQL} FROM wide")
def history_csv(t: Tables):
    return files.read_series(t.spark, sinks.write_history(history(t), t.scratch("k1")))


@query(
    "k2_split_by_source",
    with_views("wide")
    + " UNION ALL ".join(
        f"SELECT ts, '{s}' AS source, tidy({c}) AS volume FROM wide WHERE {c} IS NOT NULL"
        for s, c in (("sun", "temperature"), ("land_wind", "humidity"), ("sea_wind", "gas_price"))
    ),
)
def split_by_source(t: Tables):
    path = t.scratch("k2")
    sinks.write_table(sinks.long_sources(history(t).select("ts", *VOLUMES)), path, partition_by=["source"])
    return t.spark.read.parquet(path).select("ts", "source", "volume")


@query(
    "k3_dated_snapshots",
    with_views("wide")
    + """SELECT ts, tidy(temperature) AS volume_sun, DATE '2024-01-30' AS snapshot_date FROM wide
    UNION ALL SELECT ts, tidy(temperature), DATE '2024-01-31' FROM wide WHERE ts >= TIMESTAMP '2024-01-10'""",
)
def dated_snapshots(t: Tables):
    path = t.scratch("k3")
    rows = history(t).select("ts", "volume_sun")
    sinks.write_snapshot(rows, path, "2024-01-30")
    sinks.write_snapshot(rows, path, "2024-01-31")
    sinks.write_snapshot(rows.filter(F.col("ts") >= F.lit("2024-01-10").cast("timestamp")), path, "2024-01-31")
    return t.spark.read.parquet(path).select("ts", "volume_sun", "snapshot_date")


@query(
    "k4_prediction_snapshots",
    with_views("grid") + "SELECT item_id, ts, tidy(y) AS mean, '2024-01-31_1200' AS run_ts FROM grid",
)
def prediction_snapshots(t: Tables):
    path = t.scratch("k4")
    rows = t.grid().select("item_id", "ts", tidy(F.col("y")).alias("mean"))
    sinks.write_predictions(rows, path, "2024-01-31_1200")
    return t.spark.read.parquet(path).select("item_id", "ts", "mean", F.col("run_ts").cast("string").alias("run_ts"))


@query(
    "k5_weather_csv",
    with_views("wide") + "SELECT ts, tidy(temperature) AS temperature, tidy(humidity) AS humidity FROM wide",
)
def weather_csv(t: Tables):
    rows = t.wide.select(F.col("ts").alias("datetime"), *[tidy(F.col(c)).alias(c) for c in ("temperature", "humidity")])
    return files.read_series(t.spark, sinks.write_table(rows, t.scratch("k5"), "csv", sort_by=["datetime"]))


@query(
    "k6_price_feature_table",
    with_views("wide", "gas_daily", more=UPSAMPLED + ", " + MERGED)
    + f"""SELECT {JANUARY_PHASE} AS crisis_phase, count(*) AS n, tidy(avg(elec_price)) AS elec_price FROM prices GROUP BY 1""",
)
def price_feature_table(t: Tables):
    path = sinks.write_table(features.prepare_prices(t.wide, t.gas_daily, JANUARY), t.scratch("k6"), partition_by=["crisis_phase"])
    stored = t.spark.read.parquet(path)
    return tidied(stored.groupBy("crisis_phase").agg(F.count("*").alias("n"), F.avg("elec_price").alias("elec_price")))


@query("k7_error_csv", with_views("err") + "SELECT item_id, ts, tidy(error) AS error FROM err")
def error_csv(t: Tables):
    rows = t.errors(False).select("item_id", "ts", tidy(F.col("error")).alias("error"))
    return files.read_series(t.spark, sinks.write_table(rows, t.scratch("k7"), "csv"), ("item_id",)).select(
        "item_id", "ts", "error"
    )


@query(
    "k8_calendar_tables",
    "WITH "
    + HOLIDAY_SQL
    + ", daily AS (SELECT o_orderdate AS ts FROM orders), "
    + PERIOD_SQL
    + """ SELECT 'holiday' AS kind, date AS start_date, name AS label FROM all_holidays
      WHERE year IN (SELECT DISTINCT year(ts) FROM daily)
    UNION ALL SELECT 'vacation', start_date, type || ' ' || region FROM periods""",
)
def calendar_tables(t: Tables):
    days = calendar.holidays(calendar.years_of(t.daily)).select(
        F.lit("holiday").alias("kind"), F.col("date").alias("start_date"), F.col("name").alias("label")
    )
    periods = yearly_periods(t).select(
        F.lit("vacation").alias("kind"), "start_date", F.concat_ws(" ", "type", "region").alias("label")
    )
    path = sinks.write_table(days.unionByName(periods), t.scratch("k8"), "csv", sort_by=["start_date", "label"])
    return t.spark.read.option("header", True).schema("kind STRING, start_date DATE, label STRING").csv(path)


@query("k9_feature_importance")
def feature_importance(t: Tables):
    rows = model.direct_features(t.grid(), "y").dropna()
    columns = [c for c in rows.columns if c.startswith("y_")]
    fitted = model.fit(rows, "y", columns, "linear")
    table = model.permutation_importance(fitted, rows, "y", columns, ["item_id", "ts"])
    path = sinks.write_table(table, t.scratch("k9"), "csv", sort_by=["importance"])
    return t.spark.read.option("header", True).schema("feature STRING, importance DOUBLE").csv(path)
