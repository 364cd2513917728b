"""Reader for landed weather payloads: parallel arrays over a regular time axis."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronogrid.operators import align, grid, impute

# Payload variable to column name.
VARIABLES = {
    "temperature_2m": "temperature",
    "relative_humidity_2m": "humidity",
    "dew_point_2m": "dew_point",
    "apparent_temperature": "feels_like",
    "precipitation": "precipitation",
    "rain": "rain",
    "snowfall": "snowfall",
    "pressure_msl": "pressure_msl",
    "surface_pressure": "surface_pressure",
    "cloud_cover": "cloud_cover",
    "et0_fao_evapotranspiration": "evapotranspiration",
    "wind_speed_10m": "wind_speed",
    "wind_direction_10m": "wind_direction",
    "uv_index": "uv_index",
    "uv_index_clear_sky": "uv_index_clear",
    "is_day": "is_day",
    "sunshine_duration": "sunshine_duration",
    "shortwave_radiation": "solar_radiation",
    "direct_radiation": "direct_radiation",
    "diffuse_radiation": "diffuse_radiation",
    "direct_normal_irradiance": "direct_normal_irradiance",
    "global_tilted_irradiance": "global_irradiance",
    "terrestrial_radiation": "terrestrial_radiation",
}
PAYLOAD_SCHEMA = (
    "item_id STRING, time_start BIGINT, time_end BIGINT, interval INT, "
    + ", ".join(f"{name} ARRAY<FLOAT>" for name in VARIABLES)
)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed payloads, one JSON object per line."""
    return spark.read.schema(PAYLOAD_SCHEMA).json(path)


def payload_rows(payloads: DataFrame) -> DataFrame:
    """One row per time step: item_id, ts (UTC) and the renamed variables.

    The time axis runs from time_start up to, not including, time_end. A variable
    that is absent, or has too few values, is NULL in the remaining steps.
    """
    axis = F.sequence(
        F.col("time_start"), F.col("time_end") - F.col("interval"), F.col("interval").cast("bigint")
    )
    present = [name for name in VARIABLES if name in payloads.columns]
    none = F.array().cast("array<float>")
    zipped = F.arrays_zip(
        axis.alias("t"), *[F.coalesce(F.col(name), none).alias(name) for name in present]
    )
    rows = payloads.filter(F.col("time_end") > F.col("time_start")).select(
        "item_id", F.explode(zipped).alias("z")
    )
    return rows.select(
        "item_id",
        F.timestamp_seconds("z.t").alias("ts"),
        *[F.col(f"z.{name}").cast("double").alias(VARIABLES[name]) for name in present],
    )


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Weather history or forecast; both share one payload form."""
    return payload_rows(read_payloads(spark, path))


def combine(
    history: DataFrame,
    forecast: DataFrame,
    only_if_gaps: bool = False,
    circular_direction: bool = False,
) -> DataFrame:
    """History before forecast, one row per hour, gaps filled.

    With `only_if_gaps`, missing values are filled only in series that lack whole
    hours.
    """
    merged = align.union_with_priority([history, forecast], ["item_id", "ts"])
    values = [c for c in merged.columns if c not in ("item_id", "ts")]
    full = grid.hourly_grid(merged, values, keep_chunk=True)
    directions = [c for c in values if c == "wind_direction"]
    filled = impute.impute(full, [c for c in values if c not in directions], directions, circular_direction)
    if not only_if_gaps:
        return filled
    span = F.unix_seconds(F.max("ts")) - F.unix_seconds(F.min("ts"))
    gaps = merged.groupBy("item_id").agg(
        (span / F.lit(3600) + 1 > F.count("*")).alias("_gaps")
    )
    touched = filled.join(gaps.filter("_gaps"), "item_id").drop("_gaps")
    whole = merged.join(gaps.filter("NOT _gaps"), "item_id").drop("_gaps")
    return touched.unionByName(whole)


def ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    """Minimum, maximum, number of values and of NULLs per column in one pass."""
    one = df.agg(
        *[F.min(c).alias(f"{c}__lo") for c in columns],
        *[F.max(c).alias(f"{c}__hi") for c in columns],
        *[F.count(c).alias(f"{c}__n") for c in columns],
        *[F.count_if(F.col(c).isNull()).alias(f"{c}__nulls") for c in columns],
    )
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"{c}__lo").cast("double").alias("min"),
            F.col(f"{c}__hi").cast("double").alias("max"),
            F.col(f"{c}__n").alias("n"),
            F.col(f"{c}__nulls").alias("n_null"),
        )
        for c in columns
    ]
    return one.select(F.explode(F.array(*cells)).alias("r")).select("r.*")
