"""Plan-time checks and look-ups on column names. No data is read here."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Names a time column may carry, in order of preference.
TIME_NAMES = ("timestamp", "validfrom (UTC)", "time", "date", "index")
TIME_WORDS = ("date", "time", "timestamp")

# Name fragments that place a column in a feature family.
FEATURE_FAMILIES = {
    "renewable": ("volume_sun", "volume_land_wind", "volume_sea_wind"),
    "temporal": ("hour", "dayofweek", "month", "weekend", "_sin", "_cos"),
    "wind": ("wind",),
    "temperature": ("temperature",),
    "solar": ("solar", "radiation", "irradiance"),
    "cloud": ("cloud",),
    "humidity": ("humidity",),
    "precipitation": ("precipitation", "rain", "snowfall"),
    "pressure": ("pressure",),
    "other_weather": ("dew_point", "feels_like", "evapotranspiration", "uv_index", "sunshine"),
    "calendar": ("holiday", "vacation"),
    "lag": ("lag",),
    "rolling_mean": ("rolling_mean",),
}


def find_column(columns: Iterable[str], *words: str) -> str:
    """First column whose lower-cased name holds one of the words."""
    names = list(columns)
    for name in names:
        if any(word in name.lower() for word in words):
            return name
    raise ValueError(f"no column matching {words} among {names}")


def normalise_time(df: DataFrame, to: str = "ts") -> DataFrame:
    """Rename the time column: a known name, else the first datetime column."""
    if to in df.columns:
        return df
    for name in TIME_NAMES:
        if name in df.columns:
            return df.withColumnRenamed(name, to)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return df.withColumnRenamed(field.name, to)
    raise ValueError(f"no suitable time column among {df.columns}")


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fail at plan time when a column is missing."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def forbid_derived(df: DataFrame, target: str) -> DataFrame:
    """Fail at plan time when a column derived from the target is present."""
    leaks = [name for name in df.columns if target in name]
    if leaks:
        raise ValueError(f"columns derived from {target}: {leaks}")
    return df


def column_difference(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns of the left frame the right frame lacks, in order."""
    return [name for name in left.columns if name not in set(right.columns)]


def family_counts(spark: SparkSession, columns: Iterable[str]) -> DataFrame:
    """How many columns fall into each feature family, as (family, n)."""
    names = list(columns)
    rows = [
        (family, sum(any(word in name for word in words) for name in names))
        for family, words in FEATURE_FAMILIES.items()
    ]
    return spark.createDataFrame(rows, "family string, n bigint")
