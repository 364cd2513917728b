"""Feature sets and the registry that applies them in a fixed order."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from chronogrid import session
from chronogrid.functions import numbers, timeparts
from chronogrid.functions.schema import require_columns
from chronogrid.operators import align, calendar, chunks, grid, ordered

# Lags and windows, in hours, of each feature set.
TARGET_LAGS = [1, 2, 3, 24, 48, 168]
TARGET_WINDOWS = [24, 168]
TEMPERATURE_LAGS = [1, 8, 9, 10, 20, 21, 22, 23, 24]
WEATHER_WINDOWS = [24, 168]
ELECTRICITY_LAGS = [1, 3, 6, 12, 24, 48, 168]
ELECTRICITY_WINDOWS = [24, 48, 168, 336]
GAS_LAGS = [24, 48, 168]
GAS_WINDOWS = [168, 336]

# Weather variables besides temperature; is_day gets no derived columns.
WEATHER_VARIABLES = [
    "humidity", "dew_point", "feels_like", "precipitation", "rain", "snowfall",
    "pressure_msl", "surface_pressure", "cloud_cover", "evapotranspiration",
    "wind_speed", "wind_direction", "uv_index", "uv_index_clear", "is_day",
    "sunshine_duration", "solar_radiation", "direct_radiation", "diffuse_radiation",
    "direct_normal_irradiance", "global_irradiance", "terrestrial_radiation",
]

# Phases of the price crisis and their first days.
FIRST_PHASE = "pre_crisis"
CRISIS_CUTS = [
    (date(2021, 10, 1), "early_crisis"),
    (date(2022, 2, 24), "acute_crisis"),
    (date(2022, 9, 1), "peak_crisis"),
    (date(2023, 1, 1), "stabilization"),
]
CRISIS_START = date(2021, 10, 1)

# Price columns that are known ahead.
PRICE_COLUMNS = [
    "elec_price", "gas_price", "gas_to_elec_ratio", "elec_price_diff_1d", "elec_price_diff_1w",
    "energy_crisis", "phase_pre_crisis", "phase_early_crisis", "phase_acute_crisis",
    "phase_peak_crisis", "phase_stabilization",
]
TEMPORAL = ["hour", "dayofweek", "month", "is_weekend"]


@dataclass(frozen=True)
class Regime:
    """Crisis flag bounds and phase cut-offs."""

    start: date = CRISIS_START
    end: date | None = None
    first: str = FIRST_PHASE
    cuts: list[tuple[date, str]] = field(default_factory=lambda: list(CRISIS_CUTS))

    @property
    def phases(self) -> list[str]:
        return [self.first, *[name for _, name in sorted(self.cuts)]]


def temporal(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Hour, weekday, month and weekend flag."""
    parts = timeparts.calendar_parts(F.col(ts))
    return df.withColumns({name: parts[name] for name in TEMPORAL})


def seasonal(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Day of year, week and quarter, and the cyclic encoding of every part."""
    parts = timeparts.calendar_parts(F.col(ts))
    columns: dict[str, Column] = {}
    for name, period in timeparts.CYCLE_PERIODS.items():
        if name not in TEMPORAL:
            columns[name] = parts[name]
        columns[f"{name}_sin"], columns[f"{name}_cos"] = timeparts.cyclic(parts[name], period)
    return df.withColumns(columns)


def target_columns(target: str, w: WindowSpec) -> dict[str, Column]:
    """First difference, lags and rolling means of the target."""
    y = F.col(target)
    columns = {f"{target}_diff": ordered.difference(y, 1, w)}
    columns |= {f"{target}_lag_{k}h": ordered.lag(y, k, w) for k in TARGET_LAGS}
    columns |= {f"{target}_rolling_mean_{n}h": ordered.rolling_mean(target, n) for n in TARGET_WINDOWS}
    return columns


def weather_columns(present: Iterable[str], w: WindowSpec) -> dict[str, Column]:
    """Changes, lags and rolling means of the weather variables that are present."""
    names = set(present)
    columns: dict[str, Column] = {}
    for name in ["temperature", *WEATHER_VARIABLES]:
        if name not in names or name == "is_day":
            continue
        x = F.col(name)
        columns[f"{name}_change_1h"] = ordered.difference(x, 1, w)
        columns[f"{name}_change_24h"] = ordered.difference(x, 24, w)
        if name == "temperature":
            columns |= {f"{name}_lag_{k}h": ordered.lag(x, k, w) for k in TEMPERATURE_LAGS}
        columns |= {f"{name}_rolling_mean_{n}h": ordered.rolling_mean(name, n) for n in WEATHER_WINDOWS}
    return columns


def regime_columns(ts: Column, regime: Regime) -> dict[str, Column]:
    """Crisis flag, phase label and one column per phase."""
    phase = numbers.phase_label(ts, regime.first, regime.cuts)
    return {
        "energy_crisis": numbers.regime_flag(ts, regime.start, regime.end),
        "crisis_phase": phase,
        **numbers.one_hot(phase, regime.phases, "phase"),
    }


def price_columns(w: WindowSpec) -> dict[str, Column]:
    """Lags, rolling statistics, ratio and differences of the two prices."""
    e, g = F.col("elec_price"), F.col("gas_price")
    columns = {f"elec_price_lag_{k}h": ordered.lag(e, k, w) for k in ELECTRICITY_LAGS}
    for n in ELECTRICITY_WINDOWS:
        columns[f"elec_price_roll_mean_{n}h"] = ordered.rolling_mean("elec_price", n)
        columns[f"elec_price_roll_std_{n}h"] = ordered.rolling_std("elec_price", n)
    columns |= {f"gas_price_lag_{k}h": ordered.lag(g, k, w) for k in GAS_LAGS}
    columns |= {f"gas_price_roll_mean_{n}h": ordered.rolling_mean("gas_price", n) for n in GAS_WINDOWS}
    columns["gas_to_elec_ratio"] = numbers.ratio(g, e)
    columns["elec_price_diff_1d"] = ordered.difference(e, 24, w)
    columns["elec_price_diff_1w"] = ordered.difference(e, 168, w)
    return columns


def merge_prices(electricity: DataFrame, gas_daily: DataFrame, item: str = "item_id", ts: str = "ts") -> DataFrame:
    """Hourly electricity price with the daily gas price spread over the hours.

    Full outer by hour, remaining gaps filled forward, then backward.
    """
    gas = grid.hourly_from_daily(gas_daily, ["gas_price"], item, ts)
    both = align.outer_align(
        [electricity.select(item, ts, "elec_price"), gas.select(item, ts, "gas_price")], [item, ts]
    )
    return ordered.fill_both_ways(both, ["elec_price", "gas_price"], item=item, ts=ts)


def prepare_prices(
    electricity: DataFrame,
    gas_daily: DataFrame,
    regime: Regime | None = None,
    leak_safe: bool = True,
    item: str = "item_id",
    ts: str = "ts",
) -> DataFrame:
    """The price feature table.

    With `leak_safe`, the first rows of a lag stay NULL. Without it they are filled
    forward and then backward, which copies later prices to earlier hours; the fill
    reads its input twice, so that is written once.
    """
    regime = regime or Regime()
    merged = merge_prices(electricity, gas_daily, item, ts)
    wide = chunks.windowed(
        merged,
        max(ELECTRICITY_WINDOWS),
        price_columns,
        item,
        ts,
        means={"gas_price": GAS_WINDOWS},
        spread={"elec_price": ELECTRICITY_WINDOWS},
    )
    if not leak_safe:
        wide = session.materialise(wide, "price-features")
        wide = ordered.fill_both_ways(wide, [c for c in wide.columns if c not in (item, ts)], item=item, ts=ts)
    return wide.withColumns(regime_columns(F.col(ts), regime))


def rolling_price_analysis(df: DataFrame, item: str = "item_id", ts: str = "ts") -> DataFrame:
    """Week and month statistics over full windows, and the price ratio."""
    e, g = F.col("elec_price"), F.col("gas_price")

    def build(w: WindowSpec) -> dict[str, Column]:
        return {
            "elec_price_7d_mean": ordered.rolling_mean("elec_price", 168, full=True),
            "elec_price_7d_std": ordered.rolling_std("elec_price", 168, full=True),
            "elec_price_30d_mean": ordered.rolling_mean("elec_price", 720, full=True),
            "gas_price_7d_mean": ordered.rolling_mean("gas_price", 168, full=True),
            "gas_price_30d_mean": ordered.rolling_mean("gas_price", 720, full=True),
            "gas_to_elec_ratio": numbers.ratio(g, e),
        }

    means = {"gas_price": [168, 720]}
    return chunks.windowed(df, 720, build, item, ts, means=means, spread={"elec_price": [168, 720]})


def stationary(
    df: DataFrame,
    columns: list[str],
    item: str = "item_id",
    ts: str = "ts",
    chunk_hours: int = chunks.CHUNK_HOURS,
) -> DataFrame:
    """Differences to the row before, however long ago; rows with an unknown one are dropped."""
    out = chunks.windowed(
        chunks.with_row_halo(df.select(item, ts, *columns), 1, item, ts, chunk_hours),
        1,
        lambda w: {f"d_{c}": ordered.difference(F.col(c), 1, w) for c in columns},
        item,
        ts,
    )
    return out.select(item, ts, *[F.col(f"d_{c}").alias(c) for c in columns]).dropna(subset=columns)


@dataclass(frozen=True)
class FeatureInputs:
    """What the feature sets need besides the series itself."""

    target: str = "emissionfactor"
    vacations: DataFrame | None = None
    prices: DataFrame | None = None
    weather: DataFrame | None = None
    item: str = "item_id"
    ts: str = "ts"


def _holiday(df: DataFrame, use: FeatureInputs) -> DataFrame:
    return calendar.add_holidays(df, use.ts)


def _vacation(df: DataFrame, use: FeatureInputs) -> DataFrame:
    if use.vacations is None:
        raise ValueError("the vacation set needs a table of vacation periods")
    return calendar.add_vacations(df, use.vacations, use.ts)


def _emission(df: DataFrame, use: FeatureInputs) -> DataFrame:
    if use.target not in df.columns:
        return df
    return chunks.windowed(
        df,
        max(TARGET_LAGS),
        lambda w: target_columns(use.target, w),
        use.item,
        use.ts,
        means={use.target: TARGET_WINDOWS},
    )


def _price(df: DataFrame, use: FeatureInputs) -> DataFrame:
    if use.prices is None:
        raise ValueError("the price set needs a price feature table")
    keys = [c for c in (use.item, use.ts) if c in use.prices.columns]
    prices = require_columns(use.prices, PRICE_COLUMNS).select(*keys, *PRICE_COLUMNS)
    joined = df.join(align.assert_unique(prices, keys), keys, "left")
    return ordered.fill_when_probe_missing(joined, PRICE_COLUMNS, "elec_price", use.item, use.ts)


def _weather(df: DataFrame, use: FeatureInputs) -> DataFrame:
    if use.weather is None:
        raise ValueError("the weather set needs a weather table")
    keys = [c for c in (use.item, use.ts) if c in use.weather.columns]
    names = [c for c in ["temperature", *WEATHER_VARIABLES] if c in use.weather.columns]
    joined = df.join(align.assert_unique(use.weather.select(*keys, *names), keys), keys, "left")
    return chunks.windowed(
        joined,
        max(WEATHER_WINDOWS),
        lambda w: weather_columns(names, w),
        use.item,
        use.ts,
        means={n: WEATHER_WINDOWS for n in names if n != "is_day"},
    )


# Feature sets in the order they are applied. A plug-in is a further entry.
REGISTRY: dict[str, Callable[[DataFrame, FeatureInputs], DataFrame]] = {
    "temporal": lambda df, use: temporal(df, use.ts),
    "holiday": _holiday,
    "vacation": _vacation,
    "seasonal": lambda df, use: seasonal(df, use.ts),
    "emission": _emission,
    "price": _price,
    "weather": _weather,
}


def add_features(df: DataFrame, use: FeatureInputs, sets: str | set[str] = "all") -> DataFrame:
    """Apply the chosen feature sets ('all' or a set of registry names) in order."""
    if sets != "all":
        if not isinstance(sets, (set, frozenset)):
            raise ValueError("sets must be 'all' or a set of feature set names")
        unknown = set(sets) - set(REGISTRY)
        if unknown:
            raise ValueError(f"unknown feature sets {sorted(unknown)}; choose from {list(REGISTRY)}")
    for name, apply in REGISTRY.items():
        if sets == "all" or name in sets:
            df = apply(df, use)
    return df
