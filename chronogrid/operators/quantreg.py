"""Linear quantile regression: all levels fitted together, one pass over the rows a step."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronogrid.functions.schema import require_columns
from chronogrid.operators import selection
from chronogrid.operators.model import QUANTILES, quantile_names
from chronogrid.session import materialise

PASSES = 60  # most reweighting steps
TOLERANCE = 1e-6  # a step that lowers the loss by a smaller share than this is the last one
SMOOTHING = 1e-4  # residuals below this many deviations of the target weigh alike
BLOCK_ROWS = 4096  # rows multiplied together


@dataclass(frozen=True)
class QuantileModel:
    """One line per level over standardised features; see `fit`."""

    levels: list[float]
    features: list[str]
    centre: list[float]
    spread: list[float]
    intercepts: list[float]
    slopes: list[list[float]]
    passes: int


def _number(name: str) -> Column:
    """The column as a finite double, else NULL."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def _sums(rows: DataFrame, betas: np.ndarray | None, levels: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Weighted normal equations and pinball loss of every level, from one pass.

    Without `betas` all rows weigh alike. Tasks send one row per level and cell of the
    equations, so what reaches the driver depends on levels and features alone.
    """
    width = len(rows.columns)  # an intercept in place of the target, then the features
    size = width * (width + 1) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(levels), size))
        for batch in batches:
            data = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            for begin in range(0, len(data), BLOCK_ROWS):
                block = data[begin : begin + BLOCK_ROWS]
                x, y = block.copy(), block[:, 0]
                x[:, 0] = 1.0
                for i, level in enumerate(levels):
                    weight, pull, loss = np.ones(len(y)), 0.0, 0.0
                    if betas is not None:
                        left = y - x @ betas[i]
                        weight, pull = 1 / (SMOOTHING + np.abs(left)), 2 * level - 1
                        loss = np.maximum(left * level, left * (level - 1)).sum()
                    heavy = x * weight[:, None]
                    total[i] += np.concatenate([(heavy.T @ x).ravel(), heavy.T @ y + pull * x.sum(axis=0), [loss]])
        place = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(place[0].ravel()), pa.array(place[1].ravel()), pa.array(total.ravel())], ["level", "cell", "v"]
        )

    cells = rows.mapInArrow(run, "level long, cell long, v double").groupBy("level", "cell").agg(F.sum("v").alias("v"))
    found = np.zeros((len(levels), size))
    for level, cell, v in cells.collect():
        found[level, cell] = v
    return found[:, :-1].reshape(len(levels), width + 1, width), found[:, -1]


def fit(
    df: DataFrame,
    target: str,
    features: list[str],
    levels: list[float] = QUANTILES,
    passes: int = PASSES,
    tolerance: float = TOLERANCE,
) -> QuantileModel:
    """Lines with the smallest pinball loss at each level.

    Each step replaces the loss by a parabola that touches it at the present residuals and
    lies above it elsewhere; its minimum is a weighted least-squares fit, so the loss falls
    with every step. The last pass moves each line to the exact quantile of its residuals,
    which the best line has at zero. Rows with an unknown target take no part; an unknown
    feature counts as its mean. Features that depend on others share their weight. A table
    without a known target is refused.
    """
    require_columns(df, [target, *features])
    plain = df.select(*(_number(c).alias(f"c{i}") for i, c in enumerate([target, *features]))).where("c0 IS NOT NULL")
    names = plain.columns
    sizes = plain.agg(*(F.avg(c).alias(f"m_{c}") for c in names), *(F.stddev_pop(c).alias(f"s_{c}") for c in names)).first()
    if sizes["m_c0"] is None:
        raise ValueError(f"no row has a known {target}")
    centre = [sizes[f"m_{c}"] or 0.0 for c in names]
    spread = [sizes[f"s_{c}"] or 1.0 for c in names]
    scaled = plain.select(*(F.coalesce((F.col(c) - m) / s, F.lit(0.0)).alias(c) for c, m, s in zip(names, centre, spread)))
    rows = materialise(scaled, "quantile-rows")
    betas, before, best = None, None, None
    for step in range(passes + 1):
        equations, loss = _sums(rows, betas, levels)
        if step:
            # A level's line is kept only while its loss falls, so rounding cannot undo a fit.
            best = betas if before is None else np.where((loss <= before)[:, None], betas, best)
            lower = loss if before is None else np.minimum(loss, before)
            if before is not None and np.all(before - lower <= tolerance * np.maximum(before, 1e-300)):
                break
            before = lower
        betas = np.stack([np.linalg.lstsq(e[:-1], e[-1], rcond=1e-12)[0] for e in equations])
    fitted = best if best is not None else betas
    lines = [sum((F.col(c) * float(b) for c, b in zip(names[1:], beta[1:])), F.lit(0.0)) for beta in fitted]
    left = [F.struct(F.lit(float(q)).alias("level"), (F.col("c0") - line).alias("v")) for q, line in zip(levels, lines)]
    long = rows.select(F.inline(F.array(*left)))
    rank = F.greatest(F.lit(0), F.ceil(F.col("level") * F.col("n") - 1e-9) - 1).cast("long")
    wanted = F.array(F.struct(F.lit(0).alias("name"), rank.alias("rank")))
    picked = selection.select_ranks(long, ["level"], wanted, few_groups=True)
    exact = {r["level"]: r["v"] for r in picked.collect()}
    return QuantileModel(
        list(levels),
        list(features),
        centre[1:],
        spread[1:],
        [centre[0] + spread[0] * exact[float(q)] for q in levels],
        [[float(b) * spread[0] for b in beta[1:]] for beta in fitted],
        step,
    )


def predict(model: QuantileModel, df: DataFrame) -> DataFrame:
    """Add one column per level (q10, q20, ...), never crossing.

    Lines of different levels may cross far from the rows they were fitted on; there the
    levels' values are sorted in the row, which never raises the loss. Columns of these
    names that `df` has are replaced.
    """
    require_columns(df, model.features)
    scaled = [
        F.coalesce((_number(c) - m) / s, F.lit(0.0)) for c, m, s in zip(model.features, model.centre, model.spread)
    ]
    values = [
        sum((x * b for x, b in zip(scaled, slopes)), F.lit(start))
        for start, slopes in zip(model.intercepts, model.slopes)
    ]
    by_level = sorted(zip(model.levels, quantile_names(model.levels)))
    names = [name for _, name in by_level]
    ordered = F.array_sort(F.array(*values))
    kept = [c for c in df.columns if c not in names]
    made = df.select(*kept, ordered.alias("__levels"))
    return made.select(*kept, *(F.col("__levels")[i].alias(n) for i, n in enumerate(names)))
