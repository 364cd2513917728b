"""Quality rules: exact counts of a text, and a calibrated classifier with fixed thresholds."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronogrid.llm.grams import WIDTH, Grams, balanced_sample, dense, fit_linear, share_udf
from chronogrid.llm.kernels import prepare, text_rows

PER_CLASS = 1000  # training documents of each class, at most about this many
KEEP_FROM = 0.5  # calibrated probability of good quality that keeps a document
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of words inside repeated windows
WINDOW = 5

BLANK = bytes([9, 10, 11, 12, 13, 32])
SYMBOLS = re.compile(rb"[#*$%&|<>]")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of `window` words found twice or more in the text.

    Windows get exact numbers by joining halves: pairs, pairs of pairs, then the rest
    word by word. Ends early once nothing repeats.
    """
    n = len(words)
    if n <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    if len(number) == n:
        return 0
    code, width, kinds = ids, 1, len(number)
    while width < window:
        reach = width if 2 * width <= window else window - width
        tail, tail_kinds = (code, kinds) if reach == width else (ids, len(number))
        if reach not in (1, width):
            reach, tail, tail_kinds = 1, ids, len(number)
        m = n - width - reach + 1
        joined = code[:m] * tail_kinds + tail[width : width + m]
        found, code = np.unique(joined, return_inverse=True)
        kinds, width = len(found), width + reach
        if kinds == m:
            return 0
    twice = np.bincount(code)[code] > 1
    edge = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of UTF-8 bytes."""
    words = text.split()
    solid = text.translate(None, BLANK)
    chars = len(solid.decode())
    lines = [line for line in text.split(b"\n") if line.translate(None, BLANK)] if b"\n" in text else []
    return len(words), chars, len(SYMBOLS.findall(text)), len(lines) - len(set(lines)), repeated_words(words)


@dataclass
class Judge:
    """Weights over n-gram shares, and the line from raw score to log-odds."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def chance(self, texts: list[bytes]) -> np.ndarray:
        raw = Grams.of(texts).scores(self.weights[:, None], np.array([self.bias]))[:, 0]
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -30, 30)))


def calibrate(raw: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of Platt's line by Newton steps on the weighted logistic loss."""
    a, b = 1.0, 0.0
    x = np.stack([raw, np.ones_like(raw)], axis=1)
    good, bad = max(1, (y > 0).sum()), max(1, (y <= 0).sum())
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
        grad = x.T @ (weight * (p - target))
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-7:
            break
    return float(max(a, 1e-3)), float(b)


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> Judge:
    """Logistic regression on labelled documents, calibrated on a fifth of them.

    A document with several labels counts as its largest. The sample is bounded by
    PER_CLASS; only its hashed n-gram shares reach the driver. Without rows of both
    classes every document gets probability one half or more.
    """
    prepare(docs.sparkSession)
    marks = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    marks = marks.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("kind"))
    sample, counts = balanced_sample(marks, "kind", "id", 2 * PER_CLASS, 2, "quality")
    none = Judge(np.zeros(WIDTH), 1.0, 1.0, 0.0)
    if not counts.get(0) or not counts.get(1):
        return none
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    chosen = texts.join(F.broadcast(sample), "id").dropDuplicates(["id"]).orderBy("id")  # at most 4 * PER_CLASS ids
    got = chosen.select("kind", share_udf(str.encode)(F.col("text")).alias("made")).toArrow()
    y = np.where(got.column("kind").to_numpy() > 0, 1.0, -1.0)
    if len(set(y.tolist())) < 2:
        return none
    x = dense(got.column("made"))
    del got
    held = np.arange(len(y)) % 5 == 0
    kept, x = x[held], x[~held]
    weights, bias = fit_linear(x, y[~held], squared_hinge=False, steps=200)
    share = np.where(y > 0, counts[1] / max(1, (y > 0).sum()), counts[0] / max(1, (y < 0).sum()))
    slope, shift = calibrate(kept @ weights + bias, y[held], share[held] / share[held].mean())
    return Judge(weights, bias, slope, shift)


SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, quality double, kept boolean"
)


def judge(
    docs: DataFrame, model: Judge, keep_from: float = KEEP_FROM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Counts, calibrated quality and verdict of whole texts, one row per input row.

    A document fails the base rules with fewer than LEAST_WORDS words or over
    MOST_REPEATED per cent repeated words; it is kept if it does not and its quality is
    at least `keep_from`. A NULL or empty text has no words and fails; repeated rows
    stay; other columns are ignored whatever their names.
    """
    spark = prepare(docs.sparkSession)
    parts = spark.sparkContext.broadcast(vars(model))

    def kernel(texts: list[str]) -> dict:
        raw = [text.encode() for text in texts]
        counts = np.array([base_counts(text) for text in raw], np.int64).reshape(-1, 5)
        failed = (counts[:, 0] < LEAST_WORDS) | (100 * counts[:, 4] > MOST_REPEATED * counts[:, 0])
        chance = Judge(**parts.value).chance(raw)
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        return dict(zip(names, counts.T, strict=True)) | {
            "base_failed": failed,
            "quality": chance,
            "kept": ~failed & (chance >= keep_from),
        }

    return text_rows(docs, kernel, SCHEMA, id_col, text_col)
