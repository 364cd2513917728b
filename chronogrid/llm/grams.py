"""Hashed character and word n-grams of texts, and linear models over their shares."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronogrid.llm.kernels import text_udf

BITS = 12  # buckets of one family, as a power of two
CHARS = (3, 4)  # lengths of character n-grams, in bytes

# Every ASCII byte that is no letter becomes a space; other bytes stay as they are.
LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def letters_only(text: str) -> bytes:
    """Lower-cased words of letters, joined by single spaces."""
    return b" ".join(text.lower().encode().translate(LETTERS).split())


def _mix(h: np.ndarray) -> np.ndarray:
    h = h.astype(np.uint32)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return ((h ^ (h >> np.uint32(13))) * np.uint32(0x297A2D39)) >> np.uint32(32 - BITS)


def ragged_sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums over consecutive runs; a run of length zero sums to zero."""
    out = np.zeros(len(lengths))
    full = np.flatnonzero(lengths)
    if len(full):
        out[full] = np.add.reduceat(values, (np.cumsum(lengths) - lengths)[full])
    return out


@dataclass
class Grams:
    """Buckets of all n-grams of a list of byte strings, family by family."""

    buckets: list[np.ndarray]
    lengths: list[np.ndarray]

    @classmethod
    def of(cls, texts: list[bytes]) -> Grams:
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        raw = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint32)
        buckets, lengths = [], []
        for n in CHARS:
            count = np.maximum(size - n + 1, 0)
            start = np.arange(int(count.sum())) + np.repeat((np.cumsum(size) - size) - (np.cumsum(count) - count), count)
            h = np.zeros(len(start), np.uint32)
            for k in range(n):
                h = h * np.uint32(0x01000193) + raw[start + k]
            buckets.append(_mix(h))
            lengths.append(count)
        words = [text.split() for text in texts]
        flat = [w for ws in words for w in ws]
        lengths.append(np.fromiter(map(len, words), np.int64, len(words)))
        buckets.append(word_buckets(flat))
        return cls(buckets, lengths)

    def take(self, rows: np.ndarray) -> Grams:
        """The grams of some of the texts."""
        buckets, lengths = [], []
        for b, n in zip(self.buckets, self.lengths, strict=True):
            own = n[rows]
            begin = (np.cumsum(n) - n)[rows]
            buckets.append(b[np.arange(int(own.sum())) + np.repeat(begin - (np.cumsum(own) - own), own)])
            lengths.append(own)
        return Grams(buckets, lengths)

    def shares(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text the columns that occur, and their shares of the family."""
        out = []
        begins = [np.cumsum(n) - n for n in self.lengths]
        for row in range(len(self.lengths[0])):
            columns, values = [], []
            for family, (b, begin, n) in enumerate(zip(self.buckets, begins, self.lengths, strict=True)):
                if n[row]:
                    found, times = np.unique(b[begin[row] : begin[row] + n[row]], return_counts=True)
                    columns.append(found.astype(np.int32) + (family << BITS))
                    values.append((times / n[row]).astype(np.float32))
            out.append((np.concatenate(columns), np.concatenate(values)) if columns else (np.zeros(0, np.int32), np.zeros(0, np.float32)))
        return out

    def scores(self, weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
        """Linear scores (texts, models) of weights (columns, models) over the shares."""
        out = np.tile(bias, (len(self.lengths[0]), 1)).astype(float)
        for family, (b, n) in enumerate(zip(self.buckets, self.lengths, strict=True)):
            part = weights[family << BITS : (family + 1) << BITS]
            for model in range(part.shape[1]):
                out[:, model] += ragged_sums(part[:, model][b], n) / np.maximum(n, 1)
        return out


def word_buckets(words: list[bytes]) -> np.ndarray:
    """The bucket of each word: a polynomial in its bytes, all words at once."""
    if not words:
        return np.zeros(0, np.uint32)
    length = np.fromiter(map(len, words), np.int64, len(words))
    raw = np.frombuffer(b"".join(words), np.uint8).astype(np.uint32) + np.uint32(1)
    power = np.cumprod(np.full(int(length.max()), 0x01000193, np.uint32), dtype=np.uint32)
    begin = np.cumsum(length) - length
    place = np.arange(len(raw)) - np.repeat(begin, length)
    return _mix(np.add.reduceat(raw * power[place], begin))


WIDTH = (len(CHARS) + 1) << BITS

SEEN_BITS = 20  # buckets of four-byte grams, as a power of two


def seen_grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the four-byte grams of all texts, each between two spaces, and their number by text."""
    padded = [b" %b " % text if text else b"" for text in texts]
    size = np.fromiter(map(len, padded), np.int64, len(padded))
    raw = np.frombuffer(b"".join(padded) + b"   ", np.uint8).astype(np.uint32)
    h = raw[:-3] | raw[1:-2] << np.uint32(8) | raw[2:-1] << np.uint32(16) | raw[3:] << np.uint32(24)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    h = ((h ^ (h >> np.uint32(13))) * np.uint32(0x297A2D39)) >> np.uint32(32 - SEEN_BITS)
    inside = np.ones(len(h), bool)  # grams that end in another text are left out
    ends = np.cumsum(size)
    for back in range(1, 4):
        inside[(ends - back)[size >= back]] = False
    return h[inside].astype(np.int32), np.maximum(size - 3, 0)


def share_udf(clean) -> Column:
    """An Arrow function that returns a text's columns and shares for training."""

    def kernel(texts: list[str]) -> dict:
        pairs = Grams.of([clean(text) for text in texts]).shares()
        return {"columns": [p[0] for p in pairs], "shares": [p[1] for p in pairs]}

    return text_udf(kernel, "columns array<int>, shares array<float>")


def dense(made: pa.ChunkedArray) -> np.ndarray:
    """The rows of `share_udf` as one matrix, filled chunk by chunk without Python objects."""
    out = np.zeros((len(made), WIDTH), np.float32)
    begin = 0
    for chunk in made.chunks:
        columns, shares = chunk.flatten()
        size = np.diff(columns.offsets.to_numpy())
        out[begin + np.repeat(np.arange(len(chunk)), size), columns.flatten().to_numpy()] = shares.flatten().to_numpy()
        begin += len(chunk)
    return out


def fit_linear(x: np.ndarray, y: np.ndarray, squared_hinge: bool, l2: float = 1e-2, steps: int = 120) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear model of classes y = +1 and -1, equally weighted.

    Support vector machine with squared hinge, or logistic regression; accelerated
    gradient descent on standardised columns, whose scales are folded back into the
    weights. `x` is overwritten.
    """
    mean, square = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for begin in range(0, len(x), 64):  # in blocks, so that no second matrix is made
        part = x[begin : begin + 64].astype(float)
        mean += part.sum(axis=0) / len(x)
        square += (part * part).sum(axis=0) / len(x)
    scale = np.sqrt(np.maximum(square - mean * mean, 0))
    scale = np.maximum(scale, 0.2 * np.median(scale[scale > 0]) if (scale > 0).any() else 1.0).astype(np.float32)
    z = x
    z -= mean.astype(np.float32)
    z /= scale * np.float32(np.sqrt(z.shape[1]))
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    curve = np.float32(2.0 if squared_hinge else 0.25)
    v = np.ones(z.shape[1], np.float32)
    for _ in range(12):
        v = z.T @ (weight * (z @ v))
        top = float(np.linalg.norm(v))
        v /= max(top, 1e-12)
    step = 1.0 / (curve * (top * 1.3 + 1.0) + l2)
    w = ahead = np.zeros(z.shape[1], np.float32)
    b = b_ahead = 0.0
    for k in range(steps):
        margin = y * (z @ ahead + b_ahead)
        if squared_hinge:
            slope = -2.0 * y * np.maximum(0, 1 - margin) * weight
        else:
            slope = -y * weight / (1 + np.exp(np.clip(margin, -30, 30)))
        new_w = ahead - step * (z.T @ slope.astype(np.float32) + l2 * ahead)
        new_b = b_ahead - step * float(slope.sum())
        push = k / (k + 3.0)
        ahead, b_ahead = new_w + push * (new_w - w), new_b + push * (new_b - b)
        w, b = new_w, new_b
    w = w / (scale * np.sqrt(z.shape[1]))
    return w.astype(float), float(b - w @ mean)


def hash_share(column: str, salt: str) -> Column:
    """A number in [0, 1) that depends on the value alone."""
    return F.pmod(F.xxhash64(F.lit(salt), F.col(column)), F.lit(1 << 40)) / float(1 << 40)


def balanced_sample(
    rows: DataFrame, kind: str, key: str, size: int, kinds: int | None, salt: str, least: int = 1
) -> tuple[DataFrame, dict]:
    """About `size` rows, as many of each value of `kind`, chosen by the hash of `key`.

    Covers the `kinds` most frequent values, or all if that is None, each by about `least`
    rows if there are so many values that their shares of `size` are smaller. Rows of one
    key count once. Also returns the number of rows of each value. The sample's bound is
    twice the rows asked for.
    """
    found = rows.groupBy(kind).count().orderBy(F.desc("count"), kind)
    found = (found if kinds is None else found.limit(kinds)).collect()
    counts = {r[0]: r["count"] for r in found}
    if not counts:
        return rows.limit(0), counts
    each = max(least, size / len(counts))
    rates = [(F.col(kind) == F.lit(value), F.lit(min(1.0, each / count))) for value, count in counts.items()]
    rate = F.when(*rates[0])
    for pair in rates[1:]:
        rate = rate.when(*pair)
    chosen = rows.where(hash_share(key, salt) < rate).dropDuplicates([key])
    return chosen.limit(math.ceil(2 * each * len(counts))), counts
