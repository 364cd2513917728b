"""Toxicity scores by a factorization machine over hashed terms."""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronogrid.llm.bpe import Memory
from chronogrid.llm.grams import balanced_sample, letters_only
from chronogrid.llm.kernels import prepare, text_rows, text_udf

PER_CLASS = 3000  # training documents of each class, at most about this many
TERM_BITS = 20  # terms are hashed to this many bits
TERMS = 1024  # hashed terms chosen because they tell the classes apart by themselves
PAIR_TERMS = 2048  # most frequent distinct terms among which telling pairs are looked for
PAIR_BLOCK = 128  # terms whose pairs are counted together
PAIR_FACTOR = 4  # how much surer a pair must be than its two terms together
PAIR_DEVIATIONS = 6.0  # what a pair must exceed; of 10^7 pairs by chance none does
FACTORS = 4  # length of a term's factor vector
PREFIXES = range(3, 9)  # a word's beginnings of these lengths, in bytes, are terms too


def terms_of(word: bytes) -> list[int]:
    """Hashed terms of a word: itself and its beginnings."""
    mask = (1 << TERM_BITS) - 1
    return [zlib.crc32(b"=" + word) & mask] + [
        zlib.crc32(b"^" + word[:n]) & mask for n in PREFIXES if n <= len(word)
    ]


@dataclass
class Machine:
    """score = sigmoid(bias + sum of w + sum over pairs of <v, v>) over the terms present."""

    slots: dict[int, int]
    w: np.ndarray
    v: np.ndarray
    bias: float

    def slots_of(self, words: list[bytes]) -> list[tuple[int, ...]]:
        get = self.slots.get
        return [tuple({s for t in terms_of(word) if (s := get(t)) is not None}) for word in words]

    def score(self, present: set[int]) -> float:
        at = np.fromiter(present, np.int64, len(present))
        at.sort()
        v = self.v[at]
        pairs = 0.5 * float((v.sum(axis=0) ** 2).sum() - (v**2).sum())
        raw = self.bias + float(self.w[at].sum()) + pairs
        return float(1 / (1 + np.exp(-np.clip(raw, -30, 30))))


def choose_terms(lists: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """The TERMS hashed terms whose documents differ most surely between the classes."""
    size = 1 << TERM_BITS
    one = np.zeros(size)
    nil = np.zeros(size)
    for terms, label in zip(lists, y, strict=True):
        (one if label else nil)[terms] += 1
    n1, n0 = max(1, y.sum()), max(1, (1 - y).sum())
    kept = np.flatnonzero(one + nil >= 4)
    one, nil = one[kept], nil[kept]
    a, b = one + 0.5, n1 - one + 0.5
    c, d = nil + 0.5, n0 - nil + 0.5
    sure = np.abs(np.log(a * d / (b * c))) / np.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    best = np.argsort(-sure, kind="stable")[:TERMS]
    return kept[best[sure[best] > 2.5]]


def choose_pairs(lists: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Terms that matter together: those of pairs whose dependence differs between the classes.

    A pair is counted in a table of both terms and the label. It counts if the terms' log
    odds ratio changes from one class to the other, which shows a pair however balanced its
    terms are by themselves, and if having both, or exactly one, goes with the label more
    surely than the terms do one by one (long texts hold any two words more often than
    short ones, so the first test alone would also find the length of a text). All pairs of
    the PAIR_TERMS most frequent terms are counted; terms that occur in the same rows count
    as one. A rarer pair could not exceed chance in a sample of this size.
    """
    counts = np.zeros(1 << TERM_BITS, np.int32)
    for own in lists:
        counts[own] += 1
    counts[counts > len(lists) - 4] = 0
    frequent = np.argsort(-counts, kind="stable")[: 4 * PAIR_TERMS]
    frequent = frequent[counts[frequent] >= 16]
    mark = np.random.default_rng(5).integers(1, 1 << 62, len(lists))
    same = np.zeros(1 << TERM_BITS, np.int64)
    for row, own in zip(mark, lists, strict=True):
        same[own] ^= row
    _, first = np.unique(same[frequent], return_index=True)
    terms = frequent[np.sort(first)][:PAIR_TERMS]
    if not len(terms) or not 0 < y.sum() < len(y):
        return terms[:0]
    order = np.argsort(y <= 0, kind="stable")  # toxic rows first
    x = _presence([lists[row] for row in order], terms, bool)
    cut = int((y > 0).sum())
    sides = [x[:cut], x[cut:]]
    held = [side.sum(axis=0, dtype=float) for side in sides]
    toxic, rows = float(len(sides[0])), float(len(x))

    def sure(with_label: np.ndarray, alone: np.ndarray) -> np.ndarray:
        """Squared deviations of a mark's association with the label."""
        spread = alone * (rows - alone) * toxic * (rows - toxic) / rows
        return (with_label * rows - alone * toxic) ** 2 / np.maximum(spread, 1e-9)

    single = sure(held[0], held[0] + held[1])
    least = PAIR_DEVIATIONS**2
    found = np.zeros(len(terms), bool)
    starts = range(0, len(terms), PAIR_BLOCK)
    for i, j in ((i, j) for i in starts for j in starts if i <= j):
        one, two = slice(i, i + PAIR_BLOCK), slice(j, j + PAIR_BLOCK)
        both = [(s[:, one].astype(np.float32).T @ s[:, two].astype(np.float32)).astype(float) for s in sides]
        ratio, spread = 0.0, 0.0
        for sign, side, n, b in zip((1, -1), sides, held, both, strict=True):
            left, right = n[one, None] - b, n[two] - b
            cells = [c + 0.5 for c in (b, left, right, len(side) - b - left - right)]
            ratio = ratio + sign * np.log(cells[0] * cells[3] / (cells[1] * cells[2]))
            spread = spread + sum(1 / c for c in cells)
        only = [n[one, None] + n[two] - 2 * b for n, b in zip(held, both, strict=True)]
        marked = np.maximum(sure(both[0], both[0] + both[1]), sure(only[0], only[0] + only[1]))
        alone = single[one, None] + single[two]
        good = (ratio**2 > least * spread) & (marked > PAIR_FACTOR * alone + least)
        if i == j:
            np.fill_diagonal(good, False)
        found[one] |= good.any(axis=1)
        found[two] |= good.any(axis=0)
    return terms[found]


def _presence(lists: list[np.ndarray], terms: np.ndarray, kind: type = np.float32) -> np.ndarray:
    """A row for each list and a column for each term: 1 where the list holds the term."""
    place = np.full(1 << TERM_BITS, -1)
    place[terms] = np.arange(len(terms))
    x = np.zeros((len(lists), len(terms)), kind)
    for row, own in zip(x, lists, strict=True):
        at = place[own]
        row[at[at >= 0]] = 1
    return x


def fit(x: np.ndarray, y: np.ndarray, offset: float, steps: int = 250, l2: float = 3e-4) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights, factors and bias by full-batch Adam on the logistic loss.

    `offset` is added to every raw score during the fit, so that the bias found holds
    for the true share of the classes.
    """
    n, m = x.shape
    rng = np.random.default_rng(11)
    y = y.astype(np.float32)
    prior = np.log(max(float(y.mean()), 1e-3) / max(1 - float(y.mean()), 1e-3)) - offset
    params = [np.zeros(m), rng.normal(0, 0.02, (m, FACTORS)), np.array([prior])]
    params = [p.astype(np.float32) for p in params]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        w, v, b = params
        summed = x @ v
        raw = b[0] + np.float32(offset) + x @ w + 0.5 * ((summed**2).sum(axis=1) - x @ (v**2).sum(axis=1))
        slope = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y) / n
        back = x.T @ slope
        grads = [
            back + l2 * w,
            x.T @ (slope[:, None] * summed) - v * back[:, None] + 3 * l2 * v,
            np.array([slope.sum()]),
        ]
        for p, g, f, s in zip(params, grads, first, second, strict=True):
            f += 0.1 * (g - f)
            s += 0.001 * (g * g - s)
            p -= 0.05 * (f / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return params[0].astype(float), params[1].astype(float), float(params[2][0])


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> Machine:
    """Learn from labelled documents; a document with several labels counts as its largest.

    The sample is bounded by PER_CLASS; only its hashed terms reach the driver, of a very
    long text at most as many as there are hashes. The machine gets the terms that tell the
    classes apart by themselves and those that do so in pairs. Rows with a NULL id, label or
    text teach nothing; without any rows left every score is near zero.
    """
    spark = prepare(docs.sparkSession)
    marks = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    marks = marks.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("kind"))
    sample, counts = balanced_sample(marks, "kind", "id", 2 * PER_CLASS, 2, "toxicity")
    empty = Machine({}, np.zeros(0), np.zeros((0, FACTORS)), -10.0)
    if not counts:
        return empty
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    chosen = texts.join(F.broadcast(sample), "id").dropDuplicates(["id"])  # at most 4 * PER_CLASS ids

    def kernel(batch: list[str]) -> dict:
        known: dict[bytes, list[int]] = {}
        out = []
        for text in batch:
            words = set(letters_only(text).split())
            known.update((w, terms_of(w)) for w in words.difference(known))
            out.append(sorted(set(chain.from_iterable(map(known.__getitem__, words)))))
        return {"terms": out}

    got = chosen.select("kind", text_udf(kernel, "terms array<int>")(F.col("text")).alias("made")).toArrow()
    if not got.num_rows:
        return empty
    y = got.column("kind").to_numpy().astype(float)
    made = got.column("made").combine_chunks().field("terms")
    ends = made.offsets.to_numpy()
    flat = made.values.to_numpy()
    lists = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    terms = np.unique(np.concatenate([choose_terms(lists, y), choose_pairs(lists, y)]))
    slots = {int(t): i for i, t in enumerate(terms)}
    x = _presence(lists, terms)
    true_odds = (counts.get(1, 0) + 1) / (counts.get(0, 0) + 1)
    offset = np.log((y.sum() + 1) / ((1 - y).sum() + 1) / true_odds)
    w, v, bias = fit(x, y, offset)
    return Machine(slots, w, v, bias)


SCHEMA = "score double"


def _kernel(spark, machine: Machine):
    parts = spark.sparkContext.broadcast(vars(machine))

    def kernel(texts: list[str]) -> dict:
        value = parts.value  # kept by the worker process, and the memory with it
        memory = value.setdefault("memory", None) or Memory()
        value["memory"] = memory
        model = Machine(*(value[name] for name in ("slots", "w", "v", "bias")))
        lists = [set(letters_only(text).split()) for text in texts]
        return {"score": [model.score(set(chain.from_iterable(s))) for s in memory.recall(lists, model.slots_of)]}

    return kernel


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score) of whole texts, one row per input row; higher means likelier toxic.

    Terms are lower-cased words of letters and their beginnings, each counted once a
    text. A NULL or empty text has no terms and gets the score of the bias alone; very long
    texts are read whole; repeated rows stay; an empty table gives an empty result; other
    columns are ignored whatever their names. Without training rows every score is near
    zero.
    """
    spark = prepare(docs.sparkSession)
    return text_rows(docs, _kernel(spark, machine), SCHEMA, id_col, text_col)


def score_column(spark, machine: Machine, text_col: str = "text") -> Column:
    """The same as a struct column, for filters."""
    return text_udf(_kernel(prepare(spark), machine), SCHEMA)(F.col(text_col))
