"""Language identification: the family first, then one-versus-one machines within it."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronogrid.llm.grams import SEEN_BITS, WIDTH, Grams, ragged_sums, balanced_sample, dense, fit_linear, letters_only, seen_grams, share_udf
from chronogrid.llm.kernels import prepare, text_rows, text_udf

SAMPLE_ROWS = 2000  # training documents, about as many of each language
LANGUAGE_ROWS = 20  # of each language at least, however many languages there are
# A text is of a learned language if the share of its four-byte grams that training rows
# hold (of any language, so that mixed texts stay) is not below a floor: SLACK times the
# share that all but a twentieth (LOW) of the found language's rows reach when learned
# from the other half of all rows. Short texts may stay below by three deviations, taken
# twice as wide since grams overlap.
LOW, SLACK, DEVIATIONS = 0.05, 0.75, 6.0
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")

# Language families by ISO 639-1 code. A code that is not listed is a
# family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no is af",
    "romance": "fr es it pt ro ca gl",
    "slavic": "ru uk be bg sr hr sl cs sk pl",
    "uralic": "fi et hu",
    "turkic": "tr az kk",
    "semitic": "ar he",
    "indic": "hi bn ur mr",
}


def family_of(code: str) -> str:
    return next((name for name, codes in FAMILIES.items() if code in codes.split()), code)


@dataclass
class Machines:
    """Linear machines side by side, and how they are read."""

    families: list[str] = field(default_factory=list)
    members: dict[str, list[str]] = field(default_factory=dict)
    duels: list[tuple[str, str]] = field(default_factory=list)  # after one machine per family
    weights: np.ndarray = field(default_factory=lambda: np.zeros((WIDTH, 0)))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))
    seen: np.ndarray = field(default_factory=lambda: np.zeros(1 << SEEN_BITS, bool))
    floor: dict[str, float] = field(default_factory=dict)

    def read(self, grams: Grams) -> tuple[list[str], np.ndarray]:
        """Language and score of each text: its family by all family machines, then a
        language by the machines of that family alone."""
        n, kinds = len(grams.lengths[0]), len(self.families)
        if not self.families:
            return [UNKNOWN] * n, np.zeros(n)
        raw = grams.scores(self.weights[:, :kinds], self.bias[:kinds])
        share = np.exp(3 * (raw - raw.max(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        family = raw.argmax(axis=1)
        languages, score = [""] * n, np.zeros(n)
        for f, name in enumerate(self.families):
            rows = np.flatnonzero(family == f)
            codes = self.members[name]
            duels = [d for d, (a, _) in enumerate(self.duels) if a in codes]
            votes = np.zeros((len(rows), len(codes)))
            if len(rows) and duels:
                at = kinds + np.array(duels)
                margins = grams.take(rows).scores(self.weights[:, at], self.bias[at])
                for d, margin in zip(duels, np.clip(margins.T, -10, 10), strict=True):
                    a, b = (codes.index(code) for code in self.duels[d])
                    chance = 1 / (1 + np.exp(-3 * margin))
                    votes[:, a] += chance
                    votes[:, b] += 1 - chance
            if len(codes) == 1:
                votes[:] = 1.0
            best = votes.argmax(axis=1)
            inside = votes[np.arange(len(rows)), best] / max(1, len(codes) - 1)
            for row, winner, chance in zip(rows, best, inside, strict=True):
                languages[row], score[row] = codes[winner], chance * share[row, f]
        return languages, score

    def doubtful(self, texts: list[bytes], languages: list[str]) -> np.ndarray:
        """Whether each text has too few grams seen in training to be of its language."""
        buckets, count = seen_grams(texts)
        known = ragged_sums(self.seen[buckets].astype(float), count)
        out = np.zeros(len(texts), bool)
        for row, code in enumerate(languages):
            n, floor = int(count[row]), self.floor.get(code, 0.0)
            if n:
                least = floor * n - DEVIATIONS * (floor * (1 - floor) * n) ** 0.5
                out[row] = known[row] == 0 or known[row] < least
        return out


def _seen(kinds: np.ndarray, halves: np.ndarray, lists: list[np.ndarray]) -> tuple[np.ndarray, dict[str, float]]:
    """The grams of all rows, and by language the floor of the share that texts have of them."""
    held = np.zeros((2, 1 << SEEN_BITS), bool)
    for half, grams in zip(halves, lists, strict=True):
        held[half, grams] = True
    floor = {}
    for code in sorted(set(kinds.tolist())):
        rows = np.flatnonzero(kinds == code)
        sides = [r for r in rows if len(lists[r]) and (halves[rows] != halves[r]).any()]
        shares = [held[1 - halves[r], lists[r]].mean() for r in sides]
        floor[code] = SLACK * float(np.quantile(shares, LOW)) if shares else 0.0
    return held.any(axis=0), floor


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Machines:
    """Learn from rows with a language: a family machine each, and one per two languages
    of a family. All languages are learned. The sample is bounded by SAMPLE_ROWS, or by
    LANGUAGE_ROWS for each language if that is more; only its hashed n-gram shares reach
    the driver."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("kind"))
    rows = rows.where("kind IS NOT NULL AND text IS NOT NULL")
    sample, counts = balanced_sample(rows, "kind", "id", SAMPLE_ROWS, None, "language", LANGUAGE_ROWS)
    if not counts:
        return Machines()

    def distinct(texts: list[str]) -> dict:
        return {"grams": [np.unique(seen_grams([letters_only(text)])[0]) for text in texts]}

    grams = text_udf(distinct, "grams array<int>")(F.col("text"))
    half = F.pmod(F.xxhash64(F.lit("half"), "id"), F.lit(2)).cast("int").alias("half")
    got = sample.select("kind", half, grams["grams"].alias("grams")).toArrow()
    lists = [g.values.to_numpy() for g in got.column("grams")]
    seen, floor = _seen(np.array(got.column("kind").to_pylist()), got.column("half").to_numpy(), lists)
    del got, lists
    pa.default_memory_pool().release_unused()
    got = sample.select("kind", share_udf(letters_only)(F.col("text")).alias("made")).toArrow()
    made = got.column("made")
    some = pc.greater(pc.list_value_length(pc.struct_field(made, "columns")), 0)
    made = made.filter(some)
    kinds = np.array(got.column("kind").filter(some).to_pylist())
    del got
    codes = sorted(set(kinds.tolist()))
    if not codes:
        return Machines()
    families = sorted({family_of(c) for c in codes})
    members = {f: [c for c in codes if family_of(c) == f] for f in families}
    duels = [pair for f in families for pair in combinations(members[f], 2)]
    own = np.array([family_of(c) for c in kinds])

    def machine(rows: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, float]:
        """One machine; only its own rows are made dense, and only while it is fitted."""
        part = dense(made.filter(pa.array(rows)))
        return fit_linear(part, np.where(positive[rows], 1.0, -1.0), squared_hinge=True)

    fits = []
    for k, f in enumerate(families):
        if len(families) == 2 and k == 1:  # the other side of the first machine
            fits.append((-fits[0][0], -fits[0][1]))
        elif len(families) == 1:
            fits.append((np.zeros(WIDTH), 1.0))
        else:
            fits.append(machine(np.ones(len(own), bool), own == f))
    fits += [machine((kinds == a) | (kinds == b), kinds == a) for a, b in duels]
    weights, bias = np.stack([f[0] for f in fits], axis=1), np.array([f[1] for f in fits])
    return Machines(families, members, duels, weights, bias, seen, floor)


def _kernel(machines):
    def kernel(texts: list[str]) -> dict:
        model = machines.value
        letters = [letters_only(text) for text in texts]
        languages, score = model.read(Grams.of(letters))
        doubtful = model.doubtful(letters, languages)
        for row, text in enumerate(texts):
            if LETTER.search(text) is None:
                languages[row], score[row] = UNKNOWN, 0.0
            doubtful[row] |= languages[row] == UNKNOWN
        return {"lang_pred": languages, "score": score, "doubtful": doubtful}

    return kernel


SCHEMA = "lang_pred string, score double, doubtful boolean"


class _Sent:
    """Machines as plain arrays, so that a broadcast needs no class on the executors."""

    def __init__(self, machines: Machines, spark):
        self.parts = spark.sparkContext.broadcast(vars(machines))

    @property
    def value(self) -> Machines:
        parts = self.parts.value
        return Machines(**parts)


def predict(docs: DataFrame, machines: Machines, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score, doubtful) of whole texts, one row per input row.

    `lang_pred` is a learned language, or "und" with score 0 for a text that is NULL or has
    no letter, and for every text if nothing was learned; the score (0 to 1) is the
    family's share times the winner's share of its duels. Only the duels of the family
    found are scored. Ties go to the first code. `doubtful` marks texts that are "und" or
    have too few n-grams of the language's training rows (see LOW), such as those in a
    language or script that was not learned.

    Only the text is looked at, whole however long, a few megabytes of texts at a time;
    repeated rows stay; an empty table gives an empty result; other columns are ignored
    whatever their names.
    """
    spark = prepare(docs.sparkSession)
    return text_rows(docs, _kernel(_Sent(machines, spark)), SCHEMA, id_col, text_col)


def language_column(spark, machines: Machines, text_col: str = "text") -> Column:
    """The same as a struct column, for filters."""
    return text_udf(_kernel(_Sent(machines, prepare(spark))), SCHEMA)(F.col(text_col))
