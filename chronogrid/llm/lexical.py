"""Ranked lexical search: accumulator-limited term-at-a-time scoring in blocks of documents."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronogrid.llm.kernels import prepare, text_udf
from chronogrid.session import materialise

TOP = 10
BLOCK_DOCS = 8192  # documents scored together in a task
PASS_TERMS = 1 << 18  # words of items that one pass over the documents looks for, about
SALTS = 64  # partial rankings of an item that are merged into the last one

# Bytes that are no part of a term become spaces; A-Z become lower case.
TERM_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms_of(text: str) -> list[bytes]:
    """Maximal runs of digits, letters and all characters beyond ASCII, A-Z lower-cased."""
    return text.encode().translate(TERM_BYTES).split()


def _distinct_terms(texts: list[str]) -> dict:
    return {"terms": [sorted(set(terms_of(text))) for text in texts]}


def _term_counts(vocabulary):
    """Kernel: a text's number of terms, and places and counts of those in the vocabulary."""

    def kernel(texts: list[str]) -> dict:
        known = vocabulary.value
        sizes, places, times = [], [], []
        for text in texts:
            words = terms_of(text)
            counted = Counter(words)
            hits = sorted((known[w], n) for w, n in counted.items() if w in known)
            sizes.append(len(words))
            places.append([p for p, _ in hits])
            times.append([n for _, n in hits])
        return {"n": sizes, "places": places, "times": times}

    return text_udf(kernel, "n long, places array<int>, times array<long>")


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


@dataclass
class Block:
    """Postings of a block of documents, sorted by term: `at[begin[t]:begin[t + 1]]`."""

    begin: np.ndarray
    at: np.ndarray
    gain: np.ndarray  # what a posting adds to its document's score
    most: np.ndarray  # the largest gain of each term in this block

    @classmethod
    def of(cls, batch: pa.Table, weights: np.ndarray, documents: int, length: int) -> Block:
        lists = batch.column("places").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        place = lists.flatten().to_numpy().astype(np.int64)
        times = batch.column("times").combine_chunks().flatten().to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        n = batch.column("n").to_numpy().astype(np.int64)
        m = 100 - 90 + (90 * n * documents) // max(1, length)
        gain = weights[place] * ((1_000_000_000 * times) // (1000 * times + 8 * m[doc]))
        order = np.argsort(place, kind="stable")
        begin = np.searchsorted(place[order], np.arange(len(weights) + 1))
        most = np.zeros(len(weights), np.int64)
        np.maximum.at(most, place, gain)
        return cls(begin, doc[order], gain[order], most)

    def search(self, terms: np.ndarray, score: np.ndarray, top: int, least: int) -> np.ndarray:
        """Documents that may be among the `top` of an item, with exact scores in `score`.

        `terms` come rarest first, and `score` as zeros. A document gets an accumulator as
        long as what the remaining terms can add reaches the least score that still counts:
        the `top`-th partial score so far, or `least`, that of an earlier block. Equal
        scores still count, since ids decide among them. After that only documents with an
        accumulator are updated, by all remaining terms.
        """
        terms = terms[self.most[terms] > 0]
        rest = np.cumsum(self.most[terms][::-1])[::-1]
        held: list[np.ndarray] = []
        closed = False
        for left, term in zip(rest, terms, strict=True):
            own = slice(self.begin[term], self.begin[term + 1])
            at, gain = self.at[own], self.gain[own]
            if not closed:
                closed = left < least
            if not closed and len(held):
                open_now = score[np.concatenate(held)]
                if len(open_now) >= top:
                    closed = left < np.partition(open_now, -top)[-top]
            if closed:
                known = score[at] > 0
                score[at[known]] += gain[known]
            else:
                held.append(at[(score[at] == 0) & (gain > 0)])
                score[at] += gain
        return np.concatenate(held) if held else np.zeros(0, np.int64)


def _best(ids: np.ndarray, named: np.ndarray, scores: np.ndarray, top: int) -> np.ndarray:
    """The `top` places by falling score, then by rising id, rows without an id last."""
    return np.lexsort((ids, ~named, -scores))[:top]


def _rank(shared, top: int):
    """Score a partition's documents for all items, block by block; at its end send the best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights, documents, length = shared.value
        best = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in terms]

        def score_block(table: pa.Table) -> None:
            block = Block.of(table, weights, documents, length)
            column = table.column("doc").combine_chunks()
            named = column.is_valid().to_numpy(zero_copy_only=False)
            ids = column.fill_null(0).to_numpy()
            score = np.zeros(table.num_rows, np.int64)
            for item, own in enumerate(terms):
                least = int(best[item][2][-1]) if len(best[item][2]) == top else 0
                at = block.search(own, score, top, least)
                good = at[score[at] >= max(1, least)]
                if len(good):
                    if len(good) > 4 * top:  # only those that reach the top-th score
                        line = np.partition(score[good], -top)[-top]
                        good = good[score[good] >= line]
                    old = best[item]
                    new = [np.concatenate(p) for p in zip(old, (ids[good], named[good], score[good]), strict=True)]
                    keep = _best(*new, top)
                    best[item] = tuple(c[keep] for c in new)
                score[at] = 0

        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK_DOCS:
                score_block(pa.Table.from_batches(held))
                held = []
        if held:
            score_block(pa.Table.from_batches(held))
        for item, (ids, named, scores) in enumerate(best):
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ids), item, np.int32)),
                        pa.array(ids, pa.int64(), mask=~named),
                        pa.array(scores, pa.int64()),
                    ],
                    ["item", "doc", "score"],
                )

    return run


def _one_pass(docs: DataFrame, items: list[tuple[int | None, list[bytes]]], top: int) -> DataFrame:
    """The ranking for a bounded list of (item id, terms), from whole documents (doc, text)."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in items for t in terms}))}
    counts = _term_counts(spark.sparkContext.broadcast(vocabulary))
    made = docs.select("doc", counts(F.col("text")).alias("made")).select("doc", "made.*").where("n > 0")
    postings = materialise(made, "postings")
    documents, length = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = postings.select(F.explode("places").alias("place")).groupBy("place").count()
    holding = np.zeros(len(vocabulary), np.int64)
    for place, n in found.collect():  # one row per word of the items
        holding[place] = n
    weights = np.array([weight(documents, int(n)) for n in holding], np.int64)
    places = [np.array(sorted((vocabulary[t] for t in terms), key=lambda p: (holding[p], p)), np.int64) for _, terms in items]
    shared = spark.sparkContext.broadcast((places, weights, documents, length))
    ranked = postings.mapInArrow(_rank(shared, top), "item int, doc long, score long")
    names = F.array(*(F.lit(key).cast("long") for key, _ in items))
    return ranked.select(names[F.col("item")].alias("item"), F.col("item").alias("at"), "doc", "score")


def _first_rows(ranked: DataFrame, top: int) -> DataFrame:
    """The `top` rows of each item with their rank; partitions' rankings are merged in SALTS
    groups first, so that no task sees all of an item's."""
    order = [F.desc("score"), F.asc_nulls_last("doc")]
    some = ranked.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    for by in (["at", "salt"], ["at"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        some = some.withColumn("rank", rank).where(F.col("rank") <= top)
    return some.select("item", "rank", "doc", "score")


def _passes(items: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items and their terms in lists of about PASS_TERMS words each."""
    words = text_udf(_distinct_terms, "terms array<binary>")(F.col("text"))["terms"]
    made = materialise(items.select("item", F.explode(words).alias("term")).distinct(), "item-terms")
    total = made.count()
    parts = -(-total // PASS_TERMS)
    for part in range(parts):
        rows = made.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part)
        rows = rows.groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms"))
        got = rows.orderBy("item").toArrow()
        yield list(zip(got.column("item").to_pylist(), got.column("terms").to_pylist(), strict=True))


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(item_col, rank, id_col, score) of the `top` documents of each item, best first.

    A term's weight falls with the number of documents holding it; a document's score
    sums, over the item's distinct terms, the weight times a share of 10^6 that grows with
    the term's count and falls with the document's length (see `weight` and `Block.of`).
    All statistics are over all documents. Equal scores go by rising id; scores of zero
    are left out, so an item may have fewer than `top` rows, or none.

    One pass over whole texts keeps the counts of the items' words, in the shared scratch
    folder; the number of documents holding each word comes from there. Tasks then score
    blocks of BLOCK_DOCS documents term at a time, rarest first (see `Block.search`), and
    send on `top` rows per item and partition. Items are taken in passes of about
    PASS_TERMS words, so what is broadcast is bounded however many items there are.

    A NULL or empty text, or one without terms, is no document of the statistics and finds
    nothing; items likewise. Repeated documents each count and rank by themselves. Rows
    with a NULL document id rank after equal scores; rows of one item id, or without one,
    are one item with the terms of all. Very long texts are counted whole, one at a time.
    Empty tables give no rows; other columns are ignored whatever their names.
    """
    spark = prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    asked = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text"))
    found = [_first_rows(_one_pass(rows, part, top), top) for part in _passes(asked)]
    if not found:
        found = [spark.createDataFrame([], "item long, rank int, doc long, score long")]
    every = reduce(DataFrame.unionByName, found)
    return every.select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score")
