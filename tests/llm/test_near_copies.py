"""Near copies by exact five-word Jaccard similarity, against brute force."""

import random

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from chronogrid.llm import queries, simhash

from .conftest import groups

FOLDER = "/root/testdata/sf0.01"


def shingles(text):
    words = text.encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def edited(words, rng, lowest):
    """Words changed one by one, down to a similarity of `lowest` to the old ones."""
    old, words = shingles(" ".join(words)), list(words)
    while True:
        was = list(words)
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**9)}"
        if jaccard(old, shingles(" ".join(words))) < lowest:
            return was


def test_planted_copies(spark):
    rng = random.Random(3)
    rows, want = [], 0
    for i in range(300):
        words = [f"v{rng.randrange(3000)}" for _ in range(rng.choice([60, 200, 700]))]
        copy = edited(words, rng, rng.uniform(0.8, 0.95))
        apart = edited(copy, rng, 0.8)
        rows += [(3 * i, " ".join(words)), (3 * i + 1, " ".join(copy))]
        far = list(apart)
        for k in range(0, len(far), 12):  # every second shingle and more is new
            far[k] = f"f{rng.randrange(10**9)}"
        rows += [(3 * i + 2, " ".join(far))]
        want += 2
    kept = {r["doc_id"] for r in simhash.first_of_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(3 * i in kept and 3 * i + 2 in kept for i in range(300))
    assert sum(3 * i + 1 not in kept for i in range(300)) >= 299


def test_stage_against_brute_force(spark):
    docs = queries.table(spark, FOLDER, "documents")
    rows = docs.collect()
    sets = {r["doc_id"]: shingles(r["text"]) for r in rows}
    ids = sorted(sets)
    pairs = ((a, b) for i, a in enumerate(ids) for b in ids[:i])
    links = [p for p in pairs if jaccard(sets[p[0]], sets[p[1]]) >= 0.8]
    root = groups(links, ids)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    assert sorted(kept.collect()) == sorted(r for r in rows if root[r["doc_id"]] == r["doc_id"])


@pytest.mark.parametrize("count", [3000, 30000])
def test_texts_of_one_template_stay_apart(spark, monkeypatch, count):
    """Much in common, but no copies: hardly any text is looked at, and all stay."""
    looked = []
    plain = simhash.split_buckets

    def counting(rows, key, item, limit):
        out = plain(rows, key, item, limit)
        if key == "component":
            looked.append(out.count())
        return out

    monkeypatch.setattr(simhash, "split_buckets", counting)
    common = " ".join(f"c{i}" for i in range(64))
    own = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(39)), lambda i: F.concat(F.lit("o"), F.xxhash64("id", i).cast("string"))), " ")
    docs = spark.range(count).select(F.col("id").alias("doc_id"), F.concat(F.lit(common + " "), own).alias("text"))
    assert simhash.first_of_copies(docs).count() == count
    assert looked[0] <= 2 * count


def test_columns_of_any_type(spark):
    """A map column, a hot row that is repeated whole, NULL and blank texts, no rows."""
    rows = [(1, "a b c d e f", {"k": 1}), (2, "a b c d e f", None), (3, None, {}), (4, " ", {"x": 2})] + [(5, "one more text", {"k": 3})] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra map<string,int>")
    kept = simhash.first_of_copies(docs).collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 3, 5] and kept[0].asDict().keys() == {"doc_id", "text", "extra"}
    assert simhash.first_of_copies(docs.limit(0)).collect() == []


def test_large_groups_are_cut(spark, monkeypatch):
    monkeypatch.setattr(simhash, "VERIFY_ROWS", 8)
    rng = random.Random(5)
    words = [f"v{i}" for i in range(400)]
    rows = [(i, " ".join(edited(words, rng, 0.93))) for i in range(60)]
    kept = simhash.first_of_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r["doc_id"] for r in kept] == [0]


@pytest.mark.parametrize("seed", [0, 1])
def test_one_id_in_two_groups(spark, seed):
    """Rows of one id replace each other only within a group of copies."""
    rng = random.Random(seed)
    a, b = (" ".join(f"v{rng.randrange(3000)}" for _ in range(80)) for _ in range(2))
    rows = [(7, a), (7, b), (7, a), (9, b), (None, a), (None, a)]
    kept = simhash.first_of_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(str, kept)) == sorted(f"Row(doc_id={k}, text={t!r})" for k, t in [(7, a), (7, b), (None, a), (None, a)])


def test_copies_are_found_through_fingerprints_alone(spark, monkeypatch):
    """No key of the fingerprint, no candidates: nothing else brings near copies together."""
    rng = random.Random(8)
    words = [f"v{i}" for i in range(300)]
    docs = spark.createDataFrame([(i, " ".join(edited(words, rng, 0.95))) for i in range(6)], "doc_id long, text string")
    assert simhash.first_of_copies(docs).count() == 1
    monkeypatch.setattr(simhash, "TABLES", 0)
    assert simhash.first_of_copies(docs).count() == 6


def test_wide_fingerprint_by_hand():
    """More than half of the hashes have the bit; the first word is the plain SimHash."""
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 255, 256, 700):
        hashes = rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + rng.integers(0, 2, n, np.uint64)
        wide = simhash.wide_fingerprint(hashes)
        assert len(wide) == simhash.FIELDS
        assert int(wide[0]) == sum(1 << i for i in range(64) if 2 * sum(int(h) >> i & 1 for h in hashes) > n)
    far = simhash.wide_fingerprint(rng.integers(0, 1 << 63, 400, np.uint64)) ^ wide
    assert 400 < np.bitwise_count(far).sum() < 624


@pytest.mark.parametrize("size,shared", [(4, 4), (13, 12), (18, 16), (90, 80), (900, 800)])
def test_sets_at_the_threshold_meet(size, shared):
    """Of sets with a similarity of 0.8 or little more, nearly all meet in a table and pass the screen."""
    rng = np.random.default_rng(size)
    small = size <= simhash.SHORT
    met = passed = 0
    for _ in range(400):
        both = rng.integers(0, 1 << 63, shared, np.uint64) * np.uint64(2) + rng.integers(0, 2, shared, np.uint64)
        sets = [np.concatenate([both, rng.integers(0, 1 << 63, n, np.uint64)]) for n in ((0, 1) if small else (size - shared,) * 2)]
        wide = np.stack([simhash.wide_fingerprint(s) for s in sets])
        tables = [simhash._keys(wide, simhash.TABLES, turned) for turned in ((False, True) if small else (False,))]
        met += any(((b[0] == b[1]) & (np.bitwise_count(c[0] ^ c[1]) <= simhash.NEAR)).any() for b, c in tables)
        passed += np.bitwise_count(wide[0] ^ wide[1]).sum() <= (simhash.SHORT_BITS if small else simhash.WIDE_BITS)
    assert met >= 397 and passed == 400


def test_index_tells_who_has_company():
    """Against brute force, in groups of random codes, loose pairs and a dense cluster."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 600, np.uint64)
    flip = np.array([np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, 14, np.uint64)) for _ in range(200)])
    dense = base[0] ^ np.array([np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, 5, np.uint64)) for _ in range(200)])
    codes = np.concatenate([base, base[:200] ^ flip, dense])
    part = rng.integers(0, 3, len(codes))
    index = simhash.GrayIndex(part, codes)
    near = (np.bitwise_count(codes[:, None] ^ codes) <= simhash.NEAR) & (part[:, None] == part)
    np.fill_diagonal(near, False)
    got = np.zeros(len(codes), bool)
    got[index.order] = index.company(simhash.NEAR)
    assert (got == near.any(axis=1)).all() and 0 < got.sum() < len(got)
