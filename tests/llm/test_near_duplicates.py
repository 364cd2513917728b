import random
import re

import numpy as np
import pytest
import xxhash

from chronogrid.llm import components, simhash, vector_dedup

from .conftest import by_id, groups, text_of


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_components_match_union_find(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 470)]
    rows = [(a, b) for a, b in links] + [(None, 5), (9, 9)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a != b]
    assert got == groups(real, {n for link in real for n in link})


def test_components_of_nothing(spark):
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("parts", [1, 4])
def test_gray_index_finds_all_links(parts):
    rng = np.random.default_rng(parts)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64) * np.uint64(2)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (4, 600), dtype=np.uint64), axis=0)
    ball = base[0] ^ (np.uint64(1) << np.arange(64, dtype=np.uint64))
    codes = np.unique(np.concatenate([base, base[rng.integers(0, 40, 600)] ^ flips, ball]))
    part = rng.integers(0, parts, len(codes))
    index = simhash.GrayIndex(part, codes)
    root = np.empty(len(codes), int)
    root[index.order] = index.join_near(3).root
    near = [
        (i, int(j))
        for i in range(len(codes))
        for j in np.flatnonzero((np.bitwise_count(codes ^ codes[i]) <= 3) & (part == part[i]))
    ]
    want = groups(near, range(len(codes)))
    pairs = {(want[i], root[i]) for i in range(len(codes))}
    assert len(pairs) == len(set(want.values())) == len(set(root.tolist()))


def test_near_words_agree_under_some_mask():
    masks = [m & (1 << 64) - 1 for m in simhash.band_masks(3)]
    rng = random.Random(2)
    for _ in range(300):
        change = sum(1 << bit for bit in rng.sample(range(64), 3))
        assert any(change & mask == 0 for mask in masks)


def check_simhash(docs):
    rows = docs.collect()
    marks = {(r["doc_id"], text_of(r)): brute_fingerprint(text_of(r)) for r in rows}
    named = [(k[0], fp) for k, fp in marks.items() if k[0] is not None]
    links = [(a, b) for a, x in named for b, y in named if (x ^ y).bit_count() <= 3]
    want = groups(links, {a for a, _ in named})
    got = simhash.near_duplicates(docs)
    assert got.count() == len(rows)
    for key, found in by_id(got, "doc_id").items():
        for r in found:
            assert r["fingerprint"] in {f"{fp:016x}" for (k, _), fp in marks.items() if k == key}
            if key is not None:
                assert r["component_id"] == want[key]


def test_simhash_on_edges(edge_docs):
    check_simhash(edge_docs)
    assert simhash.near_duplicates(edge_docs.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [4096, 3])
def test_simhash_against_all_pairs(spark, monkeypatch, limit):
    """Copies, near copies and others; with a small limit buckets are split."""
    monkeypatch.setattr(simhash, "BUCKET_ROWS", limit)
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    texts = [[word() for _ in range(rng.randint(60, 200))] for _ in range(12)]
    rows = []
    for text in texts:
        for _ in range(8):
            near = list(text)
            for _ in range(rng.randint(0, 3)):
                near[rng.randrange(len(near))] = word()
            rows.append(" ".join(near))
    rows += [rows[0]] * 20
    docs = spark.createDataFrame([(i * 7 % 1000, t) for i, t in enumerate(rows)], "doc_id long, text string")
    check_simhash(docs)


def check_vectors(df, threshold=0.93):
    rows = df.collect()

    def usable(r):
        v = r["embedding"]
        return r["label"] is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = {}
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if i != j and usable(a) and usable(b) and a["label"] == b["label"] and len(a["embedding"]) == len(b["embedding"]):
                x, y = np.array(a["embedding"], float), np.array(b["embedding"], float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                    links.setdefault(i, []).append(j)
    want = groups([(a, b) for a in links for b in links[a]], range(len(rows)))
    ids = [r["vec_id"] for r in rows]
    smallest = {}
    for i, root in want.items():
        if ids[i] is not None:
            smallest[root] = min(smallest.get(root, ids[i]), ids[i])
    expected = sorted((ids[i] if ids[i] is not None else -1, len(links.get(i, []))) for i in range(len(rows)))
    got = vector_dedup.near_duplicates(df, threshold).collect()
    assert sorted((r["vec_id"] if r["vec_id"] is not None else -1, r["n_links"]) for r in got) == expected
    component = {ids[i]: smallest[want[i]] for i in range(len(rows)) if ids[i] is not None}
    for r in got:
        if r["vec_id"] is not None:
            assert r["component_id"] == component[r["vec_id"]]
        assert r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"])


SCHEMA = "vec_id long, embedding array<float>, label int, rep string, codes int, n_links int"


def test_vectors_on_edges(spark):
    v = [1.0, 2.0, 0.0]
    rows = [
        (1, v, 0), (2, v, 0), (3, [2.0, 4.0, 0.0], 0), (4, v, 1), (5, v, None), (6, None, 0), (7, [], 0),
        (8, [0.0, 0.0, 0.0], 0), (9, [1.0, None, 0.0], 0), (10, [1.0, float("nan"), 0.0], 0),
        (11, [float("inf"), 2.0, 0.0], 0), (12, [1.0, 2.0], 0), (None, v, 0), (14, [5.0], 2), (15, [7.0], 2), (16, [-7.0], 2),
    ]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    check_vectors(df)
    assert vector_dedup.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [1024, 5])
def test_vectors_against_all_pairs(spark, monkeypatch, limit):
    """Near groups, copies and others over three labels; with a small limit buckets are split."""
    monkeypatch.setattr(vector_dedup, "BUCKET_ROWS", limit)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 32))
    rows = [centres[i % 12] + rng.normal(size=32) * rng.choice([0.05, 0.15, 0.3, 2.0]) for i in range(260)]
    rows += [rows[0]] * 6 + [rows[5] * 3] * 3
    data = [(i * 11 % 997, [float(x) for x in r], int(i % 3), "x", 1, 2) for i, r in enumerate(rows)]
    check_vectors(spark.createDataFrame(data, SCHEMA))


def test_recall_at_the_threshold():
    """Pairs exactly at cosine 0.93, the hardest that count, meet in some bucket."""
    rng = np.random.default_rng(6)
    a = rng.normal(size=(1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    z = rng.normal(size=a.shape)
    z -= (z * a).sum(1, keepdims=True) * a
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    b = 0.93 * a + np.sqrt(1 - 0.93**2) * z
    x, y = vector_dedup.buckets(a), vector_dedup.buckets(b)
    met = (x[:, :, :1] == y).any((1, 2)) | (y[:, :, :1] == x).any((1, 2))
    assert met.mean() > 0.999
