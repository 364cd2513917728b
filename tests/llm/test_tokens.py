import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from chronogrid.llm import bpe, codec, packing, token_counts

from .conftest import EDGES, text_of

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SIGNS = "ab c\n\t  é'sStré1 ²½#$%日本 語🙂̀İ\xa0\x85 \x1c​“”€Σςɐٱ٣ABß|<>"


def fuzz(n=800):
    rng = random.Random(3)
    made = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return made + [t for t in EDGES if t] + ["a" * 700, "ab" * 900, " " * 300, "\n" * 40 + "x", ""]


@pytest.fixture(scope="module")
def tik():
    with open(MULTI, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_tree_merges_are_those_of_the_library(tik):
    vocabulary = bpe.load_ranks(MULTI)
    texts = fuzz()
    for text, ids in zip(texts, codec.encode_texts(vocabulary, texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tik.encode_ordinary(text)
        assert codec.decode_ids(vocabulary, ids) == text.encode()


def test_long_words_take_the_single_tree_and_agree(tik):
    vocabulary = bpe.load_ranks(MULTI)
    rng = random.Random(5)
    word = "".join(rng.choice("abcdeé") for _ in range(5000))
    assert np.frombuffer(codec.encode_texts(vocabulary, [word])[0], "<u4").tolist() == tik.encode_ordinary(word)


def test_rank_merges_are_those_of_the_library():
    vocabulary, library = bpe.load_merges(BYTES), Tokenizer.from_file(BYTES)
    assert vocabulary.layered
    texts = [t.replace("<|endoftext|>", "") for t in fuzz()]
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    for text, ids in zip(texts, want, strict=True):
        words = bpe.byte_words(text)
        got = bpe.merge_by_rank(vocabulary, bpe.encoded_bytes(words))[0].tolist() if words else []
        assert got == ids


def test_one_place_at_a_time_gives_the_same_for_layered_merges():
    vocabulary = bpe.load_merges(BYTES)
    words = [b"aaaaaaa", b"banana", "énormément".encode(), b" the"]
    want = bpe.merge_by_rank(vocabulary, words)
    vocabulary.layered = False
    got = bpe.merge_by_rank(vocabulary, words)
    assert all((a == b).all() for a, b in zip(want, got, strict=True))


def test_memory_forgets_and_still_answers():
    memory = bpe.Memory()
    memory.LIMIT = 3
    for words in (["a", "b"], ["b", "c", "d"], ["a", "a"], ["e"]):
        got = [list(x) for x in memory.recall([words, []], lambda new: [w.upper() for w in new])]
        assert got == [[w.upper() for w in words], []]
    assert len(memory) <= 4


def test_codec_on_edges(edge_docs, tik):
    text = {(r["doc_id"], text_of(r)) for r in edge_docs.collect()}
    rows = codec.round_trip(edge_docs, MULTI).collect()
    want = set()
    for key, value in text:
        ids = np.array(tik.encode_ordinary(value), "<u4").tobytes()
        want.add((key, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(value.encode()).hexdigest()))
    assert {tuple(r) for r in rows} == want and len(rows) == edge_docs.count()
    encoded = codec.encode(edge_docs, MULTI)
    back = codec.decode(encoded, MULTI).collect()
    assert {(r["doc_id"], bytes(r["decoded"]).decode()) for r in back} == text


def test_counts_on_edges(edge_docs):
    library = Tokenizer.from_file(BYTES)
    rows = token_counts.count_tokens(edge_docs, BYTES).collect()
    want = set()
    for r in edge_docs.collect():
        n = len(library.encode(text_of(r), add_special_tokens=False).ids)
        want.add((r["doc_id"], len(text_of(r).encode()), n, n > 512))
    assert {tuple(r) for r in rows} == want and len(rows) == edge_docs.count()


def test_operators_on_an_empty_table(edge_docs):
    none = edge_docs.limit(0)
    assert codec.round_trip(none, MULTI).count() == 0
    assert token_counts.count_tokens(none, BYTES).count() == 0
    assert packing.pack(none, WORDS).count() == 0


def brute_first_fit(lengths, capacity):
    room, out = [], [0] * len(lengths)
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        place = next((b for b, left in enumerate(room) if left >= lengths[item]), len(room))
        if place == len(room):
            room.append(capacity)
        out[item] = place
        room[place] -= lengths[item]
    return out


@pytest.mark.parametrize("n", [1, 2, 7, 300])
def test_tournament_tree_is_first_fit_decreasing(n):
    rng = np.random.default_rng(n)
    lengths = rng.integers(1, 50, n)
    bins, offsets = packing.first_fit_decreasing(lengths, 50)
    assert bins.tolist() == brute_first_fit(lengths.tolist(), 50)
    for b in set(bins.tolist()):
        inside = sorted(zip(offsets[bins == b], lengths[bins == b], strict=True))
        assert [o for o, _ in inside] == np.cumsum([0] + [size for _, size in inside])[:-1].tolist()


def test_packing_on_edges(edge_docs):
    library = Tokenizer.from_file(WORDS)
    rows = packing.pack(edge_docs, WORDS, length=64, group_documents=4, with_ids=True).collect()
    left = sorted(
        (
            [*library.encode(text_of(r), add_special_tokens=False).ids, 1]
            for r in edge_docs.collect()
        ),
        key=str,
    )
    pieces = {}
    for r in rows:
        assert r["length"] == len(r["ids"]) <= 64
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        pieces.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in pieces.values():
        assert [o for o, _ in sorted(parts)] == np.cumsum([0] + [n for _, n in sorted(parts)])[:-1].tolist()
        assert sum(n for _, n in parts) <= 64
    rebuilt = {}
    for r in sorted(rows, key=lambda r: r["start"]):
        rebuilt.setdefault((r["doc_id"], r["doc_tokens"], r["start"]), []).append(r["ids"])
    assert sum(r["length"] for r in rows) == sum(map(len, left))
    first = {r["doc_id"]: [] for r in rows if r["doc_id"] not in (None, 3)}
    for r in sorted(rows, key=lambda r: r["start"]):
        if r["doc_id"] in first:
            first[r["doc_id"]] += r["ids"]
    assert all(ids in left for ids in first.values())
