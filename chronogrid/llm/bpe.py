"""Byte-pair vocabularies and two ways of merging many words at once."""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Callable, Iterable
from itertools import repeat

import numpy as np
import regex

NONE = np.iinfo(np.int32).max  # rank of a pair that does not merge
SCALAR_BYTES = 256  # longer words get a segment tree of their own

# The pattern's classes. Below U+0250, and in the ranges of general
# punctuation and currency signs, letters, numbers and white space are these.
SPACE = "\\t-\\r \\x85\\xa0"
LETTER = "A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u024f"
NUMBER = "0-9\\xb2\\xb3\\xb9\\xbc-\\xbe"
WIDE_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
RARE = re.compile("[^\\x00-\\u024f\\u2010-\\u2027\\u2030-\\u205e\\u20a0-\\u20bf]")


def _pattern(space: str, letter: str, number: str) -> str:
    """The word pattern of the byte-level vocabularies for given classes."""
    return (
        f"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+"
    )


_PLAIN = re.compile(_pattern(SPACE, LETTER, NUMBER))
_ANY = regex.compile(_pattern(WIDE_SPACE, "\\p{L}", "\\p{N}"))


def byte_words(text: str) -> list[str]:
    """Cut a text by the byte-level pattern; the plain form serves most texts faster."""
    return _PLAIN.findall(text) if RARE.search(text) is None else _ANY.findall(text)


def byte_letters() -> dict[str, int]:
    """The printable letter that .json vocabularies write for each byte, to the byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PairTable:
    """Ranks of mergeable pairs in an open-addressing table that numpy can probe."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, product: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(max(1, len(left)) * 3))))
        self.mask = (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NONE, np.int32)
        self.product = product.astype(np.int32)
        keys = (left.astype(np.int64) << 32) | right
        slot, todo = self._slot(left, right), np.arange(len(keys))
        while len(todo):
            free = self.keys[slot[todo]] == -1
            self.keys[slot[todo[free]]] = keys[todo[free]]  # of several for one slot the last stays
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & self.mask
        self.ranks[slot] = rank

    def _slot(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        mixed = left.astype(np.int64) * 0x9E3779B1 + right.astype(np.int64) * 0x85EBCA77
        return (mixed ^ (mixed >> 17)) & self.mask

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it is not in the table."""
        keys = (left.astype(np.int64) << 32) | right
        slot = self._slot(left, right)
        found = self.keys[slot]
        out = np.where(found == keys, self.ranks[slot], NONE)
        todo = np.flatnonzero((found != keys) & (found != -1))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            found = self.keys[slot[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.ranks[slot[todo[hit]]]
            todo = todo[~hit & (found != -1)]
        return out

    def as_dict(self) -> dict[int, int]:
        used = self.keys != -1
        return dict(zip(self.keys[used].tolist(), self.ranks[used].tolist(), strict=True))


class Vocabulary:
    """First symbols of bytes, mergeable pairs, and the bytes of every token."""

    def __init__(self, first: np.ndarray, last: np.ndarray, table: PairTable, tokens: list[bytes], whole: dict[bytes, int]):
        self.first, self.last, self.table, self.tokens, self.whole = first, last, table, tokens, whole
        self.memory = Memory()
        self.pairs: dict[int, int] | None = None
        self.layered = True

    def parts(self) -> dict:
        """Plain data to broadcast; `on_worker` makes a vocabulary of it again."""
        table = self.table
        return {
            "arrays": (self.first, self.last, table.keys, table.ranks, table.product),
            "tokens": self.tokens,
            "whole": self.whole,
            "layered": self.layered,
        }

    def symbols(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """First symbols of all words in a row, and the length of each."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.first[raw]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[raw[ends]]
        return symbols, lengths


def on_worker(parts: dict) -> Vocabulary:
    """The vocabulary of broadcast parts, made once per worker process and kept there
    with its word cache, as the broadcast value itself is."""
    if "made" not in parts:
        first, last, keys, ranks, product = parts["arrays"]
        table = PairTable.__new__(PairTable)
        table.mask, table.keys, table.ranks, table.product = len(keys) - 1, keys, ranks, product
        made = Vocabulary(first, last, table, parts["tokens"], parts["whole"])
        made.layered = parts["layered"]
        parts["made"] = made
    return parts["made"]


def load_ranks(path: str) -> Vocabulary:
    """A rank file: two tokens merge if their joined bytes are a token, lowest rank first."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    left, right, rank = [], [], []
    for token, own in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                left.append(a), right.append(b), rank.append(own)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, own in ranks.items():
        tokens[own] = token
    first = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
    table = PairTable(np.array(left), np.array(right), np.array(rank, np.int32), np.arange(len(tokens)))
    return Vocabulary(first, first, table, tokens, ranks)


def load_merges(path: str) -> Vocabulary:
    """A .json vocabulary with its list of merges, rank by rank."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    ids, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    left, right = (np.array([ids[m[side]] for m in merges]) for side in (0, 1))
    product = np.array([ids[a + b] for a, b in merges])
    letters = byte_letters()
    first, last = np.zeros(256, np.int32), np.zeros(256, np.int32)
    for letter, byte in letters.items():
        first[byte], last[byte] = ids[letter], ids[letter + suffix]
    tokens = [b""] * (max(ids.values()) + 1)
    for token, own in ids.items():
        tokens[own] = bytes(letters[c] for c in token.removesuffix(suffix or "\n") if c in letters)
    vocabulary = Vocabulary(first, last, PairTable(left, right, np.arange(len(merges), dtype=np.int32), product), tokens, {})
    # All places of a pair may merge at once if what a merge makes only takes part in later merges.
    made = np.full(len(tokens), -1)
    made[product] = np.arange(len(merges))
    ready = np.maximum(made[left], made[right]) < np.arange(len(merges))
    vocabulary.layered = bool(ready.all()) and len(np.unique(product)) == len(product)
    return vocabulary


def merge_by_rank(vocabulary: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rank-synchronous merging of non-empty words held as one ragged array.

    In every round each word applies its lowest-ranked pair at all its places (the left
    one of two that overlap); words without a pair leave. Returns the symbols of all
    words in a row and their number per word.
    """
    table = vocabulary.table
    symbols, lengths = vocabulary.symbols(words)
    counts, done_parts = np.zeros(len(words), np.int64), []
    order = np.arange(len(words))
    ends = np.zeros(len(symbols), bool)
    ends[np.cumsum(lengths) - 1] = True
    heads = np.roll(ends, 1)
    rank = np.full(len(symbols), NONE, np.int32)
    inner = np.flatnonzero(~ends)
    rank[inner] = table.get(symbols[inner], symbols[inner + 1])
    while len(order):
        starts = np.cumsum(lengths) - lengths
        least = np.minimum.reduceat(rank, starts)
        done = least == NONE
        if done.any():
            out = np.repeat(done, lengths)
            counts[order[done]] = lengths[done]
            done_parts.append((order[done], lengths[done], symbols[out]))
            symbols, rank, ends, heads = symbols[~out], rank[~out], ends[~out], heads[~out]
            order, lengths, least = order[~done], lengths[~done], least[~done]
            if not len(order):
                break
            starts = np.cumsum(lengths) - lengths
        at = np.flatnonzero(rank == np.repeat(least, lengths))
        if vocabulary.layered:
            index = np.arange(len(at))
            opens = np.ones(len(at), bool)
            opens[1:] = np.diff(at) != 1
            at = at[(index - np.maximum.accumulate(np.where(opens, index, 0))) % 2 == 0]
        else:
            at = at[np.searchsorted(at, starts)]
        symbols[at] = table.product[rank[at]]
        ends[at] |= ends[at + 1]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        lengths = np.add.reduceat(keep.astype(np.int64), starts)
        symbols, rank, ends, heads = symbols[keep], rank[keep], ends[keep], heads[keep]
        now = at - np.arange(len(at))
        touched = np.concatenate([now, now[~heads[now]] - 1])
        rank[touched] = NONE
        touched = touched[~ends[touched]]
        rank[touched] = table.get(symbols[touched], symbols[touched + 1])
    offsets = np.cumsum(counts) - counts
    ids = np.empty(int(counts.sum()), np.int32)
    for who, size, part in done_parts:
        shift = np.repeat(offsets[who] - (np.cumsum(size) - size), size)
        ids[np.arange(len(part)) + shift] = part
    return ids, counts


def _tree_class(vocabulary: Vocabulary, words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment trees of one width for many words; the ids in a row, and their number per word.

    All state is flat: word r has its symbols at r * (width + 1) and its tree at
    r * 2 * width, so a position is one index.
    """
    table, rows = vocabulary.table, len(words)
    flat, lengths = vocabulary.symbols(words)
    mine = np.repeat(np.arange(rows), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    step, far = width + 1, np.iinfo(np.int64).max
    symbols = np.zeros(rows * step, np.int32)
    symbols[mine * step + place] = flat
    tree = np.full((rows, 2 * width), far)
    inner = np.flatnonzero(place < lengths[mine] - 1)
    rank = table.get(flat[inner], flat[inner + 1]).astype(np.int64)
    tree[mine[inner], width + place[inner]] = np.where(rank == NONE, far, (rank << 32) | place[inner])
    level = width
    while level > 1:
        tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level //= 2
    tree = tree.ravel()
    # Position `width` stands for "none" on the left; on the right, a word's own length does.
    after = np.tile(np.arange(1, width + 2), rows)
    before = np.tile(np.arange(-1, width), rows)
    before[::step] = width
    alive = (np.arange(step) < lengths[:, None]).ravel()

    def climb(base: np.ndarray, leaf: np.ndarray) -> None:
        node = leaf >> 1
        while node[0]:
            child = base + 2 * node
            tree[base + node] = np.minimum(tree.take(child), tree.take(child + 1))
            node >>= 1

    row = np.flatnonzero(tree[1 :: 2 * width] != far)
    while len(row):
        base, at, end = row * (2 * width), row * step, lengths[row]
        top = tree.take(base + 1)
        i = top & 0xFFFFFFFF
        j = after.take(at + i)
        k = after.take(at + j)
        h = before.take(at + i)
        made = table.product.take(top >> 32)
        symbols[at + i] = made
        alive[at + j] = False
        after[at + i] = k
        before[at + k] = i
        tree[base + width + j] = far
        right = np.flatnonzero(k < end)
        left = np.flatnonzero(h < width)
        got = table.get(
            np.concatenate([made[right], symbols[at[left] + h[left]]]),
            np.concatenate([symbols[at[right] + k[right]], made[left]]),
        ).astype(np.int64)
        start = np.concatenate([i[right], h[left]])
        value = np.where(got == NONE, far, (got << 32) | start)
        tree[base + width + i] = far
        tree[base[right] + width + i[right]] = value[: len(right)]
        tree[base[left] + width + h[left]] = value[len(right) :]
        climb(base, width + j)
        climb(base, width + i)
        if len(left):
            climb(base[left], width + h[left])
        row = row[tree.take(base + 1) != far]
    return symbols[alive], alive.reshape(rows, step).sum(axis=1)


def _tree_one(vocabulary: Vocabulary, word: bytes) -> np.ndarray:
    """The same tree for one long word, in plain lists."""
    if vocabulary.pairs is None:
        vocabulary.pairs = vocabulary.table.as_dict()
    pairs, product = vocabulary.pairs, vocabulary.table.product
    symbols = vocabulary.symbols([word])[0].tolist()
    n, far = len(symbols), 1 << 62
    width = 1 << max(0, n - 1).bit_length()
    after, before = list(range(1, n + 1)), list(range(-1, n))

    def leaf(a: int, b: int) -> int:
        rank = pairs.get((symbols[a] << 32) | symbols[b]) if a >= 0 and b < n else None
        return far if rank is None else (rank << 32) | a

    tree = [far] * (2 * width)
    tree[width : width + n - 1] = [leaf(a, a + 1) for a in range(n - 1)]
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    while tree[1] != far:
        rank, i = tree[1] >> 32, tree[1] & 0xFFFFFFFF
        j = after[i]
        k = after[j] if j < n else n
        symbols[i], symbols[j] = int(product[rank]), -1
        after[i] = k
        if k < n:
            before[k] = i
        for place, new in ((j, far), (i, leaf(i, k)), (before[i], leaf(before[i], i))):
            if place < 0:
                continue
            node = place + width
            tree[node] = new
            node >>= 1
            while node:
                small = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == small:
                    break
                tree[node] = small
                node >>= 1
    return np.array([s for s in symbols if s >= 0], np.int32)


def merge_by_tree(vocabulary: Vocabulary, words: list[bytes]) -> list[bytes]:
    """Merge each non-empty word through a segment tree over its byte positions.

    A leaf holds the rank of the pair that starts there, with its position; the root is
    the leftmost lowest pair. A merge changes the leaves of the pair and of its live
    neighbours and renews their paths to the root. Words of about one length run side by
    side; words of over SCALAR_BYTES bytes run alone. Returns each word's ids as
    little-endian unsigned 32-bit integers.
    """
    out: list[bytes] = [b""] * len(words)
    classes: dict[int, list[int]] = {}
    for index, word in enumerate(words):
        whole = vocabulary.whole.get(word)
        if whole is not None:
            out[index] = whole.to_bytes(4, "little")
        elif len(word) > SCALAR_BYTES:
            out[index] = _tree_one(vocabulary, word).astype("<u4").tobytes()
        else:
            classes.setdefault(1 << max(1, (len(word) - 1).bit_length()), []).append(index)
    for width, members in classes.items():
        for begin in range(0, len(members), step := max(1, (1 << 19) // width)):
            part = members[begin : begin + step]
            ids, counts = _tree_class(vocabulary, [words[i] for i in part], width)
            for index, value in zip(part, cut_ids(ids, counts), strict=True):
                out[index] = value
    return out


def cut_ids(ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The ids of each word, from those of all words in a row, as bytes."""
    raw, ends = ids.astype("<u4").tobytes(), (np.cumsum(counts) * 4).tolist()
    return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


class Memory(dict):
    """Numbers words in the order of their first sight, and keeps a value for each."""

    LIMIT = 700_000  # words; more than that, and all are forgotten after the call

    def __init__(self) -> None:
        self.new: list = []
        self.values_of: list = []

    def __missing__(self, word) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number

    def recall(self, lists: Iterable[Iterable], encode: Callable[[list], Iterable]) -> list[Iterable]:
        """The values of the words of each list; words not seen before are encoded together."""
        numbers = [list(map(self.__getitem__, words)) for words in lists]
        if self.new:
            self.values_of.extend(encode(self.new))
            self.new = []
        values = self.values_of
        out = [map(values.__getitem__, row) for row in numbers]
        if len(self) > self.LIMIT:
            self.clear()
            self.values_of = []
        return out


def encoded_bytes(words: list[str]) -> list[bytes]:
    return list(map(str.encode, words, repeat("utf-8")))
