"""SimHash near-duplicates through a Gray-order hierarchical index."""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronogrid.llm.components import components
from chronogrid.llm.kernels import Forest, by_groups, free_name, prepare, split_buckets, split_large, stored, text_udf

SEED = 42
FAN = 8  # children of an index node
BLOCKS = 5  # parts of a fingerprint; near ones agree in all but `distance` of them
BUCKET_ROWS = 4096  # larger buckets are cut into chunks that meet two by two
FRONTIER = 1 << 20  # (query, node) pairs held at a time

# Near copies by exact Jaccard similarity. Bits of the fingerprints of two texts at 0.8 differ
# with a probability of 0.152, in 9.7 of 64 with a deviation of 2.9.
WORDS = 5
PERCENT = 80  # least similarity
FIELDS = 16  # 64-bit words of a wide fingerprint
# Two texts at 0.8 agree on all bits of a key, and are within NEAR bits in the word searched
# with it, in one of the tables with probability 0.9995 (0.998 if sums are often tied, as in
# sets of 12 and 15).
KEY_BITS = 14
TABLES = 64 * FIELDS // KEY_BITS
NEAR = 16
# Of sets this small, bits differ with a probability of up to 0.19, since sums are often
# tied; they come in twice as many tables.
SHORT = 5
# Differing bits of wide fingerprints, and of those of small sets; five deviations more than the
# expected.
WIDE_BITS, SHORT_BITS = 212, 255
BLOCK_WORDS = 1 << 18  # words of wide fingerprints that are compared at a time
DISTANCE = 24  # differing bits of the first word, five deviations more than the expected
VERIFY_ROWS = 512  # texts of a chunk in which similarities are counted


def fingerprint(text: str, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text's word shingles, as a signed integer.

    Words are runs of other than ASCII white space, A-Z in lower case. A text of fewer
    words is one shingle; one without words has fingerprint zero.
    """
    return _sign_bits(shingle_hashes(text, shingle))


def shingle_hashes(text: str, shingle: int) -> np.ndarray:
    """The 64-bit hash of each word shingle of a text, repeated ones included."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    spans = zip(starts[:n].tolist(), ends[len(words) - n :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")


def _sign_bits(hashes: np.ndarray) -> int:
    n = len(hashes)
    if not n:
        return 0
    counts = np.zeros(64, np.int64)
    for begin in range(0, n, 1 << 14):
        bits = np.unpackbits(hashes[begin : begin + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    packed = np.packbits(2 * counts > n, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fp) for every row of `docs`; `fp` is a signed 64-bit integer."""
    prepare(docs.sparkSession)

    def kernel(texts: list[str]) -> dict:
        return {"fp": [fingerprint(text, shingle) for text in texts]}

    made = text_udf(kernel, "fp long")(F.col(text_col))
    return docs.select(F.col(id_col).alias("_id"), made.alias("_made")).select(
        F.col("_id").alias(id_col), F.col("_made.fp").alias("fp")
    )


def band_masks(distance: int, blocks: int = BLOCKS) -> list[int]:
    """Bit masks such that two words within `distance` bits agree on one of them whole."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    masks = [sum(chosen) for chosen in combinations(parts, blocks - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def bands(classes: DataFrame, distance: int) -> DataFrame:
    """`classes` once for each mask, with the bucket of the bits under the mask."""
    keys = [F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m).cast("long"))) for i, m in enumerate(band_masks(distance))]
    return classes.withColumn("bucket", F.explode(F.array(*keys)))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray order (prefix exclusive-or of its bits)."""
    rank = codes.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Hierarchical index of sorted groups of codes.

    Codes are sorted by group and Gray rank. A node stands for up to FAN nodes below it
    within one group; its mask holds the bits on which all its codes agree, and its
    pattern these bits. The nodes of the top level are the groups.
    """

    def __init__(self, groups: np.ndarray, codes: np.ndarray):
        self.order = np.lexsort((gray_rank(codes), groups))
        self.codes, groups = codes[self.order].astype(np.uint64), groups[self.order]
        heads = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
        size = np.diff(np.concatenate([heads, [len(groups)]]))
        # Of each level from the leaves up: pattern, mask, first child, end of children, first and last leaf.
        n = len(self.codes)
        full = np.full(n, np.uint64(0xFFFFFFFFFFFFFFFF))
        leaf = np.arange(n)
        self.levels = [(self.codes, full, leaf, leaf + 1, leaf, leaf + 1)]
        self.group = np.repeat(np.arange(len(size)), size)
        while (size > 1).any():
            pattern, mask, _, _, low, high = self.levels[-1]
            above = -(-size // FAN)
            starts = np.cumsum(size) - size
            inside = np.arange(int(above.sum())) - np.repeat(np.cumsum(above) - above, above)
            first = np.repeat(starts, above) + inside * FAN
            end = np.minimum(first + FAN, np.repeat(starts + size, above))
            lead = np.repeat(pattern[first], end - first)
            differ = np.bitwise_or.reduceat((lead ^ pattern) | ~mask, first)
            self.levels.append((pattern[first] & ~differ, ~differ, first, end, low[first], high[end - 1]))
            size = above

    def join_near(self, distance: int) -> Forest:
        """Link all codes of a group within `distance` bits; positions are those of `codes`."""
        forest = Forest(len(self.codes))
        # Codes under a node whose free bits are few are all near each other.
        for pattern, mask, first, end, low, high in self.levels[1:]:
            tight = np.flatnonzero(np.bitwise_count(~mask) <= distance)
            if len(tight):
                forest.join(*_spread(low[tight], low[tight], high[tight]))
        for query, low, high in self._search(distance):
            forest.join(query, high - 1)
            loose = high - low > 1  # all under the node are near the query, hence one component with it
            if loose.any():
                self._gather(query[loose], low[loose], (high - low)[loose], forest)
        return forest

    def company(self, distance: int) -> np.ndarray:
        """Whether each code has another one of its group within `distance` bits."""
        met = np.zeros(len(self.codes), bool)
        for step in range(1, min(FAN, len(met) - 1) + 1):  # neighbours in Gray order
            near = np.bitwise_count(self.codes[step:] ^ self.codes[:-step]) <= distance
            near &= self.group[step:] == self.group[:-step]
            met[step:] |= near
            met[:-step] |= near
        for query, low, high in self._search(distance, met.copy()):
            met[query] = True
            met[_spread(query, low, high)[0]] = True
        return met

    def _search(self, distance: int, met: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Walk the frontier of (query, node) down, adding up differing bits on the way.

        A node is left out with its whole group of codes once the differences under its
        mask exceed `distance`, and taken whole once they and its free bits do not; then
        the query and the first and last leaf are given. Left out are also pairs of codes
        that are all marked in `met`.
        """
        settled = None
        if met is not None:
            done = np.concatenate([[0], np.cumsum(met)])
            settled = [done[level[5]] - done[level[4]] == level[5] - level[4] for level in self.levels]
        step = max(1, FRONTIER // (FAN * FAN))
        for begin in range(0, len(self.codes), step):
            query = np.arange(begin, min(begin + step, len(self.codes)))
            stack = [(len(self.levels) - 1, query, self.group[query])]
            while stack:
                level, query, node = stack.pop()
                pattern, mask, first, end, low, high = self.levels[level]
                if len(query) > FRONTIER:
                    half = len(query) // 2
                    stack += [(level, query[:half], node[:half]), (level, query[half:], node[half:])]
                    continue
                ahead = high[node] > query + 1  # pairs are met from their first code
                if settled is not None:
                    ahead &= ~(met[query] & settled[level][node])
                query, node = query[ahead], node[ahead]
                apart = np.bitwise_count((self.codes[query] ^ pattern[node]) & mask[node]).astype(np.int64)
                ahead = apart <= distance
                query, node, apart = query[ahead], node[ahead], apart[ahead]
                whole = apart + np.bitwise_count(~mask[node]) <= distance
                if whole.any():
                    yield query[whole], low[node[whole]], high[node[whole]]
                query, node = query[~whole], node[~whole]
                if level and len(query):
                    size = end[node] - first[node]
                    child = np.arange(int(size.sum())) + np.repeat(first[node] - (np.cumsum(size) - size), size)
                    stack.append((level - 1, np.repeat(query, size), child))

    @staticmethod
    def _gather(query: np.ndarray, low: np.ndarray, size: np.ndarray, forest: Forest) -> None:
        """Link queries with every code of the nodes taken whole, each node once."""
        low, index = np.unique(low, return_index=True)
        size, query = size[index], query[index]
        forest.join(*_spread(query, low, low + size))


def _spread(query: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions from `low` to `high`, each with its query."""
    size = high - low
    return np.arange(int(size.sum())) + np.repeat(low - (np.cumsum(size) - size), size), np.repeat(query, size)


def _near_links(distance: int):
    def work(table: pa.Table) -> pa.Table:
        codes = table.column("fp").to_numpy().view(np.uint64)
        names = table.column("first_doc").to_numpy()
        index = GrayIndex(table.column("part").to_numpy(), codes)
        root = index.join_near(distance).root
        linked = np.flatnonzero(root != np.arange(len(root)))
        names = names[index.order]
        return pa.table({"a": pa.array(names[linked], pa.int64()), "b": pa.array(names[root[linked]], pa.int64())})

    return work


def near_duplicates(
    docs: DataFrame, distance: int = 3, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Group documents whose fingerprints are linked at `distance` or fewer bits.

    Returns (id_col, fp, fingerprint, component_id), one row per input row;
    `fingerprint` is `fp` as 16 hexadecimal digits and `component_id` the smallest
    document id that links reach, the row's own included.

    Equal fingerprints are merged before anything else, so copies cost one row each.
    Different ones meet in a bucket of bits on which they agree exactly (pigeonhole over
    BLOCKS parts), where a Gray-order index finds all links; a bucket sends on a tree
    of links, never its pairs.

    A NULL or empty text has fingerprint zero and is linked like any other; repeated
    rows stay; ids may be of any integer type; a NULL id gets its class's component but
    does not name or bridge one; other columns are ignored whatever their names; an
    empty table gives an empty result.
    """
    made = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    classes = made.groupBy("fp").agg(F.min(F.col(id_col).cast("long")).alias("first_doc")).where("first_doc IS NOT NULL")
    met = split_buckets(bands(classes, distance), "bucket", "fp", BUCKET_ROWS)
    links = by_groups(met.select("part", "fp", "first_doc"), _near_links(distance), "a long, b long")
    found = components(links)
    of_class = classes.join(found, classes.first_doc == found.node, "left").select(
        "fp", F.coalesce("component", "first_doc").alias("component_id")
    )
    return made.join(of_class, "fp", "left").select(id_col, "fp", hex_digits("fp").alias("fingerprint"), "component_id")


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """The SimHash of FIELDS * 64 bits of shingles' hashes, as FIELDS words.

    The first word is that of the hashes themselves, the others those of FIELDS - 1
    further hashes made from them.
    """
    rng = np.random.default_rng(SEED)
    turn, factor = rng.integers(0, 1 << 63, (2, FIELDS - 1), np.uint64)
    counts = np.zeros(64 * FIELDS, np.int64)
    for begin in range(0, len(hashes), 255):  # so that a count fits in a byte
        plain = hashes[begin : begin + 255, None]
        made = (plain ^ turn) * (factor | np.uint64(1))
        made = (made ^ (made >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        made = np.concatenate([plain, made ^ (made >> np.uint64(32))], axis=1)
        bits = np.unpackbits(made.view(np.uint8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)


def _keys(wide: np.ndarray, tables: int, turned: bool) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and searched word of each row of `wide` in each table, as (rows, tables).

    A table's key is KEY_BITS bits of the fingerprint that no other table has; the word
    searched with it holds none of them. `turned` gives other tables, over the same bits
    in another order.
    """
    bits = np.unpackbits(wide.view(np.uint8), axis=1, bitorder="little")
    if turned:
        bits = bits[:, np.random.default_rng(SEED).permutation(64 * FIELDS)]
    value = bits[:, : tables * KEY_BITS].reshape(len(wide), tables, KEY_BITS) @ (1 << np.arange(KEY_BITS))
    table = np.arange(tables)
    bucket = (table + tables * turned << KEY_BITS) + value
    return bucket.astype(np.int32), wide[:, (table * KEY_BITS // 64 + FIELDS // 2) % FIELDS]


def _keyed(tables: int):
    """Rows of `wide` once for each table, with their bucket and the word searched there."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wide = np.frombuffer(b"".join(batch.column("wide").to_pylist()), np.uint64).reshape(-1, FIELDS)
            names, size = batch.column("first_doc").to_numpy(), batch.column("size").to_numpy()
            for turned, rows in ((False, np.arange(len(wide))), (True, np.flatnonzero(size <= SHORT))):
                if len(rows) and tables:
                    bucket, code = _keys(wide[rows], tables, turned)
                    cells = [bucket.ravel(), code.ravel().view(np.int64), np.repeat(names[rows], tables)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], ["bucket", "fp", "first_doc"])

    return work


def _shingle_sets(docs: DataFrame, text_col: str, shingle: int) -> Column:
    """Struct of a text's set of shingles as one hash, the set's size, its fingerprint and its
    wide fingerprint."""
    prepare(docs.sparkSession)

    def kernel(texts: list[str]) -> dict:
        sets = [np.unique(shingle_hashes(text, shingle)) for text in texts]
        wide = [wide_fingerprint(s) for s in sets]
        return {
            "shingles": [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) for s in sets],
            "size": [len(s) for s in sets],
            "fp": [int(one[0].view(np.int64)) for one in wide],
            "wide": [one.tobytes() for one in wide],
        }

    return text_udf(kernel, "shingles long, size int, fp long, wide binary")(F.col(text_col))


def _possible(distance: int):
    """Rows of whole buckets that have another one within `distance` bits, by Gray index."""

    def work(table: pa.Table) -> pa.Table:
        codes = table.column("fp").to_numpy().view(np.uint64)
        index = GrayIndex(table.column("part").to_numpy(), codes)
        met = index.order[index.company(distance)]
        return table.select(["part", "first_doc"]).take(pa.array(np.sort(met)))

    return work


def _alike(percent: int):
    """Trees of links between the rows of each bucket whose wide fingerprints are similar enough."""

    def near(size: np.ndarray, marks: np.ndarray, block: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        apart = np.bitwise_count(marks[block][:, None] ^ marks[others]).sum(axis=2, dtype=np.int64)
        low, high = np.minimum(size[block][:, None], size[others]), np.maximum(size[block][:, None], size[others])
        i, j = np.nonzero((apart <= np.where(low <= SHORT, SHORT_BITS, WIDE_BITS)) & (100 * low >= percent * high))
        return block[i], others[j]

    def group(size: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """The first row that links reach; every pair is either compared or already linked."""
        forest = Forest(len(size))
        ahead, waiting = np.zeros(0, np.int64), np.arange(len(size))
        while len(waiting):
            many = max(1, BLOCK_WORDS // (FIELDS * len(waiting)))
            if len(ahead):
                block, ahead = ahead[:many], ahead[many:]
            else:
                block, waiting = waiting[:many], waiting[many:]
                forest.join(*near(size, marks, block, block))
            one, other = near(size, marks, block, waiting)
            forest.join(one, other)
            found = np.isin(waiting, other)
            ahead, waiting = np.concatenate([ahead, waiting[found]]), waiting[~found]
        return forest.root

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("first_doc", "ascending")])  # all tables give the same links
        part, names = table.column("part").to_numpy(), table.column("first_doc").to_numpy()
        size = table.column("size").to_numpy().astype(np.int64)
        marks = np.frombuffer(b"".join(table.column("wide").to_pylist()), np.uint64).reshape(-1, FIELDS)
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
        root = np.concatenate([a + group(size[a:b], marks[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)])
        linked = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": pa.array(names[linked]), "b": pa.array(names[root[linked]])})

    return work


def _similar_links(percent: int, shingle: int, distance: int):
    """Trees of links between the texts of each group that are similar enough.

    Every pair of a group is either counted or already linked; left out before counting
    are pairs whose sizes or fingerprints are too far apart.
    """

    def group(names: np.ndarray, codes: np.ndarray, texts: list[str]) -> list[tuple[int, int]]:
        sets = [np.unique(shingle_hashes(text, shingle)) for text in texts]
        size = np.array([len(s) for s in sets])
        out, waiting = [], np.arange(len(sets))
        while len(waiting):
            ahead, waiting = [int(waiting[0])], waiting[1:]
            while ahead and len(waiting):
                at = ahead.pop()
                near = np.bitwise_count(codes[waiting] ^ codes[at]) <= distance
                near &= 100 * np.minimum(size[waiting], size[at]) >= percent * np.maximum(size[waiting], size[at])
                near &= (size[waiting] > 0) & (size[at] > 0)
                near = np.flatnonzero(near)
                if not len(near):
                    continue
                others = waiting[near]
                shared = np.isin(np.concatenate([sets[i] for i in others]), sets[at])
                both = np.add.reduceat(shared, np.cumsum(size[others]) - size[others], dtype=np.int64)
                like = 100 * both >= percent * (size[others] + size[at] - both)
                out += [(int(names[at]), int(names[i])) for i in others[like]]
                ahead += others[like].tolist()
                waiting = np.delete(waiting, near[like])
        return out

    def work(table: pa.Table) -> pa.Table:
        part = table.column("part").to_numpy()
        names, codes = table.column("shingles").to_numpy(), table.column("fp").to_numpy().view(np.uint64)
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
        links = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            texts = [text or "" for text in table.column("text").slice(a, b - a).to_pylist()]
            links += group(names[a:b], codes[a:b], texts)
        return pa.table({"a": pa.array([k[0] for k in links], pa.int64()), "b": pa.array([k[1] for k in links], pa.int64())})

    return work


def first_of_copies(
    docs: DataFrame, percent: int = PERCENT, shingle: int = WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The row with the smallest id of each group of near copies, all columns kept.

    Two texts are near copies if the Jaccard similarity of their sets of word shingles
    (as 64-bit hashes) is `percent` or more; groups are what such pairs link.

    Equal sets are merged before anything else, so copies cost one row each. Different
    ones get a SimHash of FIELDS * 64 bits. They meet in buckets of KEY_BITS of its bits, where a
    Gray-order index finds those that are within NEAR bits of each other in another of its
    words. Only these send the whole of it to the bucket, and only where these are similar too
    (see WIDE_BITS; a pair at the threshold passes but for one in 10^6) are texts looked at:
    each text of what such pairs connect once (groups over VERIFY_ROWS are cut into chunks that
    meet two by two). There similarities are counted exactly, and only trees of similar pairs are
    sent on. So texts that merely share a template do not pull each other in. A bucket holds
    one in 2^KEY_BITS of unrelated sets, so the search in it grows faster than the input from
    some 10^7 texts on.

    NULL, empty and blank texts have no shingles and are copies of each other; very long
    texts are read whole; of rows with one id each group keeps its own, the one of the
    smallest hash of all columns (of any type). Rows without an id cannot be named as the
    one that stays; they all go on. An empty table gives an empty result.
    """
    made, row = free_name(docs, "made"), free_name(docs, "row")
    cells = [F.col(f"`{f.name}`") for f in docs.schema]
    cells = [c.cast("string") if "map<" in f.dataType.simpleString() else c for c, f in zip(cells, docs.schema, strict=True)]
    marked = docs.where(F.col(id_col).isNotNull()).withColumn(row, F.xxhash64(*cells))
    marked = stored(marked.withColumn(made, _shingle_sets(docs, text_col, shingle)), "shingle-sets")
    rows = marked.select(F.col(id_col).alias("id"), F.col(row).alias("row"), f"{made}.*")
    facts = [F.first(c).alias(c) for c in ("fp", "size", "wide")]
    classes = rows.groupBy("shingles").agg(F.min(F.struct("id", "row")).alias("first"), *facts)
    classes = stored(classes, "shingle-classes")
    marks = classes.select(F.col("shingles").alias("first_doc"), "size", "wide").where("size > 0")
    keyed = marks.mapInArrow(_keyed(TABLES), "bucket int, fp long, first_doc long")
    met = split_large(keyed, "bucket", "first_doc", BUCKET_ROWS)
    possible = by_groups(met.select("part", "fp", "first_doc"), _possible(NEAR), "part long, first_doc long")
    links = by_groups(possible.join(marks, "first_doc"), _alike(percent), "a long, b long")
    together = components(links)
    met = split_buckets(together, "component", "node", VERIFY_ROWS).select("part", "node")
    chosen = classes.join(met, F.col("shingles") == F.col("node"))
    chosen = chosen.select("part", "shingles", "fp", F.col("first.id").alias("id"), F.col("first.row").alias("row"))
    chosen = stored(chosen, "verified-groups")
    whole = marked.select(F.col(id_col).alias("id"), F.col(row).alias("row"), F.col(text_col).alias("text"))
    met = whole.join(chosen, ["id", "row"]).dropDuplicates(["id", "row", "shingles", "part"])  # equal rows of one id
    work = _similar_links(percent, shingle, DISTANCE)
    found = components(by_groups(met.select("part", "shingles", "fp", "text"), work, "a long, b long", VERIFY_ROWS))
    group = F.coalesce("component", "shingles")
    first = classes.join(found, F.col("shingles") == F.col("node"), "left").groupBy(group).agg(F.min("first").alias("first"))
    first = first.select(F.col("first.id").alias(id_col), F.col("first.row").alias(row))
    kept = marked.join(first, [id_col, row], "left_semi").dropDuplicates([id_col, row])
    return kept.select(*(f"`{c}`" for c in docs.columns)).unionByName(docs.where(F.col(id_col).isNull()))


def hex_digits(column: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(column)), 16, "0"))
