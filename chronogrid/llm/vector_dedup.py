"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations."""

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

from chronogrid.llm.components import components
from chronogrid.llm.kernels import Forest, by_groups, prepare, split_buckets
from chronogrid.session import materialise

TABLES = 10  # independent hashes; a near pair may meet in any
PARTS = 2  # cross-polytopes whose nearest vertices make one hash
PROBES = 3  # further buckets that a vector looks into, per table
NEAREST = 3  # vertices considered per cross-polytope
TURNS = 3  # sign flips and Hadamard transforms that make one rotation
BUCKET_ROWS = 1024  # larger buckets are cut into chunks that meet two by two
PAIR_BLOCK = 1 << 16  # verified pairs looked at together
SEED = 7


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the last axis, whose length is a power of two."""
    n, half = x.shape[-1], 1
    while half < n:
        pairs = x.reshape(*x.shape[:-1], n // (2 * half), 2, half)
        a, b = pairs[..., 0, :], pairs[..., 1, :]
        x = np.stack([a + b, a - b], axis=-2).reshape(x.shape)
        half *= 2
    return x / np.sqrt(n)


def normalised(vectors: np.ndarray) -> np.ndarray:
    """Rows at length one, in double precision; scaled first so that no square overflows."""
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


def buckets(unit: np.ndarray, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """Bucket codes (rows, tables, 1 + probes) of unit vectors, the home bucket first.

    A rotated vector's nearest vertices of the cross-polytope are its largest
    coordinates with their signs. Probes are the combinations of the parts' nearest
    vertices that lose least.
    """
    rows, dim = unit.shape
    width = 1 << max(1, (dim - 1).bit_length())
    wide = np.zeros((rows, width))
    wide[:, :dim] = unit
    rng = np.random.default_rng([SEED, width])
    near = min(NEAREST, width)
    choices = np.array(list(product(range(near), repeat=PARTS)))
    out = np.empty((rows, tables, 1 + probes), np.int32)
    for t in range(tables):
        codes, losses = [], []
        for _ in range(PARTS):
            turned = wide
            for _ in range(TURNS):
                turned = hadamard(turned * rng.choice([-1.0, 1.0], width))
            size = np.abs(turned)
            best = np.argsort(-size, axis=1, kind="stable")[:, :near]
            value = np.take_along_axis(turned, best, axis=1)
            codes.append(2 * best + (value < 0))
            losses.append((np.abs(value[:, :1]) - np.abs(value)) ** 2)
        loss = sum(losses[p][:, choices[:, p]] for p in range(PARTS))
        code = np.zeros((rows, len(choices)), np.int64)
        for p in range(PARTS):
            code = code * (2 * width) + codes[p][:, choices[:, p]]
        order = np.argsort(loss, axis=1, kind="stable")[:, : 1 + probes]
        out[:, t, :] = np.take_along_axis(code, order, axis=1)
    return out


def sketch(unit: np.ndarray) -> np.ndarray:
    """64 signs of random projections; the share of differing ones estimates the angle."""
    turned = unit @ np.random.default_rng([SEED, 64, unit.shape[1]]).normal(size=(unit.shape[1], 64))
    return np.packbits(turned > 0, axis=1, bitorder="little").view("<i8")[:, 0]


def sketch_distance(threshold: float) -> int:
    """Differing signs that a pair at `threshold` stays below but for one in 10^8 or so."""
    share = np.arccos(np.clip(threshold, -1, 1)) / np.pi
    return int(np.ceil(64 * share + 6.3 * np.sqrt(64 * share * (1 - share)) + 1))


def valid(column: str) -> Column:
    """True for vectors with a direction: no NULL, infinite or NaN component, not all zero."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(column, lambda x: x != 0), F.lit(False))


def _hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add `codes`, the bucket codes of every table in a row, and `sketch` to batches of classes."""
    for batch in batches:
        lists = batch.column("embedding")
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy()
        starts = np.cumsum(sizes) - sizes
        codes = np.empty((len(sizes), TABLES * (1 + PROBES)), np.int32)
        signs = np.empty(len(sizes), np.int64)
        for dim in np.unique(sizes):
            of = np.flatnonzero(sizes == dim)
            vectors = flat[starts[of][:, None] + np.arange(dim)]
            unit = normalised(vectors)
            codes[of] = buckets(unit).reshape(len(of), -1)
            signs[of] = sketch(unit)
        column = pa.ListArray.from_arrays(np.arange(len(sizes) + 1, dtype=np.int32) * codes.shape[1], codes.ravel())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, column, pa.array(signs)], [*batch.schema.names, "codes", "sketch"]
        )


def _owned(i: np.ndarray, j: np.ndarray, t: np.ndarray, codes: np.ndarray, home: np.ndarray, rep: np.ndarray) -> np.ndarray:
    """Which pairs found in a bucket of table `t` are met here first of all their buckets.

    Of several tables the first counts. Within a table two vectors with one home meet
    there; two that look into each other's homes meet in the home of the smaller id.
    """
    a, b = codes[i], codes[j]  # (pairs, tables, 1 + probes)
    same = a[:, :, 0] == b[:, :, 0]
    into_b = (a[:, :, 1:] == b[:, :, :1]).any(axis=2)
    into_a = (b[:, :, 1:] == a[:, :, :1]).any(axis=2)
    first = (same | into_a | into_b).argmax(axis=1) == t
    at = np.arange(len(i)), t
    both = into_a[at] & into_b[at]
    smaller = np.where(rep[i] < rep[j], home[i], home[j])
    return first & np.where(same[at], home[i] & home[j], home[i] ^ home[j]) & (~both | smaller)


def _screen(distance: int):
    """Rows of whole buckets that have a possible partner there, judged by sketches.

    Rows of one bucket lie side by side, so all buckets of a table are gone through
    together: every row is compared with the one d places on, for d = 1, 2, ... as long
    as buckets are that large.
    """

    def work(table: pa.Table) -> pa.Table:
        part, t, signs = (table.column(c).to_numpy() for c in ("part", "t", "sketch"))
        home = table.column("home").to_numpy(zero_copy_only=False).astype(bool)
        slot, low, high = (table.column(c).to_numpy() for c in ("slot", "low", "high"))
        edges = np.flatnonzero(np.concatenate([part[1:] != part[:-1], [True]]))
        left = edges[np.searchsorted(edges, np.arange(len(part)))] - np.arange(len(part))
        possible = np.zeros(len(part), bool)
        at, d = np.flatnonzero(left >= 1), 1
        while len(at):
            to = at + d
            near = np.bitwise_count((signs[at] ^ signs[to]).view(np.uint64)) <= distance
            near &= (home[at] | home[to]) & (t[at] == t[to]) & ((low[at] == high[at]) | (slot[at] != slot[to]))
            possible[at[near]] = possible[to[near]] = True
            d += 1
            at = at[left[at] >= d]
        return table.filter(pa.array(possible)).drop_columns(["sketch"])

    return work


def _verify(threshold: float):
    """Work on whole buckets: verified links counted where they are met first, and a
    forest of them. Sends one row per vector with links, never its pairs."""

    def work(table: pa.Table) -> pa.Table:
        rep, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
        part, t = table.column("part").to_numpy(), table.column("t").to_numpy()
        home = table.column("home").to_numpy(zero_copy_only=False).astype(bool)
        slot, low, high = (table.column(c).to_numpy() for c in ("slot", "low", "high"))
        codes = table.column("codes").combine_chunks().flatten().to_numpy().reshape(len(rep), TABLES, 1 + PROBES)
        lists = table.column("embedding").combine_chunks()
        flat = lists.flatten().to_numpy()
        edges = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
        links, forest = np.zeros(len(rep), np.int64), Forest(len(rep))
        held_i, held_j, held = [], [], 0

        def settle() -> None:
            for k in range(0, held, PAIR_BLOCK):
                i, j = all_i[k : k + PAIR_BLOCK], all_j[k : k + PAIR_BLOCK]
                own = _owned(i, j, t[i], codes, home, rep)
                i, j = i[own], j[own]
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                forest.join(i, j)

        cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]]))
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            if end - begin < 2 or not home[begin:end].any():
                continue
            unit = normalised(flat[edges[begin] : edges[end]].reshape(end - begin, -1))
            at = np.arange(begin, end)
            inside = home[begin:end]
            for block in range(0, end - begin, 256):
                rows = slice(block, min(block + 256, end - begin))
                near = (unit[rows] @ unit.T >= threshold) & (inside[rows, None] | inside)
                near &= at[rows, None] < at
                if low[begin] != high[begin]:
                    near &= slot[at[rows], None] != slot[at]
                i, j = np.nonzero(near)
                i, j = at[rows][i], at[j]
                keep = (rep[i] != rep[j]) & (t[i] == t[j])
                held_i.append(i[keep]), held_j.append(j[keep])
                held += int(keep.sum())
                if held >= 8 * PAIR_BLOCK:
                    all_i, all_j = np.concatenate(held_i), np.concatenate(held_j)
                    settle()
                    held_i, held_j, held = [], [], 0
        if held:
            all_i, all_j = np.concatenate(held_i), np.concatenate(held_j)
            settle()
        found = np.flatnonzero(links)
        return pa.table(
            {
                "rep": pa.array(rep[found], pa.int64()),
                "root": pa.array(rep[forest.root[found]], pa.int64()),
                "links": pa.array(links[found], pa.int64()),
            }
        )

    return work


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.93,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """Link vectors of one label whose cosine is at least `threshold`.

    Returns (id_col, n_links, component_id, kept), one row per input row: the other
    vectors linked directly, the smallest id that links reach (the row's own included),
    and whether that is the row's own id.

    Equal vectors of a label are one class with a number of copies. Classes meet in the
    buckets of TABLES cross-polytope hashes, each vector in its home bucket and, as a
    probe, in PROBES neighbouring ones. Buckets first hold ids and 64-bit sketches only;
    vectors are sent after those rows that have a possible partner. The cosine of every
    such pair is computed in double precision, so no link is below the threshold. A pair
    that meets several times counts once. Large buckets are split (see `split_buckets`).

    Vectors that are NULL, empty, zero or hold a NULL or non-finite component, and those
    with a NULL label, have no links and are their own component; so are vectors of
    another length than the rest. Repeated rows count as copies of each other. Rows with
    a NULL id count as copies but name nothing: their `kept` is false. Other columns
    are ignored whatever their names; an empty table gives an empty result.
    """
    prepare(vectors.sparkSession)
    vectors.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec"), F.col(label_col).alias("kind"), F.col(vector_col).alias("embedding")
    )
    usable = rows.where(valid("embedding") & F.col("kind").isNotNull())
    key = F.xxhash64("kind", "embedding").alias("class")
    classes = usable.groupBy(key, "kind", "embedding").agg(F.min("vec").alias("rep"), F.count("*").alias("copies"))
    named = classes.where("rep IS NOT NULL")
    columns = named.select("rep", "copies", "kind", "embedding")
    schema = StructType(list(columns.schema.fields)).add("codes", ArrayType(IntegerType())).add("sketch", LongType())
    hashed = materialise(columns.mapInArrow(_hash_rows, schema), "vector-codes")
    places = F.posexplode("codes").alias("place", "code")
    met = hashed.select("rep", "sketch", "kind", F.size("embedding").alias("dim"), places)
    met = met.withColumn("t", F.floor(F.col("place") / (1 + PROBES)).cast("int"))
    met = met.withColumn("home", F.col("place") % (1 + PROBES) == 0)
    met = met.select("rep", "sketch", "t", "home", F.xxhash64("t", "kind", "dim", "code").alias("bucket"))
    names = ["part", "rep", "t", "home", "slot", "low", "high"]
    parted = split_buckets(met, "bucket", "rep", BUCKET_ROWS).select(*names, "sketch")
    kept = StructType([f for f in parted.schema.fields if f.name != "sketch"])
    possible = by_groups(parted, _screen(sketch_distance(threshold)), kept)
    work = possible.join(hashed.select("rep", "copies", "embedding", "codes"), "rep")
    found = materialise(by_groups(work, _verify(threshold), "rep long, root long, links long"), "vector-links")
    degree = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found, "rep", "root").withColumnRenamed("node", "rep")
    of_class = classes.join(degree, "rep", "left").join(joined, "rep", "left")
    of_class = of_class.select(
        "class", "kind", "embedding",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    linked = usable.withColumn("class", F.xxhash64("kind", "embedding")).join(of_class, ["class", "kind", "embedding"])
    alone = rows.where(~(valid("embedding") & F.col("kind").isNotNull()))
    every = linked.select("vec", "n_links", "component_id").unionByName(
        alone.select("vec", F.lit(0).cast("long").alias("n_links"), F.col("vec").alias("component_id"))
    )
    kept = F.coalesce(F.col("vec") == F.col("component_id"), F.lit(False))
    return every.select(F.col("vec").alias(id_col), "n_links", "component_id", kept.alias("kept"))
