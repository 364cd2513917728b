"""Running text kernels inside Spark tasks, and the hot-bucket split of pair searches."""

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from chronogrid.session import configure, hand_back, materialise

# Bytes of text that a kernel holds as Python objects at a time, and rows that Spark
# hands over at a time.
SLICE_BYTES = 4 << 20
BATCH_ROWS = 1024


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of this folder: small Arrow batches, since rows are whole texts.

    Also gives back what Arrow keeps of tables that a training step on the driver has freed,
    and what earlier steps have left on the driver's heap.
    """
    pa.default_memory_pool().release_unused()
    hand_back(spark)
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def stored(df: DataFrame, label: str) -> DataFrame:
    """`materialise`, after which the driver drops what the step has left."""
    done = materialise(df, label)
    hand_back(df.sparkSession)
    return done


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[list[str]]:
    """Cut a batch into lists of about `limit` characters; NULL becomes the empty text."""
    held, size = [], 0
    for value in texts:
        text = value.as_py() or ""
        held.append(text)
        size += len(text)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def text_udf(kernel: Callable[[list[str]], dict], schema: str) -> Callable[[Column], Column]:
    """An Arrow function of a text column that returns one struct per row.

    `kernel` takes a list of texts and returns a dict of equally long columns.
    """
    fields = StructType.fromDDL(schema)
    types = [(f.name, to_arrow_type(f.dataType)) for f in fields]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            # Kernels make many small objects and no cycles, so a collector would only look
            # through the same words again and again.
            gc.disable()
            try:
                parts = [kernel(texts) for texts in slices(batch)]
            finally:
                gc.enable()
            columns = [pa.chunked_array([pa.array(p[n], t) for p in parts], t).combine_chunks() for n, t in types]
            yield pa.StructArray.from_arrays(
                [c if isinstance(c, pa.Array) else pa.concat_arrays(c.chunks) for c in columns],
                fields=[pa.field(n, t) for n, t in types],
            )

    return F.arrow_udf(run, fields)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that `df` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while stem in taken:
        stem += "_"
    return stem


def text_rows(docs: DataFrame, kernel: Callable[[list[str]], dict], schema: str, id_col: str, text_col: str) -> DataFrame:
    """(id_col, the columns of `schema`) for every row of `docs`."""
    made = docs.select(F.col(id_col).alias("_id"), text_udf(kernel, schema)(F.col(text_col)).alias("_made"))
    names = StructType.fromDDL(schema).names
    return made.select(F.col("_id").alias(id_col), *(F.col("_made")[n].alias(n) for n in names))


def split_buckets(rows: DataFrame, key: str, item: str, limit: int) -> DataFrame:
    """Give every row its search group, cutting buckets that are larger than `limit`.

    Adds `part` (the group), `slot` (the row's chunk in its bucket), `low` and `high`
    (the two chunks that the group holds). A bucket of up to `limit` rows is one group.
    A larger one is cut into chunks by the hash of `item`, and each two chunks meet in
    a group of their own, so every pair of the bucket meets and no task holds more than
    about two chunks. Buckets of one row meet nothing and are left out.
    """
    sizes = rows.groupBy(key).agg(F.count("*").alias("_size")).where("_size > 1")
    chunks = F.ceil(F.col("_size") / limit).cast("int")
    met = rows.join(sizes, key).withColumn("_chunks", chunks)
    met = met.withColumn("slot", F.pmod(F.xxhash64(F.lit("slot"), item), F.col("_chunks")).cast("int"))
    met = met.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    met = met.withColumn("low", F.least("slot", "_other")).withColumn("high", F.greatest("slot", "_other"))
    part = F.xxhash64(F.col(key), F.col("low"), F.col("high"))
    return met.withColumn("part", part).drop("_size", "_chunks", "_other")


def split_large(rows: DataFrame, key: str, item: str, limit: int) -> DataFrame:
    """The same for keys of at most 24 bits, of which most have no more than `limit` rows.

    Only the sizes of larger buckets are kept and sent to all tasks, so rows move once, to
    their group; buckets of one row stay. Adds `part` alone.
    """
    sizes = rows.groupBy(key).agg(F.count("*").alias("_size")).where(F.col("_size") > limit)
    chunks = F.coalesce(F.ceil(F.col("_size") / limit), F.lit(1)).cast("int")
    met = rows.join(F.broadcast(sizes), key, "left").withColumn("_chunks", chunks)
    met = met.withColumn("_slot", F.pmod(F.xxhash64(F.lit("slot"), item), F.col("_chunks")).cast("int"))
    met = met.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    low, high = (f("_slot", "_other").cast("long") for f in (F.least, F.greatest))
    part = F.shiftleft(high, 44) + F.shiftleft(low, 24) + F.col(key)
    return met.withColumn("part", part).drop("_size", "_chunks", "_slot", "_other")


def whole_groups(batches: Iterator[pa.RecordBatch], key: str = "part", rows: int = 16384) -> Iterator[pa.Table]:
    """Tables that end at a change of `key`, from batches sorted by it.

    A table gathers at least `rows` rows (if there are as many) so that small groups
    are worked on together, and exceeds it by at most one group and one batch.
    """
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < rows:
            continue
        table = pa.Table.from_batches(held)
        keys = table.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], side="left"))
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
            size = table.num_rows - cut
    if held:
        yield pa.Table.from_batches(held)


def by_groups(
    rows: DataFrame, work: Callable[[pa.Table], pa.Table], schema: str | StructType, at_once: int = 16384
) -> DataFrame:
    """Run `work` over tables of whole `part` groups of `rows`, about `at_once` rows each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, rows=at_once):
            yield from work(table).to_batches()

    return rows.repartition("part").sortWithinPartitions("part").mapInArrow(run, schema)


class Forest:
    """Vectorised union-find: `join` links two arrays of positions, roots are smallest."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root[a], self.root[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            self.flatten()

    def flatten(self) -> None:
        while True:
            up = self.root[self.root]
            if np.array_equal(up, self.root):
                return
            self.root = up
