"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronogrid.llm.kernels import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of `links`; the component is its smallest node.

    Links are kept as (larger, smaller). A round hangs each node's links below the
    smallest neighbour of their lower end, then below the smallest of the upper end.
    Rounds grow with the logarithm of the longest chain. Every round is written to the
    shared scratch folder, which ends its lineage; only its row count and a checksum
    reach the driver. Joins go by node, so a node with very many links is split by
    adaptive execution, and minima are merged before the shuffle. Links with a NULL end
    and links from a node to itself say nothing and are dropped.
    """
    pairs = links.select(F.greatest(a, b).alias("up"), F.least(a, b).alias("down"))
    kept = pairs.where(f"{a} IS NOT NULL AND {b} IS NOT NULL AND up > down").distinct()
    seen = None
    while True:
        kept = stored(kept, "links")
        state = kept.agg(F.count("*"), F.bit_xor(F.xxhash64("up", "down"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        kept = _upper(_lower(kept))
    roots = kept.select(F.col("down").alias("node"), F.col("down").alias("component")).distinct()
    return kept.select(F.col("up").alias("node"), F.col("down").alias("component")).unionByName(roots)


def _lowest(links: DataFrame) -> DataFrame:
    return links.groupBy(F.col("up").alias("_node")).agg(F.min("down").alias("_low"))


def _lower(links: DataFrame) -> DataFrame:
    """Replace the lower end of every link by that node's own smallest neighbour.

    Links that become equal stay; `_upper` takes minima and merges them in its own shuffle.
    """
    joined = links.join(_lowest(links), F.col("down") == F.col("_node"), "left")
    return joined.select("up", F.coalesce("_low", "down").alias("down"))


def _upper(links: DataFrame) -> DataFrame:
    """Hang every link's lower end, and its upper end, below the smallest of the upper end."""
    joined = links.join(_lowest(links), F.col("up") == F.col("_node"))
    ends = F.explode(F.array("up", "down")).alias("up")
    return joined.select(ends, F.col("_low").alias("down")).where("up > down").distinct()
