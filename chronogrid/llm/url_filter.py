"""URL rules by a sort-merge range join on reversed-host keys; DataFrame functions only."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronogrid.session import materialise

RANGES_PER_PARTITION = 2  # key ranges swept, per shuffle partition


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url column; both empty without `://`."""
    text = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + F.lit(3), F.length(text))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + F.lit(1), F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def reversed_host(labels: Column) -> Column:
    return F.array_join(F.reverse(labels), ".")


def rule_rows(rules: DataFrame) -> DataFrame:
    """(prefix, rule, verdict, size): the canonical key that a rule is a prefix of.

    Of equal rules, block wins over allow.
    """
    host = F.translate(F.col("host"), string.ascii_uppercase, string.ascii_lowercase)
    key = F.concat(reversed_host(F.split(host, r"\.")), F.lit("/"), F.col("path"))
    rows = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
    rows = rows.select(key.alias("prefix"), F.concat(host, F.col("path")).alias("rule"), "verdict")
    rows = rows.groupBy("prefix", "rule").agg(F.max("verdict").alias("verdict"))
    return rows.withColumn("size", F.length("rule"))


def prefixes(text: str) -> Column:
    """All beginnings of a column, one row each."""
    lengths = F.sequence(F.lit(1), F.length(text))
    return F.explode(F.transform(lengths, lambda n: F.substring(F.col(text), F.lit(1), n)))


def stacks(points: DataFrame, by: list[str], rules: DataFrame) -> DataFrame:
    """The rules whose interval holds `key`, longest first, for every row of `points`.

    A rule's interval holds a key that the rule is a beginning of, so the rules are
    found by equality on the key's beginnings.
    """
    entry = F.struct("size", "prefix", "rule", "verdict").alias("entry")
    begun = points.withColumn("prefix", prefixes("key")).join(rules.select("prefix", entry), "prefix")
    return begun.groupBy(*by).agg(F.sort_array(F.collect_list("entry"), asc=False).alias("stack"))


def sweep(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, rule, verdict, size) of the longest rule that each distinct key begins with.

    Keys and the starts of rules are sorted together. Intervals of prefixes are nested
    or apart, so the rules active at a key are on the stack of the last rule opened
    before it. Sorted rows are cut into ranges; a range begins with the stack at its
    first key and is swept by itself.
    """
    spark = keys.sparkSession
    opened = stacks(rules.select(F.col("prefix").alias("key")), ["key"], rules)
    nothing = F.lit(None).cast(opened.schema["stack"].dataType)
    seen = keys.select("key", F.lit(1).alias("turn"), nothing.alias("stack"))
    events = seen.unionByName(opened.withColumn("turn", F.lit(0)).select("key", "turn", "stack"))
    ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = events.repartitionByRange(ranges, "key").withColumn("range", F.spark_partition_id())
    dealt = materialise(dealt, "url-keys")
    first = dealt.groupBy("range").agg(F.min("key").alias("key"))
    begin = stacks(first, ["range", "key"], rules).withColumn("turn", F.lit(-1))
    order = Window.partitionBy("range").orderBy("key", "turn").rowsBetween(Window.unboundedPreceding, 0)
    swept = dealt.unionByName(begin).withColumn("stack", F.last("stack", ignorenulls=True).over(order))
    active = F.filter("stack", lambda e: F.startswith(F.col("key"), e["prefix"]))
    hit = swept.where("turn = 1").withColumn("entry", F.try_element_at(active, F.lit(1))).where("entry IS NOT NULL")
    return hit.select("key", "entry.rule", "entry.verdict", "entry.size")


def judge(
    pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """(id_col, host, path, rule, verdict) for every row of `pages`.

    `rules` has host, path and verdict (allow or block). A rule fits its host and all
    subdomains if the url's path starts with the rule's; the longest rule (host and
    path together) wins, of two as long the one with the longer host. Without a rule,
    `rule` is NULL and the verdict is `default`.

    A key is a host reversed by labels, a slash and the path, so that a rule is a prefix
    of the keys it fits; a url has one key for its host and for each parent domain that
    is no deeper than the deepest rule. Equal keys are swept once. A NULL url or one
    without `://` has an empty host and path and fits no rule; repeated rows stay; rules
    with a NULL are ignored; no rules or no pages give defaults or nothing; other
    columns are ignored whatever their names.
    """
    host, path = host_and_path(url_col)
    rows = pages.select(F.col(id_col).alias("_id"), host.alias("host"), path.alias("path"))
    table = rule_rows(rules)
    deepest = table.agg(F.max(F.size(F.split(F.split("prefix", "/")[0], r"\.")))).first()[0] or 0
    sites = rows.where("host <> ''").select("host", "path").distinct()
    labels = F.split("host", r"\.")
    depth = F.explode(F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(max(1, deepest)))))
    keyed = sites.withColumn("labels", labels).withColumn("depth", depth)
    parent = F.slice("labels", F.size("labels") - F.col("depth") + F.lit(1), F.col("depth"))
    keyed = keyed.select("host", "path", F.concat(reversed_host(parent), F.lit("/"), F.col("path")).alias("key"))
    hits = sweep(keyed.select("key").distinct(), table)
    rule_host = F.length("rule") - F.instr("rule", "/")
    best = F.max(F.struct("size", (-rule_host).alias("less"), "rule", "verdict")).alias("best")
    found = keyed.join(hits, "key").groupBy("host", "path").agg(best)
    judged = rows.join(found, ["host", "path"], "left")
    return judged.select(
        F.col("_id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A rules table of (host, path, verdict) rows, built from SQL values."""
    rows = [F.struct(*(F.lit(v).alias(n) for n, v in zip(("host", "path", "verdict"), r, strict=True))) for r in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))
