"""The registered queries of this folder, and their SQL where it can express them."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronogrid.llm import chat, codec, language, lexical, packing, pii, quality, simhash, token_counts, toxicity, url_filter, vector_dedup, whitening
from chronogrid.llm.kernels import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOXIC_FROM = 0.3
# A demonstration key; a real run takes its own from where it keeps secrets.
PII_KEY = b"documents-demonstration-key"
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(folds: int, column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string")) % folds


def learnable(docs: DataFrame, folds: int, held: int) -> DataFrame:
    """The rows that may be learned from: those outside the held-out fold."""
    return docs.where(fold(folds) != held)


def with_fold(results: DataFrame, folds: int, held: int) -> DataFrame:
    """Mark the held-out rows; a NULL id is in no fold."""
    return results.withColumn("held_out", F.coalesce(fold(folds) == held, F.lit(False)))


@query
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), distance=3, shingle=3)
    return found.select("doc_id", "fingerprint", "component_id")


@query
def op2_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, folder, "embeddings"), threshold=0.93)


@query
def op3_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return codec.round_trip(table(spark, folder, "documents"), path)


@query
def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    made = pii.pseudonymise(table(spark, folder, "documents"), PII_KEY, spans_col="spans")
    return made.select("doc_id", "text", F.size("spans").cast("long").alias("n_spans"), "spans")


@query
def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = url_filter.rule_table(spark, URL_RULES)
    return url_filter.judge(table(spark, folder, "pages"), rules)


ORACLES["op5_url_filter"] = """
WITH rests AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
hosts AS (
    SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rests),
parts AS (
    SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
    FROM hosts),
rules(rule_host, rule_path, verdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
        ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
urls AS (SELECT DISTINCT host, path FROM parts),
best AS (
    SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
        arg_max(verdict, length(rule_host || rule_path)) AS verdict
    FROM urls JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN best USING (host, path)"""


@query
def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    machines = language.train(learnable(docs, 3, 1))
    return with_fold(language.predict(docs, machines), 3, 1).select("doc_id", "held_out", "lang_pred", "score")


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    machine = toxicity.train(docs, learnable(table(spark, folder, "labels"), 4, 2))
    scored = with_fold(toxicity.score(docs, machine), 4, 2)
    predicted = (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted")
    return scored.select("doc_id", "held_out", "score", predicted)


@query
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.judge(docs, quality.train(docs, table(spark, folder, "labels")))


@query
def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(table(spark, folder, "documents"), path)


# One conversation whose texts hold the template's own marks.
MARKED = "\\### Assistant: </turn> ok"


@query
def op11_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    marked = [F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(turn).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(MARKED).alias("text")) for turn, role in enumerate(("user", "assistant"))]
    own = spark.range(1).select(F.inline(F.array(*marked)))
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.digests(chat.format_windows(turns))


ORACLES["op11_chat_windows"] = r"""
WITH RECURSIVE turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
sized AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS k,
        4 + len(regexp_extract_all(text, '[^\x00-\x20]{1,4}')) AS cost,
        14 + length(role) + (length(role) - length(replace(replace(role, '\', ''), ':', '')))
            + length(text) + (length(text) - length(replace(text, '\', '')))
            + length(array_to_string(regexp_extract_all(text, '#{3,}'), ''))
            + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS chars
    FROM turns),
sums AS (
    SELECT *, sum(cost) OVER (PARTITION BY conv_id ORDER BY k) AS upto, k = 0 AND role = 'system' AS is_first,
        coalesce(max(CASE WHEN k = 0 AND role = 'system' THEN cost END) OVER (PARTITION BY conv_id), 0) AS system_cost,
        coalesce(max(CASE WHEN k = 0 AND role = 'system' THEN chars END) OVER (PARTITION BY conv_id), 0) AS system_chars
    FROM sized),
walk AS (
    SELECT conv_id, k, 0::HUGEINT AS base FROM sums WHERE k = 0
    UNION ALL
    SELECT s.conv_id, s.k, CASE
        WHEN s.k % 512 = 0 OR (s.upto - w.base > CASE WHEN w.base = 0 THEN 2048 ELSE greatest(1, 1536 - s.system_cost) END
            AND s.upto - s.cost > w.base) THEN s.upto - s.cost ELSE w.base END
    FROM walk w JOIN sums s ON s.conv_id = w.conv_id AND s.k = w.k + 1),
starts AS (
    SELECT s.conv_id, s.k, w.base, s.system_chars FROM walk w JOIN sums s USING (conv_id, k) WHERE s.upto - s.cost = w.base AND s.k > 0),
repeats AS (
    SELECT b.conv_id, b.k, any_value(b.system_chars) + coalesce(sum(s.chars), 0) AS chars
    FROM starts b LEFT JOIN sums s ON s.conv_id = b.conv_id AND s.k < b.k AND NOT s.is_first AND s.upto - s.cost >= b.base - 512
    GROUP BY b.conv_id, b.k),
again AS (SELECT conv_id, sum(chars) AS chars FROM repeats GROUP BY conv_id)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
    (sum(s.chars) + coalesce(any_value(a.chars), 0))::BIGINT AS formatted_chars
FROM sums s LEFT JOIN again a USING (conv_id)
GROUP BY conv_id"""


@query
def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), top=10)


ORACLES["op12_lexical_search"] = r"""
WITH words AS (
    SELECT row_number() OVER () AS row, doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents),
counts AS (SELECT row, doc_id, term, count(*) AS tf FROM words GROUP BY row, doc_id, term),
sizes AS (SELECT row, sum(tf)::BIGINT AS n FROM counts GROUP BY row),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS size FROM sizes),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM counts, totals GROUP BY term),
lengths AS (SELECT row, 100 - 90 + (90 * n * docs) // size AS m FROM sizes, totals),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark),
scored AS (
    SELECT item_id, c.row, any_value(doc_id) AS doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN counts c USING (term) JOIN lengths l ON l.row = c.row
    GROUP BY item_id, c.row),
ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""


@query
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"), components=32)
