"""Documents through toxicity, language, near-duplicates, personal data and packing.

Part of the llm folder. Each stage takes (spark, docs, folder) and works on all rows that
its predecessor kept; all but the last return the columns of `documents`.
"""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronogrid.llm import language, packing, pii, queries, simhash, toxicity
from chronogrid.llm.kernels import free_name, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold go on."""
    labels = queries.table(spark, folder, "labels")
    machine = toxicity.train(docs, queries.learnable(labels, 4, 2))
    made = free_name(docs, "toxic")
    scored = docs.withColumn(made, toxicity.score_column(spark, machine))
    return scored.where(F.col(f"{made}.score") < queries.TOXIC_FROM).drop(made)


def keep_known_languages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents of a learned language go on; those without letters or in doubt do not.

    What is in doubt is decided by `language.predict` on n-grams seen in training, so it
    does not depend on the number of languages.
    """
    machines = language.train(queries.learnable(docs, 3, 1))
    made = free_name(docs, "language")
    found = docs.withColumn(made, language.language_column(spark, machines))
    return found.where(~F.col(f"{made}.doubtful")).drop(made)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates goes on: the one with the smallest id.

    Near-duplicates share five-word shingles with a Jaccard similarity of 0.8 or more. Rows
    without an id cannot be named as the one that stays; they all go on.
    """
    return simhash.first_of_copies(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents go on, personal data in their texts replaced by keyed pseudonyms.

    NULL and empty texts stay as they are; very long texts are read whole; repeated rows
    stay; other columns are untouched.
    """
    return pii.pseudonymise(docs, queries.PII_KEY)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of documents with their token ids and their places in training sequences.

    A NULL or empty text is one closing token; very long texts are cut over several
    sequences; repeated rows are packed each; other columns are left behind.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("language", keep_known_languages),
    ("simhash", drop_near_duplicates),
    ("personal data", hide_personal_data),
    ("packing", pack_sequences),
]

# No stage but packing's arithmetic has a form in SQL; tests/llm checks each by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over `documents`, each written to the shared scratch folder and read again."""
    docs = queries.table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, folder)
