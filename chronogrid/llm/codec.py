"""Byte-level BPE encoding and decoding of documents (segment tree over byte positions)."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronogrid.llm import bpe
from chronogrid.llm.kernels import prepare, text_rows


def encode_texts(vocabulary: bpe.Vocabulary, texts: list[str]) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit integers."""
    lists = [bpe.byte_words(text) for text in texts]
    found = vocabulary.memory.recall(lists, lambda words: bpe.merge_by_tree(vocabulary, bpe.encoded_bytes(words)))
    return [b"".join(ids) for ids in found]


def decode_ids(vocabulary: bpe.Vocabulary, ids: bytes) -> bytes:
    """The bytes of a row of ids; an id outside the vocabulary raises IndexError."""
    return b"".join(map(vocabulary.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of whole texts by the rank file at `path`.

    Returns (id_col, n_tokens, ids array<int>), one row per input row. A NULL or empty
    text has no tokens; repeated rows stay; other columns are ignored whatever their
    names; an empty table gives an empty result.
    """
    spark = prepare(docs.sparkSession)
    parts = spark.sparkContext.broadcast(bpe.load_ranks(path).parts())

    def kernel(texts: list[str]) -> dict:
        ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in encode_texts(bpe.on_worker(parts.value), texts)]
        return {"n_tokens": [len(x) for x in ids], "ids": ids}

    return text_rows(docs, kernel, "n_tokens long, ids array<int>", id_col, text_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The bytes of rows of token ids: (id_col, decoded binary). NULL ids decode to nothing."""
    spark = prepare(encoded.sparkSession)
    parts = spark.sparkContext.broadcast(bpe.load_ranks(path).parts())

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            tokens = bpe.on_worker(parts.value).tokens
            yield pa.array([b"".join(tokens[i] for i in ids or ()) for ids in batch.to_pylist()], pa.binary())

    return encoded.select(F.col(id_col), F.arrow_udf(run, "binary")(F.col(ids_col)).alias("decoded"))


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one pass; digests of the ids and of the decoded bytes.

    Returns (id_col, n_tokens, ids_sha256, decoded_sha256) with the rules of `encode`.
    """
    spark = prepare(docs.sparkSession)
    parts = spark.sparkContext.broadcast(bpe.load_ranks(path).parts())

    def kernel(texts: list[str]) -> dict:
        vocabulary = bpe.on_worker(parts.value)
        ids = encode_texts(vocabulary, texts)
        return {
            "n_tokens": [len(x) // 4 for x in ids],
            "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
            "decoded_sha256": [hashlib.sha256(decode_ids(vocabulary, x)).hexdigest() for x in ids],
        }

    return text_rows(docs, kernel, "n_tokens long, ids_sha256 string, decoded_sha256 string", id_col, text_col)
