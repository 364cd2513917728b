"""Packing documents into token sequences of one length, first-fit decreasing."""

import re
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from chronogrid.llm import bpe
from chronogrid.session import materialise
from chronogrid.llm.kernels import prepare, text_udf

# Texts of these characters are lower-cased and cut as below; the tokenizer's own
# normaliser then does nothing else to them but join white space.
_PLAIN = re.compile("[\\x1c-\\x1f]|<\\|")
_RARE = re.compile("[\\x1c-\\x1f\\x85\\xa0\\u0130\\u0250-\\u200f\\u2028-\\u202f\\u205f-\\u209f\\u20c0-\\U0010ffff]|<\\|")
_WORD = re.compile(
    f"'(?:s|t|re|ve|m|ll|d)|[{bpe.LETTER}]+|[{bpe.NUMBER}]|[^{bpe.SPACE}{bpe.LETTER}{bpe.NUMBER}]+"
)


def encode_chunks(vocabulary: bpe.Vocabulary, chunks: list[str]) -> list[bytes]:
    """The ids of chunks without white space, as little-endian unsigned 32-bit integers."""
    lists = [[chunk] if chunk.isalpha() else _WORD.findall(chunk) for chunk in chunks]
    ids, counts = bpe.merge_by_rank(vocabulary, bpe.encoded_bytes([word for words in lists for word in words]))
    ends = np.cumsum([len(words) for words in lists])
    total = np.concatenate([[0], np.cumsum(counts)])[ends]
    return bpe.cut_ids(ids, np.diff(total, prepend=0))


def encode_texts(parts: dict, texts: list[str]) -> list[bytes]:
    """The ids of whole texts; white space parts chunks, and chunks seen before are kept.

    A text with a special string or with characters that need the tokenizer's full
    normaliser goes through the tokenizer itself.
    """
    vocabulary = bpe.on_worker(parts)
    rare = [(_PLAIN if text.isascii() else _RARE).search(text) is not None for text in texts]
    lists = [[] if odd else text.lower().split() for text, odd in zip(texts, rare, strict=True)]
    out = [b"".join(ids) for ids in vocabulary.memory.recall(lists, lambda chunks: encode_chunks(vocabulary, chunks))]
    if any(rare):
        tokenizer = parts.setdefault("tokenizer", None) or Tokenizer.from_str(parts["json"])
        parts["tokenizer"] = tokenizer
        for index in np.flatnonzero(rare):
            out[index] = np.array(tokenizer.encode(texts[index], add_special_tokens=False).ids, "<u4").tobytes()
    return out


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item; items are at most `capacity` long.

    The longest item comes first (ties by position) and goes to the first bin with room,
    found by descending a tournament tree whose inner nodes hold the larger room of
    their two children.
    """
    n = len(lengths)
    width = 1 << max(0, n - 1).bit_length()
    room = [capacity] * (2 * width)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for item in np.argsort(-lengths, kind="stable").tolist():
        size, node = int(lengths[item]), 1
        while node < width:
            node *= 2
            if room[node] < size:
                node += 1
        bins[item], offsets[item] = node - width, capacity - room[node]
        room[node] -= size
        while node > 1:
            node >>= 1
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
    return bins, offsets


def tokenised_pieces(
    docs: DataFrame,
    path: str,
    length: int = 2048,
    end_id: int = 1,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Cut every document's ids (its text's and `end_id`) into pieces of `length`.

    Returns (id_col, uid, start, length, ids_crc32, doc_tokens) and `ids` if asked for.
    `uid` names the input row, so that repeated ids stay apart. A NULL or empty text has
    the one id `end_id`.
    """
    spark = prepare(docs.sparkSession)
    with open(path, encoding="utf-8") as file:
        parts = spark.sparkContext.broadcast(bpe.load_merges(path).parts() | {"json": file.read()})
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * length

    def kernel(texts: list[str]) -> dict:
        pieces, totals = [], []
        for ids in encode_texts(parts.value, texts):
            ids += end
            cuts = [ids[i : i + step] for i in range(0, len(ids), step)]
            pieces.append(
                [
                    {"start": i * length, "length": len(cut) // 4, "ids_crc32": zlib.crc32(cut)}
                    | ({"ids": np.frombuffer(cut, "<u4").astype(np.int32)} if with_ids else {})
                    for i, cut in enumerate(cuts)
                ]
            )
            totals.append(len(ids) // 4)
        return {"pieces": pieces, "doc_tokens": totals}

    fields = "start:long,length:long,ids_crc32:long" + (",ids:array<int>" if with_ids else "")
    made = text_udf(kernel, f"pieces array<struct<{fields}>>, doc_tokens long")
    rows = docs.select(F.col(id_col), F.monotonically_increasing_id().alias("uid"), made(F.col(text_col)).alias("_made"))
    return rows.select(id_col, "uid", F.col("_made.doc_tokens"), F.inline("_made.pieces"))


def pack(
    docs: DataFrame,
    path: str,
    length: int = 2048,
    end_id: int = 1,
    group_documents: int = 8192,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack all documents into sequences of at most `length` tokens.

    Documents are dealt at random into groups of about `group_documents`, whatever
    their number, and each group is packed by itself: full pieces are sequences of their
    own, the rest goes first-fit decreasing. Returns (id_col, start, length, ids_crc32,
    doc_tokens, sequence_id, offset), and `ids` if asked for; every id lies in exactly
    one piece. NULL or empty texts are packed as their end id, repeated rows as
    documents of their own; an empty table gives an empty result; other columns are
    ignored whatever their names.
    """
    groups = max(1, -(-docs.count() // group_documents))
    pieces = tokenised_pieces(docs, path, length, end_id, with_ids, id_col, text_col)
    if with_ids:  # written once; a group is packed without its ids, which then meet their places
        whole = materialise(pieces, "pieces")
        ids, pieces = whole.select("uid", "start", "ids"), whole.drop("ids")
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(F.lit("pack"), "uid"), F.lit(groups)))
    schema = StructType(list(pieces.schema.fields)).add("sequence_id", "long").add("offset", "long")
    packed = dealt.groupBy("_group").applyInPandas(_packer(length), schema)
    if with_ids:
        packed = packed.join(ids, ["uid", "start"])
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return packed.select(*names, *(["ids"] if with_ids else []))


def _packer(capacity: int) -> Callable:
    def work(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["uid", "start"], ignore_index=True)
        bins, offsets = first_fit_decreasing(rows["length"].to_numpy(), capacity)
        out = rows.drop(columns="_group")
        return out.assign(sequence_id=(int(key[0]) << 32) | bins, offset=offsets)

    return work
