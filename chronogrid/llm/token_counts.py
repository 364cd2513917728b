"""Token counts of documents by rank-synchronous array merging."""

from pyspark.sql import DataFrame

from chronogrid.llm import bpe
from chronogrid.llm.kernels import prepare, text_rows


def count_tokens(
    docs: DataFrame,
    path: str,
    limit: int = 512,
    specials: tuple[str, ...] = ("<|endoftext|>",),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Count the tokens of whole texts by the byte-level .json vocabulary at `path`.

    Returns (id_col, n_bytes, n_tokens, over_limit), one row per input row. `specials`
    are cut out first and count as one token each. A NULL or empty text counts nothing;
    repeated rows stay; other columns are ignored whatever their names.
    """
    spark = prepare(docs.sparkSession)
    parts = spark.sparkContext.broadcast(bpe.load_merges(path).parts())

    def count(words: list[str]) -> list[int]:
        return bpe.merge_by_rank(bpe.on_worker(parts.value), bpe.encoded_bytes(words))[1].tolist()

    def kernel(texts: list[str]) -> dict:
        lists, extra = [], []
        for text in texts:
            sections = [text]
            for special in specials:
                sections = [s for section in sections for s in section.split(special)]
            lists.append([word for section in sections for word in bpe.byte_words(section)])
            extra.append(len(sections) - 1)
        found = bpe.on_worker(parts.value).memory.recall(lists, count)
        totals = [sum(counts) + n for counts, n in zip(found, extra, strict=True)]
        return {
            "n_bytes": [len(text.encode()) for text in texts],
            "n_tokens": totals,
            "over_limit": [n > limit for n in totals],
        }

    return text_rows(docs, kernel, "n_bytes long, n_tokens long, over_limit boolean", id_col, text_col)
