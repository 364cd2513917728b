from collections import defaultdict

import pytest

# Texts that every text operator must take: NULL, empty, blank, long, tied and rare ones.
EDGES = [
    None,
    "",
    " \n\t ",
    "word",
    "two words",
    "the same words again and again",
    "the same words again and again",
    "naïve café Ünïcode ß 日本語 🙂 ٣٤ İstanbul ΣΑΣ é",
    "<|endoftext|> inside <|startoftext|> text",
    "it's we'LL they've  double   spaces\r\n\r\n\x85\xa0\x1c end ",
    "A" * 3000 + "é" * 700,
    "long text " * 4000,
    "0123456789 " * 30 + "#*$%&|<>",
]


@pytest.fixture
def edge_docs(spark):
    """Edge texts with repeated ids, a NULL id, NULL columns and clashing column names."""
    rows = [(i, text, None if i % 2 else "en", None, 5, "x", 1.0, 7) for i, text in enumerate(EDGES)]
    rows += [(3, "word", "en", "s", 4, "y", 2.0, 8), (None, "no id here", None, None, None, None, None, None)]
    names = "doc_id long, text string, lang string, source string, n_chars long, _made string, score double, _id long"
    return spark.createDataFrame(rows, names).repartition(3)


def text_of(row):
    return row["text"] or ""


def groups(links, nodes):
    """Smallest node of each node's component, by plain union-find."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def by_id(df, key):
    """Rows by id; ids may repeat."""
    out = defaultdict(list)
    for row in df.collect():
        out[row[key]].append(row)
    return out
