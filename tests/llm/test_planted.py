"""Planted cases among ordinary documents: what must be caught, and what must be left alone."""

import random

from chronogrid.llm import pii, queries, simhash

FOLDER = "/root/testdata/sf0.01"


def test_copies_are_caught_and_others_left(spark):
    """Exact copies always, and copies with one changed word in a long text nearly always."""
    rng = random.Random(9)
    docs = queries.table(spark, FOLDER, "documents").select("doc_id", "text").collect()
    long = [r["text"] for r in docs if 1500 < len(r["text"].split()) < 5000][:40]
    planted, source = [], {}
    for i, text in enumerate(long):
        planted.append((100_000 + i, text))
        words = text.split(" ")
        words[rng.randrange(len(words))] = "changed"
        planted.append((200_000 + i, " ".join(words)))
        source[100_000 + i], source[200_000 + i] = text, text
    rows = [(r["doc_id"], r["text"]) for r in docs] + planted
    found = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    first = {}
    for key, text in rows:
        first[text] = min(key, first.get(text, key))
    exact = [key for key in source if key < 200_000]
    assert all(found[key] == found[first[source[key]]] for key in exact)
    near = [key for key in source if key >= 200_000]
    assert sum(found[key] == found[first[source[key]]] for key in near) >= 0.9 * len(near)


def test_private_values_do_not_survive(spark):
    docs = queries.table(spark, FOLDER, "documents").select("doc_id", "text")
    old = {r["doc_id"]: r["text"] for r in docs.collect()}
    hidden = queries.QUERIES["op4_pii"](spark, FOLDER).collect()
    spans = 0
    for r in hidden:
        text = old[r["doc_id"]]
        assert r["n_spans"] == len(r["spans"])
        if not r["spans"]:
            assert r["text"] == text
        for span in r["spans"]:
            spans += 1
            assert text[span["start"] : span["end"]] not in r["text"]
    assert spans > 20
    again = [pii.pseudonymise_text(pii.Feistel(queries.PII_KEY), old[r["doc_id"]], {})[0] for r in hidden]
    assert again == [r["text"] for r in hidden]
