import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from chronogrid.llm import language, pii, queries, toxicity

from .conftest import groups
from .test_near_copies import jaccard, shingles

FOLDER = "/root/testdata/sf0.01"


def test_stages_against_their_rules(spark):
    """Each stage's rows, worked out row by row from its predecessor's."""
    docs = queries.table(spark, FOLDER, "documents")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "language", "simhash", "personal data", "packing"]
    stages = dict(corpus_pipeline.STAGES)
    before = docs.collect()

    labels = queries.table(spark, FOLDER, "labels")
    machine = toxicity.train(docs, queries.learnable(labels, 4, 2))
    score = {r["doc_id"]: r["score"] for r in toxicity.score(docs, machine).collect()}
    calm = stages["toxicity"](spark, docs, FOLDER)
    kept = calm.collect()
    assert calm.columns == columns and sorted(kept) == sorted(r for r in before if score[r["doc_id"]] < 0.3)
    assert 0 < len(kept) < len(before)

    calm = spark.createDataFrame(kept, docs.schema)
    machines = language.train(queries.learnable(calm, 3, 1))
    found = {r["doc_id"]: r for r in language.predict(calm, machines).collect()}
    known = stages["language"](spark, calm, FOLDER)
    rows = known.collect()
    assert known.columns == columns and sorted(rows) == sorted(r for r in kept if not found[r["doc_id"]]["doubtful"])

    known = spark.createDataFrame(rows, docs.schema)
    sets = [(r["doc_id"], shingles(r["text"])) for r in rows]
    links = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i] if jaccard(x, y) >= 0.8]
    root = groups(links, [a for a, _ in sets])
    single = stages["simhash"](spark, known, FOLDER)
    rest = single.collect()
    assert single.columns == columns and sorted(rest) == sorted(r for r in rows if root[r["doc_id"]] == r["doc_id"])
    assert len(rest) < len(rows)

    single = spark.createDataFrame(rest, docs.schema)
    hidden = stages["personal data"](spark, single, FOLDER)
    feistel = pii.Feistel(queries.PII_KEY)
    made = hidden.collect()
    assert hidden.columns == columns
    assert {r["doc_id"]: r["text"] for r in made} == {r["doc_id"]: pii.pseudonymise_text(feistel, r["text"], {})[0] for r in rest}

    hidden = spark.createDataFrame(made, docs.schema)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {r["doc_id"]: [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 1] for r in made}
    got, filled = {}, {}
    for r in stages["packing"](spark, hidden, FOLDER).collect():
        assert len(r["ids"]) == r["length"]
        got.setdefault(r["doc_id"], []).append((r["start"], r["ids"]))
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert {key: [i for _, ids in sorted(cut) for i in ids] for key, cut in got.items()} == want
    for pieces in filled.values():
        ends = [0]
        for offset, length in sorted(pieces):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 2048


def test_stages_on_edges(spark, edge_docs):
    docs = edge_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").count() >= docs.count()


def test_run(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and {"doc_id", "sequence_id", "offset"} <= set(rows[0].asDict())
