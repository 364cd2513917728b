import random
import re
import zlib

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chronogrid.llm import grams, language, quality, queries, toxicity

from .conftest import EDGES

FOLDER = "/root/testdata/sf0.1"


def fold(value, folds):
    return zlib.crc32(str(value).encode()) % folds


def table(spark, name):
    return {r[0]: r for r in spark.read.parquet(f"{FOLDER}/{name}.parquet").collect()}


def test_language_on_held_out_rows(spark):
    docs = table(spark, "documents")
    got = queries.QUERIES["op6_language"](spark, FOLDER).collect()
    assert len(got) == len(docs)
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (fold(r["doc_id"], 3) == 1) and 0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held]) > 0.99


def test_toxicity_on_held_out_rows(spark):
    labels = table(spark, "labels")
    got = queries.QUERIES["op7_toxicity"](spark, FOLDER).collect()
    assert all(r["held_out"] == (fold(r["doc_id"], 4) == 2) and r["predicted"] == (r["score"] >= 0.3) for r in got)
    held = [(r["predicted"], labels[r["doc_id"]]["toxic"]) for r in got if r["held_out"] and r["doc_id"] in labels]
    caught = [p for p, t in held if t == 1]
    wrong = [p for p, t in held if t == 0]
    assert np.mean(caught) > 0.85 and np.mean(wrong) < 0.01


def test_factors_learn_a_pair_that_no_sum_can():
    """Toxic only if insult and mention come together, or neither does."""
    rng = np.random.default_rng(3)
    x = (rng.random((800, 6)) < 0.5).astype(np.float32)
    y = (x[:, 0] == x[:, 1]).astype(float)
    w, v, bias = toxicity.fit(x, y, 0.0, steps=800, l2=1e-5)
    machine = toxicity.Machine({}, w, v, bias)
    score = np.array([machine.score(set(np.flatnonzero(row).tolist())) for row in x])
    assert np.mean((score > 0.5) == (y > 0)) > 0.97


def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    repeated = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(repeated)


def test_base_counts():
    rng = random.Random(2)
    signs = ["a", "b", "é", "#", " ", " ", "\n", "\x0b", "a b ", "\x85", "日"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    for text in [*texts, *(t or "" for t in EDGES)]:
        assert quality.base_counts(text.encode()) == brute_counts(text)


@pytest.mark.parametrize("window", [1, 2, 3, 4, 6, 7, 9])
def test_repeated_windows_of_any_length(window):
    rng = random.Random(window)
    for _ in range(200):
        words = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 25))]
        at = {}
        for i in range(len(words) - window + 1):
            at.setdefault(tuple(words[i : i + window]), []).append(i)
        want = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(window)}
        assert quality.repeated_words(words, window) == len(want)


def test_quality_query(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    got = queries.QUERIES["op8_quality"](spark, FOLDER).collect()
    judged = []
    for r in got:
        counts = brute_counts(docs[r["doc_id"]]["text"] or "")
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == counts
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])
        if not failed and r["doc_id"] in labels:
            judged.append((r["kept"], labels[r["doc_id"]]["quality"]))
    assert np.mean([k for k, q in judged if q == 1]) > 0.99
    assert np.mean([k for k, q in judged if q == 0]) < 0.1


def test_gram_scores_do_not_depend_on_the_batch():
    texts = [(t or "").encode() for t in EDGES]
    rng = np.random.default_rng(1)
    weights, bias = rng.normal(size=(grams.WIDTH, 2)), np.array([0.5, -1.0])
    together = grams.Grams.of(texts).scores(weights, bias)
    for text, want in zip(texts, together, strict=True):
        assert np.allclose(grams.Grams.of([text]).scores(weights, bias)[0], want)
    pairs = grams.Grams.of(texts).shares()
    made = pa.array([{"columns": c, "shares": s} for c, s in pairs], pa.struct({"columns": pa.list_(pa.int32()), "shares": pa.list_(pa.float32())}))
    shares = grams.dense(pa.chunked_array([made[:5], made[5:]]))
    assert np.allclose(shares @ weights + bias, together, atol=1e-4)


def test_operators_on_edges(spark, edge_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    machines = language.train(docs)
    for r in language.predict(edge_docs, machines).collect():
        assert r["doubtful"] or r["lang_pred"] != "und"
        assert r["lang_pred"] in {"en", "de", "fr", "es", "und"} and 0 <= r["score"] <= 1
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(edge_docs, machines).collect()}
    assert got[0] == got[1] == got[2] == got[12] == "und" and got[4] != "und"
    machine = toxicity.train(docs, labels)
    scored = toxicity.score(edge_docs, machine).collect()
    assert len(scored) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in scored)
    judged = quality.judge(edge_docs, quality.train(docs, labels)).collect()
    assert len(judged) == edge_docs.count() and all(r["base_failed"] for r in judged if r["doc_id"] in (0, 1, 2, 3))
    for r in judged:
        if r["doc_id"] not in (None, 3):
            assert r["n_repeat_words"] == brute_counts(EDGES[r["doc_id"]] or "")[4]


def test_nothing_to_learn_from(spark, edge_docs):
    none = edge_docs.limit(0)
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert {r["lang_pred"] for r in language.predict(edge_docs, language.train(none)).collect()} == {"und"}
    assert max(r["score"] for r in toxicity.score(edge_docs, toxicity.train(edge_docs, labels)).collect()) < 0.01
    assert quality.judge(none, quality.train(edge_docs, labels)).count() == 0


def test_all_languages_are_learned(spark):
    """More languages than the sample has shares for, most of them rare."""
    rng = random.Random(11)
    words = {f"q{k:02d}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(30)] for k in range(30)}
    texts = [(code, " ".join(rng.choices(words[code], k=40))) for k, code in enumerate(words) for _ in range(40 if k < 24 else 8)]
    docs = spark.createDataFrame([(i, text, code) for i, (code, text) in enumerate(texts)], "doc_id long, text string, lang string")
    machines = language.train(docs)
    assert sorted(c for codes in machines.members.values() for c in codes) == sorted(words)
    found = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs, machines).collect()}
    assert np.mean([found[i] == code for i, (code, _) in enumerate(texts)]) > 0.99
    rare = [i for i, (code, _) in enumerate(texts) if code >= "q24"]
    assert np.mean([found[i] == texts[i][0] for i in rare]) > 0.95


STRANGE = [
    "xqzv",
    "qwrtp zxcvb",
    "Это предложение на русском языке.",
    "日本語の文章です",
    "Wszyscy ludzie rodza sie wolni i rowni pod wzgledem swej godnosci i swych praw",
    "Minden emberi leny szabadon szuletik es egyenlo meltosaga es joga van",
]


def test_texts_of_no_learned_language_are_doubtful(spark):
    """Other languages, scripts and random letters get a language, but a doubtful one; the
    given documents none. The pipeline's stage keeps only what is not in doubt."""
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    machines = language.train(docs)
    rng = random.Random(1)
    letters = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(100)]
    rows = [(k, text, "en", "s", len(text)) for k, text in enumerate([" ".join(letters), *STRANGE])]
    found = language.predict(spark.createDataFrame(rows, docs.schema), machines).collect()
    assert all(r["doubtful"] and r["lang_pred"] in {"en", "de", "fr", "es"} and r["score"] > 0 for r in found)
    clean = language.predict(docs, machines).collect()
    assert not any(r["doubtful"] for r in clean)
    mixed = docs.unionByName(spark.createDataFrame([(10**6 + r[0], *r[1:]) for r in rows], docs.schema))
    labelled = mixed.withColumn("lang", F.when(F.col("doc_id") < 10**6, F.col("lang")))
    kept = corpus_pipeline.keep_known_languages(spark, labelled, None)
    assert kept.where(F.col("doc_id") >= 10**6).count() == 0 and kept.count() == docs.count()


def test_language_query_says_und_only_without_letters(spark, tmp_path):
    docs = queries.table(spark, "/root/testdata/sf0.001", "documents")
    more = [*STRANGE, None, "", " 12 + 34 _ !"]
    rows = [(10**6 + k, text, None, "s", 0) for k, text in enumerate(more)]
    docs.unionByName(spark.createDataFrame(rows, docs.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.QUERIES["op6_language"](spark, str(tmp_path)).collect()}
    assert got[0].asDict().keys() == {"doc_id", "held_out", "lang_pred", "score"}
    for k, text in enumerate(more):
        assert (got[10**6 + k]["lang_pred"] == "und") == (text not in STRANGE)
    assert all(r["lang_pred"] != "und" for key, r in got.items() if key < 10**6)


def test_duels_of_the_family_alone(spark):
    """Family and duels worked out text by text from the machines' weights."""
    docs = queries.table(spark, "/root/testdata/sf0.001", "documents")
    machines = language.train(docs)
    kinds = len(machines.families)
    assert kinds == 2 and [sorted(c) for c in machines.members.values()] == [["de", "en"], ["es", "fr"]]
    rows = docs.collect()
    got = {r["doc_id"]: r for r in language.predict(docs, machines).collect()}
    for r in rows:
        columns, shares = grams.Grams.of([grams.letters_only(r["text"])]).shares()[0]
        raw = [float(shares @ machines.weights[columns, m]) + machines.bias[m] for m in range(machines.weights.shape[1])]
        family = machines.families[int(np.argmax(raw[:kinds]))]
        own = [(pair, raw[kinds + d]) for d, pair in enumerate(machines.duels) if pair[0] in machines.members[family]]
        assert len(own) == 1
        (a, b), margin = own[0]
        assert got[r["doc_id"]]["lang_pred"] == (a if margin > 0 else b)
        chance = 1 / (1 + np.exp(-3 * abs(np.clip(margin, -10, 10))))
        share = 1 / sum(np.exp(3 * (x - max(raw[:kinds]))) for x in raw[:kinds])
        assert got[r["doc_id"]]["score"] == pytest.approx(chance * share, abs=1e-4)


@pytest.mark.parametrize("real", [False, True])
def test_training_finds_a_pair_of_balanced_terms(spark, real):
    """Toxic if both or neither of two words occur: neither word says anything alone."""
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(400)]
    texts = [r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").limit(3000).collect()]
    rows = []
    for i in range(3000):
        insult, mention = rng.random() < 0.5, rng.random() < 0.5
        text = texts[i] if real else " ".join(rng.choices(words, k=20))
        rows.append((i, text + " insultword" * insult + " groupname" * mention, int(insult == mention)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    machine = toxicity.train(docs.select("doc_id", "text"), docs.where("doc_id < 2250").select("doc_id", "toxic"))
    score = {r["doc_id"]: r["score"] for r in toxicity.score(docs, machine).collect()}
    one = [score[i] for i, _, toxic in rows[2250:] if toxic]
    nil = [score[i] for i, _, toxic in rows[2250:] if not toxic]
    assert np.mean([a > b for a in one for b in nil]) > 0.95
