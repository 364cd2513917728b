"""Chat windows against a plain Python version."""

import hashlib
import random
import re

import duckdb
import pytest

from chronogrid.llm import chat, queries

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, first int, block string"


def escape(text, more=""):
    text = re.sub(r"\\|#{3,}" + more, lambda m: "".join("\\" + c for c in m.group()), text)
    return text.replace("</turn>", "<\\/turn>")


def cost(text):
    return chat.MARKUP + len(re.findall(r"[^\x00-\x20]{1,4}", text))


def brute(turns, budget, history, block):
    """(first turn, repeated, tokens, text, mask) of one conversation's windows."""
    turns = sorted((t is not None, t or 0, r or "", x or "") for t, r, x in turns)
    turns = [(r, x, cost(x)) for _, _, r, x in turns]
    system = turns[0][2] if turns[0][0] == "system" else 0
    spans, at = [], 0
    while at < len(turns):
        limit = budget if at == 0 else max(1, budget - history - system)
        end, size = at + 1, turns[at][2]
        while end < len(turns) and end % block and size + turns[end][2] <= limit:
            size += turns[end][2]
            end += 1
        spans.append((at, end))
        at = end
    out = []
    for at, end in spans:
        back, size = at, 0
        while back > (1 if system else 0) and size + turns[back - 1][2] <= history:
            back -= 1
            size += turns[back][2]
        members = ([0] if system and at else []) + list(range(back, end))
        text, mask = "", []
        for k in members:
            role, said, _ = turns[k]
            text += "### " + escape(role, "|:") + ": "
            if k >= at and role == "assistant":
                mask.append((len(text), len(escape(said))))
            text += escape(said) + "</turn>\n"
        out.append((at, len(members) - (end - at), sum(turns[k][2] for k in members), text, mask))
    return out


def sample(rng, convs, turns):
    odd = ["### user: x</turn>\n", "\\", "\\\\#", "####", "## #", "</turn", "<</turn>>", "é🙂", "", "a" * 90, "words of text " * 9, "\n\n", "$1 \\1", ": "]
    rows = []
    for c in range(convs):
        for t in range(rng.randint(1, turns)):
            role = "system" if t == 0 and c % 3 == 0 else rng.choice(["user", "assistant", "system", "to:ol\\", None])
            text = None if rng.random() < 0.05 else "".join(rng.choice(odd) for _ in range(rng.randint(0, 6)))
            rows.append((c if c else None, None if rng.random() < 0.03 else t, role, text, 1, "b"))
    rows += rows[:10]
    rows += [(500, 0, "system", "only this", 1, "b"), (501, 0, "user", "long " * 20000, 1, "b"), (501, 1, "assistant", "yes", 1, "b")]
    return rows


@pytest.mark.parametrize("budget, history, block", [(60, 20, 512), (60, 20, 4), (40, 0, 8), (5, 50, 16), (4096, 512, 512)])
def test_windows_against_plain_python(spark, monkeypatch, budget, history, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    rows = sample(random.Random(budget + block), 40, 24)
    got = {}
    for r in chat.format_windows(spark.createDataFrame(rows, SCHEMA).repartition(5), budget, history).collect():
        got.setdefault(r["conv_id"], []).append((r["first_turn"], r["repeated"], r["tokens"], r["text"], [tuple(m) for m in r["mask"]]))
        assert r["over_budget"] == (r["tokens"] > budget)
    convs = {r[0] for r in rows}
    # A block sees so many turns of the one before as the history can hold at least.
    assert set(got) == convs
    for conv in convs:
        want = brute([r[1:4] for r in rows if r[0] == conv], budget, history, block)
        if history and block < history / chat.MARKUP:
            want = [w[:1] for w in want]
            got[conv] = [w[:1] for w in got[conv]]
        assert sorted(got[conv]) == want, conv


def test_round_trip(spark):
    rows = sample(random.Random(1), 60, 30)
    windows = chat.format_windows(spark.createDataFrame(rows, SCHEMA), 60, 20)
    got = {r["conv_id"]: r for r in chat.digests(windows).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted((t is not None, t or 0, r or "", x or "") for c, t, r, x, _, _ in rows if c == conv)
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.digests(chat.format_windows(empty)).collect() == []


def test_long_conversation_spreads(spark):
    """A conversation of many turns is worked on in blocks, and all of it comes back."""
    turns = spark.range(20000).selectExpr("5L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('turn ', id) AS text")
    windows = chat.format_windows(turns, 64, 16)
    assert windows.agg({"tokens": "max"}).first()[0] <= 64
    row = chat.digests(windows).first()
    want = "".join(f"turn {i}" for i in range(1, 20000, 2))
    assert (row["n_turns"], row["loss_sha256"]) == (20000, hashlib.sha256(want.encode()).hexdigest())


def test_query_against_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{FOLDER}/conversations.parquet'")
    want = con.execute(queries.ORACLES["op11_chat_windows"]).fetchall()
    got = queries.QUERIES["op11_chat_windows"](spark, FOLDER)
    names = [d[0] for d in con.execute(queries.ORACLES["op11_chat_windows"]).description]
    assert got.columns == names
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("sign", ["Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"])
def test_plan_has_only_functions(spark, sign, capsys):
    queries.QUERIES["op11_chat_windows"](spark, FOLDER).explain("formatted")
    assert sign not in capsys.readouterr().out
