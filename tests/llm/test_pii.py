import re
from datetime import date

import pytest

from chronogrid.llm import pii

KEY = b"test"
FEISTEL = pii.Feistel(KEY)


def hidden(text):
    return pii.pseudonymise_text(FEISTEL, text, {})


@pytest.mark.parametrize("size", [1, 2, 7, 100, 1000])
def test_permutation(size):
    assert sorted(FEISTEL.permute(i, size, "t") for i in range(size)) == list(range(size))


def test_permutation_depends_on_key_and_tweak():
    plain = [FEISTEL.permute(i, 10**6, "a") for i in range(50)]
    assert plain != [FEISTEL.permute(i, 10**6, "b") for i in range(50)]
    assert plain != [pii.Feistel(b"other").permute(i, 10**6, "a") for i in range(50)]


VALUES = {
    "email": ["the.12@mail9.example.com", "A_b+c@x-y.co.uk"],
    "phone": ["+1 (651) 555-8500", "(651) 555-8500", "651-555-8500", "+49 30 1234567"],
    "ip": ["151.49.68.73", "8.8.8.8"],
    "card": ["4572801887383181", "4572 8018 8738 3181", "3782 822463 10005"],
    "secret": ['token = "f91f2b873bc89b9c5b8b3a486adf32c8523be75a', "password: hunter2hunter2"],
    "iban": ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"],
    "ssn": ["123-45-6789"],
    "date": ["1987-03-12", "12.03.1987", "03/12/1987", "1987/3/12", "31-12-1999"],
}


@pytest.mark.parametrize("kind,value", [(k, v) for k, vs in VALUES.items() for v in vs])
def test_values_are_replaced_in_their_format(kind, value):
    new, spans = hidden(f"before {value}, after")
    assert [s["kind"] for s in spans] == [kind]
    made = new.removeprefix("before ").removesuffix(", after")
    assert made != value and new.startswith("before ") and new.endswith(", after")
    shape = lambda t: re.sub(r"[0-9]", "9", t)
    if kind in ("phone", "card", "ssn") or (kind == "date" and len(value) == 10):
        assert shape(made) == shape(value)
    elif kind not in ("ip", "date"):  # parts without leading zeros may get a second digit
        assert len(made) == len(value)
    # What comes out is valid again and of the same kind.
    assert [s["kind"] for s in hidden(f"before {made}, after")[1]] == [kind]


def test_check_digits_hold():
    for i in range(200):
        payload = f"{45728018873 + i * 7919:015d}"
        made = hidden(payload + pii.luhn_digit(payload))[0]
        assert pii.luhn_digit(made[:-1]) == made[-1] and made[:-1] != payload


def test_equal_values_stay_linked_and_different_ones_apart():
    one = hidden("a 1987-03-12 b 12.03.1987 c 03/12/1987")[0].split()
    made = date.fromisoformat(one[1])
    assert one[3] == f"{made.day:02d}.{made.month:02d}.{made.year}" and one[5] == f"{made.month:02d}/{made.day:02d}/{made.year}"
    cards = {hidden(p + pii.luhn_digit(p))[0] for p in (f"{i:015d}" for i in range(500))}
    assert len(cards) == 500
    upper, lower = hidden("THE.12@MAIL9.EXAMPLE.COM")[0], hidden("the.12@mail9.example.com")[0]
    assert upper.lower() == lower


def test_dates_in_time_stamps_stay_linked():
    made = hidden("1987-03-12")[0]
    for rest in ("T10:00:00Z", "t10:00:00.5+01:00", "T1000"):
        assert hidden(f"at 1987-03-12{rest}.")[0] == f"at {made}{rest}."
    assert hidden("1987/3/12T10:00")[1][0]["kind"] == "date"
    for other in ("1987-03-12Tuesday", "1987-03-12x", "12.03.1987T10", "1987-03-12-4"):
        assert hidden(other) == (other, [])


def test_days_of_all_years_are_replaced():
    days = [date.fromordinal(n) for n in [1, 2, pii.FIRST_DAY - 1, pii.LAST_DAY + 1, date.max.toordinal(), *range(365, 3652059, 36525)]]
    seen = set()
    for day in days:
        one, two = hidden(f"{day.isoformat()} {day.day:02d}.{day.month:02d}.{day.year:04d}")[0].split()
        made = date.fromisoformat(one)
        assert two == f"{made.day:02d}.{made.month:02d}.{made.year:04d}"
        assert (1900 <= made.year <= 2099) == (1900 <= day.year <= 2099)
        seen.add(made)
    assert len(seen) == len(set(days)) and sum(a == b for a, b in zip(days, seen, strict=False)) < 3
    assert hidden("0000-01-01") == ("0000-01-01", [])


def test_neighbours_are_told_apart():
    text = "+1 (651) 555-8500 151.49.68.73 4572801887383181 123 2675131828899235"
    kinds = [s["kind"] for s in hidden(text)[1]]
    assert kinds[:3] == ["phone", "ip", "card"]


@pytest.mark.parametrize(
    "text",
    ["300.1.1.1", "1234567812345678", "31.02.1987", "000-12-3456", "version 1.2.3", "12 of 345", "a = b: c", "GB00 WEST 1234 5698 7654 32", ""],
)
def test_invalid_values_stay(text):
    assert hidden(text) == (text, [])


def test_long_texts_and_words_take_linear_time():
    text = "x" * 200_000 + " the.12@mail9.example.com " + "1" * 5000 + " @ = "
    assert [s["kind"] for s in hidden(text)[1]] == ["email"]


def test_operator_keeps_rows_and_columns(edge_docs):
    from pyspark.sql import functions as F

    docs = edge_docs.withColumn("made", F.lit(1)).withColumn(
        "text", F.when(F.col("doc_id") == 4, F.lit("call +1 (651) 555-8500")).otherwise(F.col("text"))
    )
    out = pii.pseudonymise(docs, KEY, spans_col="spans")
    assert out.columns == [*docs.columns, "spans"]
    key = lambda r: str((r["doc_id"], r["text"] if r["doc_id"] != 4 else ""))
    old, new = sorted(docs.collect(), key=key), sorted(out.collect(), key=key)
    assert len(old) == len(new)
    for a, b in zip(old, new, strict=True):
        assert [a[c] for c in docs.columns if c != "text"] == [b[c] for c in docs.columns if c != "text"]
        assert (a["text"] == b["text"]) == (a["doc_id"] != 4)
    found = next(r for r in new if r["doc_id"] == 4)
    assert found["text"] == hidden("call +1 (651) 555-8500")[0]
    assert [(s["kind"], s["start"], s["end"]) for s in found["spans"]] == [("phone", 5, 22)]
    assert pii.pseudonymise(docs.limit(0), KEY).count() == 0
