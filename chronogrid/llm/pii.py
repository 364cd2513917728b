"""Personal data replaced by format-preserving pseudonyms from a keyed Feistel network."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date
from hashlib import blake2b
from math import isqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronogrid.llm.kernels import free_name, prepare, text_udf

ROUNDS = 8
# Usual days are permuted among themselves, and so are all others of the years 1 to 9999.
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()
USUAL_DAYS, OTHER_DAYS = LAST_DAY - FIRST_DAY + 1, date.max.toordinal() - (LAST_DAY - FIRST_DAY + 1)

_MAIL = r"(?<![\w.+-])[\w.+-]++@\w[\w-]*(?:\.\w[\w-]*)+"
_SECRET = (
    r"(?i:\b(?:token|secret|passw(?:or)?d|api[_ -]?key|access[_ -]?key|key)\b[\"']?\s*[=:]\s*[\"']?)[\w+/.-]{12,}"
    r"|\b(?:sk|pk|ghp|gho|xoxb)[-_][A-Za-z0-9]{16,}|\bAKIA[0-9A-Z]{16}\b"
)
_IBAN = r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"
_IP = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"
_DATE = (
    r"(?<![\w./-])(?:(?:\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2})(?=[Tt]\d|(?![\w/-]|\.\d))"
    r"|(?:\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}-\d{1,2}-\d{4})(?![\w/-]|\.\d))"
)
_SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
_CARD = r"(?<![\w+])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?!\w)"
_PHONE = (
    r"(?<!\w)\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\w)"
    r"|(?<!\w)\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\w)"
    r"|(?<![\w.])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-]|\.\d)"
)
_BY_KIND = {
    kind: pattern.replace(r"\d", "[0-9]")
    for kind, pattern in {
        "email": _MAIL,
        "secret": _SECRET,
        "iban": _IBAN,
        "ip": _IP,
        "date": _DATE,
        "ssn": _SSN,
        "card": _CARD,
        "phone": _PHONE,
    }.items()
}
PATTERN = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in _BY_KIND.items()))
HINT = re.compile(r"[0-9@=]")  # every kind holds one of these or a colon


class Feistel:
    """A keyed permutation of 0..size-1 for any size: a Feistel network of additions on
    two halves of about the root of the size, walked until it lands below the size."""

    def __init__(self, key: bytes):
        self.key = blake2b(key, digest_size=32).digest()

    def permute(self, value: int, size: int, tweak: str) -> int:
        if size < 2:
            return value
        low = isqrt(size - 1) + 1
        high = -(-size // low)
        while True:
            a, b = divmod(value, low)
            for turn in range(ROUNDS):
                half, side = (b, a) if turn % 2 == 0 else (a, b)
                seed = f"{tweak}:{size}:{turn}:{half}".encode()
                mixed = int.from_bytes(blake2b(seed, key=self.key, digest_size=64).digest(), "little")
                if turn % 2 == 0:
                    a = (side + mixed) % high
                else:
                    b = (side + mixed) % low
            value = a * low + b
            if value < size:
                return value


# Alphabets within which a character is replaced: first code point and number.
_ALPHABETS = ((48, 10), (97, 26), (0xDF, 24), (0x100, 0x150))


def permute_letters(feistel: Feistel, text: str, tweak: str) -> str:
    """Replace letters and digits of a lower-case text within their alphabets, as one
    number in mixed radix; other characters and letters of other scripts stay. Long
    texts go in parts of 80 characters."""
    places = [(i, next(((f, n) for f, n in _ALPHABETS if f <= ord(c) < f + n), None)) for i, c in enumerate(text)]
    places = [(i, own) for i, own in places if own]
    out = list(text)
    for begin in range(0, len(places), 80):
        part = places[begin : begin + 80]
        value, size = 0, 1
        for i, (first, count) in part:
            value, size = value * count + ord(text[i]) - first, size * count
        value = feistel.permute(value, size, f"{tweak}/{begin}")
        for i, (first, count) in reversed(part):
            value, own = divmod(value, count)
            out[i] = chr(first + own)
    return "".join(out)


def permute_digits(feistel: Feistel, digits: str, tweak: str) -> str:
    size = 10 ** len(digits)
    return str(feistel.permute(int(digits), size, tweak)).zfill(len(digits))


def laid_out(digits: str, shape: str) -> str:
    """Put digits in place of those of `shape`."""
    source = iter(digits)
    return "".join(next(source) if c.isdigit() else c for c in shape)


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn_digit(payload: str) -> str:
    total = 0
    for place, c in enumerate(reversed(payload)):
        digit = int(c) * (2 - place % 2)
        total += digit - 9 if digit > 9 else digit
    return str(-total % 10)


def _like(shape: str, text: str) -> str:
    return "".join(c.upper() if s.isupper() and len(c.upper()) == 1 else c for s, c in zip(shape, text, strict=True))


def _email(feistel: Feistel, found: str) -> str | None:
    """Everything but the last label, whatever its case."""
    head, dot, last = found.rpartition(".")
    lower = head.lower()
    if len(lower) != len(head):
        return None
    return _like(head, permute_letters(feistel, lower, "email")) + dot + last


def _secret(feistel: Feistel, found: str) -> str | None:
    """The value after its name; hexadecimal values stay hexadecimal."""
    match = re.search(r"[\w+/.-]{12,}\Z", found)
    if match is None:
        return None
    value = match.group()
    lower = value.lower()
    if len(lower) != len(value):
        return None
    if re.fullmatch(r"[0-9a-f]+", lower):
        parts = [lower[i : i + 64] for i in range(0, len(lower), 64)]
        made = "".join(
            f"{feistel.permute(int(p, 16), 16 ** len(p), f'hex/{i}'):x}".zfill(len(p)) for i, p in enumerate(parts)
        )
    else:
        made = permute_letters(feistel, lower, "secret")
    return found[: match.start()] + _like(value, made)


def _iban_number(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text))


def _iban(feistel: Feistel, found: str) -> str | None:
    """A valid account number: the country stays, the check digits follow the new account."""
    plain = found.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _iban_number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    account = permute_letters(feistel, plain[4:].lower(), "iban").upper()
    check = 98 - _iban_number(account + plain[:2] + "00") % 97
    source = iter(f"{plain[:2]}{check:02d}{account}")
    return "".join(c if c == " " else next(source) for c in found)


def _ip(feistel: Feistel, found: str) -> str | None:
    parts = [int(p) for p in found.split(".")]
    if max(parts) > 255:
        return None
    value = 0
    for part in parts:
        value = value * 256 + part
    made = feistel.permute(value, 1 << 32, "ip")
    return ".".join(str(made >> shift & 255) for shift in (24, 16, 8, 0))


def _date(feistel: Feistel, found: str) -> str | None:
    """A date of the calendar; one day has one pseudonym in every format. With slashes
    the month comes first if it can."""
    mark = next(c for c in found if not c.isdigit())
    texts = found.split(mark)
    fields = [int(t) for t in texts]
    if len(texts[0]) == 4:
        orders = ["ymd"]
    else:
        orders = ["mdy", "dmy"] if mark == "/" else ["dmy", "mdy"]
    for order in orders:
        named = dict(zip(order, fields, strict=True))
        try:
            day = date(named["y"], named["m"], named["d"]).toordinal()
        except ValueError:
            continue
        if FIRST_DAY <= day <= LAST_DAY:
            new_day = FIRST_DAY + feistel.permute(day - FIRST_DAY, USUAL_DAYS, "date")
        else:
            place = feistel.permute(day - 1 if day < FIRST_DAY else day - 1 - USUAL_DAYS, OTHER_DAYS, "other date")
            new_day = place + 1 if place + 1 < FIRST_DAY else place + 1 + USUAL_DAYS
        made = date.fromordinal(new_day)
        new = {"y": made.year, "m": made.month, "d": made.day}
        return mark.join(str(new[c]).zfill(len(t)) for c, t in zip(order, texts, strict=True))
    return None


def _ssn(feistel: Feistel, found: str) -> str | None:
    def usable(digits: str) -> bool:
        return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"

    digits = only_digits(found)
    if not usable(digits):
        return None
    while True:  # walk on to the next valid number, which keeps this a permutation
        digits = permute_digits(feistel, digits, "ssn")
        if usable(digits):
            return laid_out(digits, found)


def _card(feistel: Feistel, found: str) -> str | None:
    """A number with a right check digit, which follows the new payload."""
    digits = only_digits(found)
    if luhn_digit(digits[:-1]) != digits[-1]:
        return None
    payload = permute_digits(feistel, digits[:-1], "card")
    return laid_out(payload + luhn_digit(payload), found)


def _phone(feistel: Feistel, found: str) -> str | None:
    """Seven to fifteen digits; the last ten at most change, so a country code stays."""
    digits = only_digits(found)
    if not 7 <= len(digits) <= 15:
        return None
    own = min(10, len(digits) - (1 if found[0] == "+" else 0))
    return laid_out(digits[:-own] + permute_digits(feistel, digits[-own:], "phone"), found)


MAKERS: dict[str, Callable[[Feistel, str], str | None]] = {
    "email": _email,
    "secret": _secret,
    "iban": _iban,
    "ip": _ip,
    "date": _date,
    "ssn": _ssn,
    "card": _card,
    "phone": _phone,
}


def _accepted(feistel: Feistel, kind: str, found: str, known: dict) -> tuple[str, str, str] | None:
    """Kind, value and pseudonym of the longest valid value that `found` begins with.

    A value that its own kind does not accept may be another kind's, or hold a further
    number behind a space.
    """
    while found:
        for other in (kind, *(k for k in MAKERS if k != kind)):
            if other != kind and not re.fullmatch(_BY_KIND[other], found):
                continue
            if (other, found) not in known:
                known[other, found] = MAKERS[other](feistel, found)
            if known[other, found] is not None:
                return other, found, known[other, found]
        found = found.rpartition(" ")[0]
        kind = next((k for k in MAKERS if re.fullmatch(_BY_KIND[k], found)), kind)
        if not re.fullmatch(_BY_KIND[kind], found):
            return None
    return None


def pseudonymise_text(feistel: Feistel, text: str, known: dict[tuple[str, str], str | None]) -> tuple[str, list[dict]]:
    """The text with pseudonyms, and the spans found: kind, start and end in the old text."""
    if HINT.search(text) is None and ":" not in text:
        return text, []
    out, spans, at, pos = [], [], 0, 0
    while (match := PATTERN.search(text, pos)) is not None:
        taken = _accepted(feistel, match.lastgroup, match.group(), known)
        if taken is None:
            pos = match.start() + len(match.group().partition(" ")[0])
            continue
        kind, found, made = taken
        out += [text[at : match.start()], made]
        at = pos = match.start() + len(found)
        spans.append({"kind": kind, "start": match.start(), "end": at})
    return "".join([*out, text[at:]]), spans


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text", spans_col: str | None = None) -> DataFrame:
    """`docs` with the personal data of whole texts replaced, all columns kept.

    E-mail addresses, named secrets, account, card, social security and phone numbers,
    IPv4 addresses and dates are validated (check digits, ranges, calendar) and replaced
    by a value of the same format; with one `key` equal values get equal pseudonyms in
    every document, and different ones different. What is not valid stays. With
    `spans_col`, that column lists kind, start and end of each replacement in the old
    text. A NULL text stays NULL with no spans, an empty one empty; repeated rows stay;
    an empty table gives an empty result. Only `text_col` is touched; other columns may
    have any names but `spans_col`.
    """
    prepare(docs.sparkSession)

    def kernel(texts: list[str]) -> dict:
        feistel, known = Feistel(key), {}
        made = [pseudonymise_text(feistel, text, known) for text in texts]
        return {"text": [m[0] for m in made], "spans": [m[1] for m in made]}

    schema = "text string, spans array<struct<kind:string,start:int,end:int>>"
    made = free_name(docs, "made")
    held = docs.withColumn(made, text_udf(kernel, schema)(F.col(text_col)))
    text = F.when(F.col(text_col).isNotNull(), F.col(f"{made}.text")).alias(text_col)
    columns = [text if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return held.select(*columns, *([F.col(f"{made}.spans").alias(spans_col)] if spans_col else []))
