"""Personal data in texts: expressions propose spans, checksums confirm them, nearby context words adjust the score.

Each kind has a proposing pattern and a validator; a span that fails its validator is dropped and its text is
not tried again. Only an IBAN, which may run on into other capitals and digits, ends where its country's length says
(or, for an unknown country, at the last end of a token that is valid), and the search goes on within what failed. Base kinds (email, ip, card, phone) are reported whenever valid. Further kinds are less certain by
themselves and are reported only at a score of ``REPORT_AT``: an IBAN must pass mod-97, a social security number
must stand near a context word. The score starts at the kind's own certainty; a context word within
``CONTEXT_CHARS`` characters before or after adds ``CONTEXT_BONUS``.

Every pattern is linear in the text's length: proposals start at characters that can only start a span, and
repeats are possessive, so long runs of one character cost no more than other text.

Defined results: a null or empty text has no spans; rows are independent, so repeated rows and null ids get
results of their own; only id and text are read. Positions count code points, ends are exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("iban", "ssn")
KINDS = BASE_KINDS + EXTRA_KINDS

REPORT_AT = 0.5
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.3

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_IBAN_REST = re.compile(r"(?:[ ]?[A-Z0-9]){0,30}+")
_IBAN_LEAST, _IBAN_MOST = 15, 34
#: Signs of an IBAN by country, from the registry.
_IBAN_SIGNS = {
    country: signs
    for signs, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

#: Certainty of a valid span without context.
_BASE_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.7, "ssn": 0.3}
_CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "mastercard", "credit", "payment"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "bank", "account"),
    "ssn": ("ssn", "social security", "social-security"),
}
_CONTEXT_RE = {kind: re.compile(r"\b(?:" + "|".join(words) + r")\b", re.IGNORECASE) for kind, words in _CONTEXT.items()}


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _digits(span: str) -> str:
    return "".join(c for c in span if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain, found from each @ outwards."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        # No local part reaches back over an @ or into an earlier match.
        floor = domain.end() if domain else at + 1
        at = text.find("@", floor)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Valid IBANs from left to right, each ending at the end of a token."""
    match = _IBAN_START.search(text)
    while match:
        start, tail = match.start(), _IBAN_REST.match(text, match.end()).end()
        # Ends of all leading parts, by their number of signs.
        ends = [at + 1 for at in range(start, tail) if text[at] != " "]
        known = _IBAN_SIGNS.get(match[0][:2])
        sizes = range(_IBAN_MOST, _IBAN_LEAST - 1, -1) if known is None else (known,)
        end = next((ends[n - 1] for n in sizes if n <= len(ends) and _ends_token(text, ends[n - 1]) and mod97(text[start : ends[n - 1]].replace(" ", ""))), None)
        if end:
            yield start, end
        match = _IBAN_START.search(text, end or match.end())


def _ends_token(text: str, at: int) -> bool:
    return not (text[at : at + 1].isascii() and text[at : at + 1].isalnum())


def _valid_ip(span: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in span.split("."))


def _valid_card(span: str) -> bool:
    digits = _digits(span)
    return 16 <= len(digits) <= 19 and luhn(digits)


def _valid_phone(span: str) -> bool:
    return 8 <= len(_digits(span)) <= 15


def _matches(pattern: re.Pattern, valid: Callable[[str], bool]) -> Callable[[str], Iterator[tuple[int, int]]]:
    return lambda text: (m.span() for m in pattern.finditer(text) if valid(m[0]))


#: Per kind: a character class a text must hold, and the finder.
_FINDERS: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = {
    "email": _emails,
    "ip": _matches(_IP, _valid_ip),
    "card": _matches(_CARD, _valid_card),
    "phone": _matches(_PHONE, _valid_phone),
    "iban": _ibans,
    "ssn": _matches(_SSN, lambda s: s[:3] not in ("000", "666") and s[0] != "9" and s[4:6] != "00" and s[7:] != "0000"),
}
_DIGIT = re.compile("[0-9]")


def spans_of(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of every reported span, by kind as listed, then start."""
    found = []
    numbers = bool(_DIGIT.search(text))
    for kind in KINDS:
        if kind != "email" and not numbers:
            continue
        for start, end in _FINDERS[kind](text):
            around = text[max(0, start - CONTEXT_CHARS) : start] + "\n" + text[end : end + CONTEXT_CHARS]
            score = min(1.0, _BASE_SCORE[kind] + CONTEXT_BONUS * bool(_CONTEXT_RE[kind].search(around)))
            if kind in BASE_KINDS or score >= REPORT_AT:
                found.append((kind, start, end, round(score, 3)))
    return found


_SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"
_SPAN_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
)


def find_pii(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id and ``spans``, an array of (kind, start, end, score)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in spans_of(text)] if text else []
                for text in (value.as_py() for value in batch.column(1))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPAN_TYPE)], names=["id", "spans"])

    slim = docs.select(docs[id_column].alias("id"), docs[text_column].cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", slim.schema["id"].dataType), T.StructField("spans", T._parse_datatype_string(_SPAN))])
    return slim.mapInArrow(scan, schema).withColumnRenamed("id", id_column)


def masked(text: str | None) -> str | None:
    """The text with every reported span replaced by its kind in angle brackets; overlaps go to the earlier span."""
    if not text:
        return text
    parts, done = [], 0
    for kind, start, end, _ in sorted(spans_of(text), key=lambda s: (s[1], -s[2])):
        if start >= done:
            parts += [text[done:start], f"<{kind}>"]
            done = end
    return "".join(parts) + text[done:]


def digest(spans: list[str]) -> str:
    return hashlib.sha256(",".join(spans).encode()).hexdigest()
