"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby adjust
their score.

The base kinds are found by their patterns and limits alone and always stay. Beyond them the
operator proposes what the base misses: card numbers and telephone numbers inside runs of
digits that failed as a whole (two numbers side by side), account numbers (IBAN) and national
telephone numbers. Those need a score: a card number the Luhn sum and an issuer's first digit,
an IBAN the remainder 1 modulo 97, a national number a word such as "phone" nearby.

Each text is worked on by itself, in time linear in its length, on Arrow batches; there is no
shuffle. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The kinds in their order; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "iban")
BASE = KINDS[:4]
SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double,base:boolean>>"
ROWS = 1000

# The patterns are those of the contract, written so that no text makes them go back far: a
# run of digits is entered at its start only, and quantifiers keep what they took.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
DIGIT_RUN = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE_RUN = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+")
NATIONAL = re.compile(r"(?<![0-9+.-])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])")
GROUP = re.compile("[0-9]+")
WORD = re.compile(r"[^\W\d_]+")
NOT_DIGITS = {ord(c): None for c in " ().+-"}
# Lengths of the groups of a written card number; one group may hold 13 to 19 digits.
CARD_GROUPS = ((4, 4, 4, 4), (4, 4, 4, 4, 1), (4, 4, 4, 4, 2), (4, 4, 4, 4, 3), (4, 6, 5), (4, 6, 4))

# Scores: what a pattern alone is worth, what confirmation adds, what words nearby change.
ENOUGH = 0.5
PATTERN = {"email": 0.8, "ip": 0.6, "card": 0.3, "phone": 0.6, "iban": 0.3}
SHORT_CARD, NATIONAL_PHONE = 0.1, 0.3
CONFIRMED = {"card": 0.3, "iban": 0.5}
STRANGE_ISSUER = 0.2
NEAR, WORDS_ADD, WORDS_TAKE = 40, 0.2, 0.2
WORDS_FOR = {
    "email": {"email", "mail", "contact", "courriel", "correo"},
    "ip": {"ip", "address", "host", "server", "login"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "carte", "karte", "tarjeta"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "fax", "telefon", "telefono", "teléfono", "téléphone"},
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta"},
}
WORDS_AGAINST = {"version", "isbn", "order", "invoice", "page", "serial", "item"}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(code: str) -> bool:
    """The check of an IBAN without blanks."""
    turned = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def emails(text: str) -> list[tuple[int, int]]:
    """From every @ backwards over the local part, forwards over the domain."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        head = text[last:at]
        local = len(head) - len(head.rstrip(LOCAL))
        last = at + 1
        if local and (domain := DOMAIN.match(text, at + 1)):
            last = domain.end()
            out.append((at - local, last))
        at = text.find("@", at + 1)
    return out


def ips(text: str) -> list[tuple[int, int]]:
    small = lambda part: len(part := part.lstrip("0")) <= 3 and int(part or 0) <= 255
    return [m.span() for m in IP.finditer(text) if all(map(small, m[0].split(".")))]


def card_runs(text: str) -> Iterator[tuple[int, int, bool]]:
    """Every run of digits, and whether it is a card number as a whole."""
    for m in DIGIT_RUN.finditer(text):
        digits = m[0].translate(NOT_DIGITS)
        yield *m.span(), 16 <= len(digits) <= 19 and luhn(digits)


def phone_runs(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in PHONE_RUN.finditer(text):
        yield *m.span(), 8 <= len(m[0].translate(NOT_DIGITS)) <= 15


def _words_near(text: str, kind: str, start: int, end: int) -> float:
    """What the words up to NEAR code points before and after a span change of its score."""
    around = text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]
    words = {w.lower() for w in WORD.findall(around)}
    return WORDS_ADD * bool(words & WORDS_FOR[kind]) - WORDS_TAKE * bool(words & WORDS_AGAINST)


def _cards_inside(text: str, start: int, end: int) -> Iterator[tuple[int, int, float]]:
    """Card numbers among the groups of a run that is none as a whole."""
    groups = [m.span() for m in GROUP.finditer(text, start, end)]
    i = 0
    while i < len(groups):
        taken = 1
        shapes = [s for s in CARD_GROUPS if s == tuple(b - a for a, b in groups[i : i + len(s)])]
        for n in sorted({1, *map(len, shapes)}, reverse=True):
            first, last = groups[i][0], groups[i + n - 1][1]
            digits = text[first:last].translate(NOT_DIGITS)
            if 13 <= len(digits) <= 19 and luhn(digits):
                score = (PATTERN["card"] if len(digits) >= 16 else SHORT_CARD) + CONFIRMED["card"]
                yield first, last, score - STRANGE_ISSUER * (digits[0] not in "3456")
                taken = n
                break
        i += taken


class _Taken:
    """Disjoint intervals in order, to ask what overlaps or follows a place."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(end, self.ends[-1])
            else:
                self.starts.append(start)
                self.ends.append(end)

    def overlaps(self, start: int, end: int) -> bool:
        i = bisect_right(self.ends, start)
        return i < len(self.starts) and self.starts[i] < end

    def next_start(self, start: int, end: int) -> int:
        """The first start after ``start`` and before ``end``, else ``end``."""
        i = bisect_right(self.starts, start)
        return min(end, self.starts[i]) if i < len(self.starts) else end

    def add(self, start: int, end: int) -> None:
        """An interval that overlaps no other."""
        i = bisect_right(self.starts, start)
        self.starts.insert(i, start)
        self.ends.insert(i, end)


def _phone_inside(text: str, start: int, end: int, taken: _Taken) -> tuple[int, int] | None:
    """The telephone number at the start of a run that holds more than it: up to the next
    other span, or else the shortest part before a blank with eight digits or more."""
    end = taken.next_start(start, end)
    end = start + len(text[start:end].rstrip(" ().-"))
    if 8 <= len(text[start:end].translate(NOT_DIGITS)) <= 15:
        return start, end
    digits = 0
    for at in range(start, end):
        digits += text[at].isdigit()
        if digits > 15:
            break
        if digits >= 8 and text[at] == " ":
            return start, start + len(text[start:at].rstrip(" ().-"))
    return None


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """The longest part up to a word's end that passes the check."""
    for m in IBAN.finditer(text):
        for end in range(m.end(), m.start() + 14, -1):
            if text[end - 1] == " " or text[end : end + 1].isalnum():
                continue
            code = text[m.start() : end].replace(" ", "")
            if 15 <= len(code) <= 34 and mod97(code):
                yield m.start(), end
                break


def find_spans(text: str | None) -> list[tuple[str, int, int, float, bool]]:
    """(kind, start, end, score, base) of all spans of a text, by kind and start.

    A null text counts as empty. Base spans stay whatever their score is and may overlap;
    an added one overlaps no other span.
    """
    text = text or ""
    score = lambda kind, a, b, worth: round(min(1.0, max(0.0, worth + _words_near(text, kind, a, b))), 3)
    confirmed = lambda kind: PATTERN[kind] + CONFIRMED.get(kind, 0)
    runs = {"card": list(card_runs(text)), "phone": list(phone_runs(text)) if "+" in text else []}
    base = {"email": emails(text), "ip": ips(text)} | {
        kind: [(a, b) for a, b, whole in runs[kind] if whole] for kind in ("card", "phone")
    }
    found = [(kind, a, b, score(kind, a, b, confirmed(kind)), True) for kind in BASE for a, b in base[kind]]
    taken = _Taken([s[1:3] for s in found])

    def add(kind: str, candidates) -> None:
        for a, b, worth in candidates:
            if not taken.overlaps(a, b) and (s := score(kind, a, b, worth)) >= ENOUGH:
                taken.add(a, b)
                found.append((kind, a, b, s, False))

    add("iban", ((a, b, confirmed("iban")) for a, b in _ibans(text)))
    add("card", (c for a, b, whole in runs["card"] if not whole for c in _cards_inside(text, a, b)))
    inside = (_phone_inside(text, a, b, taken) for a, b, whole in runs["phone"] if not whole)
    add("phone", ((*p, PATTERN["phone"]) for p in inside if p))
    add("phone", (
        (*m.span(), NATIONAL_PHONE) for m in NATIONAL.finditer(text)
        if 8 <= len(m[0].translate(NOT_DIGITS)) <= 12
    ))
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1:]))


def _masked(text: str, spans: list[tuple[str, int, int, float, bool]]) -> str:
    out, at = [], 0
    for kind, start, end, *_ in sorted(spans, key=lambda s: s[1:3]):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find(docs: DataFrame, text: str = "text", out: str = "pii", masked: str | None = None) -> DataFrame:
    """Adds the spans of a text as ``out`` and, with ``masked``, the text with each span
    replaced by its kind in brackets (of spans that overlap, the first one's; a null text
    stays null).

    Null and empty texts have no spans. Rows keep their order and columns; a column named
    like an output is replaced. Equal rows get equal results.
    """
    kept = [c for c in docs.columns if c not in (out, masked)]
    schema = StructType([docs.schema[c] for c in kept]).add(out, StructType.fromDDL(f"s {SPANS}")["s"].dataType)
    if masked:
        schema = schema.add(masked, "string")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        struct = pa.struct([
            ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()),
            ("base", pa.bool_()),
        ])
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                texts = part.column(text).to_pylist()
                spans = [find_spans(t) for t in texts]
                rows = [[dict(zip(struct.names, s)) for s in found] for found in spans]
                columns = [*(part.column(c) for c in kept), pa.array(rows, pa.list_(struct))]
                if masked:
                    hidden = [None if t is None else _masked(t, s) for t, s in zip(texts, spans)]
                    columns.append(pa.array(hidden, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select(*kept, *([] if text in kept else [text])).mapInArrow(run, schema)


def count_base(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("bigint")


def spans_text(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    name = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, name), ",")
