"""Personal data against the plain patterns, and what the operator adds to them."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from turnwise.llm import pii, queries

SF = "/root/testdata/sf0.001"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(number):
    doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(reversed(number))]
    return sum(sum(map(int, str(d))) for d in doubled) % 10 == 0


def plain(text):
    """Base spans by the patterns as they are written in the contract."""
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [("email", m) for m in EMAIL.finditer(text)]
    found += [("ip", m) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", m) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    found += [("phone", m) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in found)


def base(text):
    return ",".join(f"{k}:{a}:{b}" for k, a, b, _, own in pii.find_spans(text) if own)


def added(text):
    return [(k, text[a:b]) for k, a, b, _, own in pii.find_spans(text) if not own]


def test_base_spans_are_those_of_the_patterns():
    rnd = random.Random(11)
    for alphabet in ("a@.-_", "a@.b_ ", "12. +", "0123456789 -", "+1 ().-", "12.@a+ -\n", "é1.@٣a"):
        for _ in range(3000):
            text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40)))
            assert base(text) == plain(text), text
    parts = ["4111111111111111", "1.2.3.4", "a@b.c", "+1 (826) 555-4081", "256.1.1.1", "007.0.0.1", " ", "-", "@", ".", "x"]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 7)))
        assert base(text) == plain(text), text


def test_added_spans():
    assert added("call +1 (826) 555-4081 190.137.223.204 now") == [("phone", "+1 (826) 555-4081")]
    assert added("4111111111111111 5500005555555559") == [("card", "4111111111111111"), ("card", "5500005555555559")]
    assert added("no 12 4111 1111 1111 1111 x") == [("card", "4111 1111 1111 1111")]
    # Fifteen digits need a word nearby, national numbers too.
    assert added("pay 378282246310005 now") == []
    assert added("amex card 378282246310005 now") == [("card", "378282246310005")]
    assert added("about 020 7946 0958 of") == []
    assert added("Phone: 020 7946 0958 of") == [("phone", "020 7946 0958")]
    assert added("order phone 020 7946 0958") == []
    # Account numbers by the remainder modulo 97.
    assert added("DE89 3704 0044 0532 0130 00 OK") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert added("DE88370400440532013000") == []
    assert added("GB82WEST12345698765432.") == [("iban", "GB82WEST12345698765432")]
    # Numbers that fail the Luhn sum, dates and versions are left alone.
    assert added("2024-01-02 10:11:12, 1.2.3, 4111111111111112, 12 34 56 78 90 12 34 56") == []


def test_words_nearby_change_the_score():
    score = lambda text: pii.find_spans(text)[0][3]
    assert score("my card 4111111111111111") > score("4111111111111111") > score("order 4111111111111111")


def test_long_texts_take_linear_time():
    for text in (
        "a" * 400_000, "@" * 400_000, "1" * 400_000, "1." * 200_000, "+1 " * 130_000, "a@b." * 100_000,
        "1 " * 200_000, "+1" + " " * 400_000, "A1 " * 130_000, "a@b.co " * 60_000, "AB12" * 100_000,
        "1.1.1.1 " * 30_000, "+1 (826) 555-4081 1.2.3.4 " * 10_000,
    ):
        pii.find_spans(text)
    many = pii.find_spans("x 1.2.3.4 4111111111111111 12 5500005555555559 y " * 3000)
    assert len(many) == 9000


def test_operator_and_query(spark, odd, documents):
    found = pii.find(odd, masked="safe")
    assert found.columns == [*odd.columns, "pii", "safe"] and found.count() == odd.count()
    assert pii.find(odd.limit(0)).count() == 0
    text = "\U0001f600 mail é.a@b.co or +1 (826) 555-4081 10.20.30.40"
    row = pii.find(documents([(1, text, "a")]), masked="text").first()
    assert row.text == "\U0001f600 mail é[email] or [phone] [ip]"
    assert {r.safe for r in found.where("text IS NULL").collect()} == {None}

    got = {r.doc_id: r for r in queries.op13_personal_data(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        want = plain(r.text or "")
        mine = got[r.doc_id]
        assert mine.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [mine.n_email, mine.n_ip, mine.n_card, mine.n_phone] == [
            len(re.findall(f"{k}:", want)) for k in pii.BASE
        ]
        assert set(filter(None, want.split(","))) <= set(mine.spans.split(","))
        assert len(list(filter(None, mine.spans.split(",")))) == mine.n_added + len(list(filter(None, want.split(","))))
