import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnwise.functions import text

PREFIX = "https://rec.example.com/calls/7/"
NAME = "turn-41_b"
QUERY = "?Key=own&Sig=a%2Fb%3D&Expires=1700000123"


def test_audio_filename(column):
    urls = [f"{PREFIX}{NAME}.flac{QUERY}", f"{PREFIX}{NAME}.flac", f"{PREFIX}{NAME}.wav", f"{PREFIX}{NAME}.mp3"]
    assert column(urls, text.audio_filename) == [f"{NAME}.wav"] * 4


def test_url_expiry(column):
    urls = [f"{PREFIX}{NAME}.flac{QUERY}", f"{PREFIX}{NAME}.flac", "h?Expires=&Expires=5#Expires=6", "h#?Expires=1", None]
    assert column(urls, text.url_expiry) == [1700000123, None, 5, None, None]


def test_expired_links(column):
    url = f"https://private.s3.example.com/a/b.flac{QUERY}"
    check = lambda now: column([url, "https://private/x", None], text.is_expired, now=F.lit(now), bucket="private")
    assert check(1700000123) == [True, False, False]
    assert check(1700000122) == [False, False, False]
    # A link signed for seven days from now is not expired.
    assert column([f"https://private/x?Expires={1700000123 + 604800}"], text.is_expired,
                  now=F.lit(1700000123), bucket="private") == [False]
    assert column([url], text.url_object_key) == ["a/b.flac"]


def test_marks(column):
    texts = ["hi <noise> a", "a <b) c> d", None, "<a><b> x　", "<a <b> c"]
    assert column(texts, text.strip_transcript_marks) == ["hi  a", "a <b) c> d", "", "x", "c"]


def test_clean_utterance(column):
    texts = [None, "<speak>yes</speak> ", "a < b", "<p\nq>x"]
    assert column(texts, text.clean_utterance) == ["NA", "yes", "a < b", "x"]


def test_file_stem(column):
    assert column(["https://h/p/u-1.tar.gz", None], text.audio_stem_wav) == ["u-1.wav", None]


def test_redaction(column):
    texts = ["pin 12345", "call +1 (743) 555-3824 or 5551234567", "card 4785380592391139", "12:30", None]
    assert column(texts, text.redact_numbers) == [
        "pin 11115", "call 5555555555 or 5555555555", "card 1111111111111111", "12:30", None
    ]


def test_lists(column):
    assert column(["a, ,b,", "", None], text.split_list) == [["a", "b"], [], None]
    assert column(["1, x ,2"], text.split_list, cast="int") == [[1, None, 2]]
    assert column([" A :: b::"], text.normalize_situations) == [["a", "b", ""]]


def test_prompt(spark):
    t = "{{state}}|{{conversation_context}}"
    row = spark.range(1).select(text.fill_prompt(t, F.lit("hi"), F.lit("yo"), F.lit("S")).alias("p")).first()
    assert row.p == "S|[Bot]: hi  \n [User]: yo"


def test_uri(column):
    assert [tuple(r) for r in column(["s3://b/k/l.csv", "s3://b", "x"], text.split_uri)] == [
        ("b", "k/l.csv"), (None, None), (None, None)
    ]


def test_empty_situation_arguments_are_an_error(spark):
    from turnwise.operators.dimensions import situation_rows

    rows = spark.createDataFrame([("a", "", "c")], "s string, scenario string, category string")
    with pytest.raises(Exception, match="must not be empty"):
        situation_rows(rows, "s", "scenario", "category").collect()


texts = st.lists(st.text(alphabet="ab<>) \n 　", max_size=12), min_size=60, max_size=60)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts)
def test_marks_against_python(column, values):
    want = [re.sub(r"\<[^)]*?\>", "", v).strip() for v in values]
    assert column(values, text.strip_transcript_marks) == want
    want = [re.sub("<[^<]+?>", "", v).strip() for v in values]
    assert column(values, text.clean_utterance) == want
