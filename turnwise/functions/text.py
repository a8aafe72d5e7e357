"""String functions on columns. All of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Python ``str.strip()`` removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Texts written in place of a telephone number and of four digits.
PHONE_SUBSTITUTE = "5555555555"
DIGITS_SUBSTITUTE = "1111"
# Entity types whose value is resolved by the entity service.
RESOLVED_TYPES = ("date", "time", "datetime")
# Placeholders of a prompt template.
CONTEXT_SLOT = "{{conversation_context}}"
STATE_SLOT = "{{state}}"

# A telephone number: optional country code, three digits (maybe in brackets), three, four.
PHONE = r"(?:\+[0-9]{1,3}[-. ]?)?(?:\([0-9]{3}\)|\b[0-9]{3})[-. ]?[0-9]{3}[-. ]?[0-9]{4}\b"
# These stand for a number already replaced, and for their first character in a text.
_HELD, _ESCAPED = "\ufdd0\ufdd2", "\ufdd0\ufdd1"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def strip_transcript_marks(c: Column) -> Column:
    """STR-1: delete ``<...>`` marks that do not cross a closing bracket; null gives ''."""
    return F.coalesce(strip(F.regexp_replace(c, r"<[^)]*?>", "")), F.lit(""))


def clean_utterance(c: Column) -> Column:
    """STR-2: delete tags, strip; null gives 'NA'."""
    return F.coalesce(strip(F.regexp_replace(c, r"<[^<]+?>", "")), F.lit("NA"))


def _last_segment(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def audio_filename(url: Column) -> Column:
    """STR-3: file name of a recording, with .flac and .mp3 turned into .wav."""
    name = _last_segment(F.substring_index(url, "?", 1))
    return F.regexp_replace(name, r"\.(flac|mp3)$", ".wav")


def audio_stem_wav(url: Column) -> Column:
    """STR-4: last path segment up to its first dot, plus .wav."""
    return F.concat(F.substring_index(_last_segment(url), ".", 1), F.lit(".wav"))


def url_expiry(url: Column) -> Column:
    """STR-5: first non-empty ``Expires`` query value, as seconds; null if there is none."""
    value = F.regexp_extract(url, r"^[^?#]*\?(?:[^#]*?&)?Expires=([^&#]+)", 1)
    return value.try_cast("bigint")


def url_object_key(url: Column) -> Column:
    """Path of a URL without its leading slashes."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/*([^?#]*)", 1)


def is_expired(url: Column, now: Column, bucket: str) -> Column:
    """STR-6: a signed link of the private bucket whose expiry is not after ``now``."""
    signed = url.contains("?") & url.contains("Expires") & url.contains(bucket)
    return F.coalesce(signed & (url_expiry(url) <= now), F.lit(False))


def call_link(base: str, client: Column, flow: Column, call: Column) -> Column:
    """STR-7: link to one call; null if a part is missing."""
    return F.concat(
        F.lit(base + "/clients/"), client, F.lit("/voice-agents/"), flow, F.lit("/calls/"), call
    )


def redact_numbers(c: Column) -> Column:
    """STR-8: telephone numbers first, then any four digits in a row."""
    escaped = F.replace(c, F.lit(_HELD[0]), F.lit(_ESCAPED))
    held = F.regexp_replace(escaped, PHONE, _HELD)
    masked = F.regexp_replace(held, r"\p{Nd}{4}", DIGITS_SUBSTITUTE)
    phoned = F.replace(masked, F.lit(_HELD), F.lit(PHONE_SUBSTITUTE))
    return F.replace(phoned, F.lit(_ESCAPED), F.lit(_HELD[0]))


def split_list(c: Column, sep: str = ",", cast: str | None = None) -> Column:
    """STR-9: split, strip, drop blanks, optional cast of every item."""
    quoted = "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)
    items = F.filter(F.transform(F.split(c, quoted), strip), lambda item: item != "")
    return F.transform(items, lambda item: item.try_cast(cast)) if cast else items


def normalize_situations(c: Column) -> Column:
    """STR-10: ``::``-separated situations as an array, stripped and lower-cased."""
    return F.transform(F.split(c, "::"), lambda item: F.lower(strip(item)))


def conversation_context(bot: Column, user: Column) -> Column:
    return F.concat(F.lit("[Bot]: "), bot, F.lit("  \n [User]: "), user)


def fill_prompt(template: str, bot: Column, user: Column, state: Column) -> Column:
    """STR-11: put the context, then the state, in place of the slots of the template."""
    filled = F.replace(F.lit(template), F.lit(CONTEXT_SLOT), conversation_context(bot, user))
    return F.replace(filled, F.lit(STATE_SLOT), state)


def entity_type_value(kind: Column, text: Column) -> Column:
    """STR-12: struct (type, value, text) of one tagged entity.

    ``a/b`` types hold type and value; date-like types keep a null value for the
    entity service; all others take the text (without ``~``) as value.
    """
    plain = F.replace(text, F.lit("~"), F.lit(""))
    parts = F.split(kind, "/")
    dated = kind.isin(*RESOLVED_TYPES)
    return F.struct(
        F.when(kind.contains("/"), F.get(parts, 0)).otherwise(kind).alias("type"),
        F.when(dated, F.lit(None).cast("string"))
        .when(kind.contains("/"), F.get(parts, 1))
        .otherwise(plain)
        .alias("value"),
        plain.alias("text"),
    )


def split_uri(c: Column, scheme: str = "s3") -> Column:
    """STR-13: struct (bucket, key); both null if the address does not match."""
    pattern = f"^{scheme}://(.+?)/(.+)$"
    part = lambda i: F.nullif(F.regexp_extract(c, pattern, i), F.lit(""))
    return F.struct(part(1).alias("bucket"), part(2).alias("key"))
