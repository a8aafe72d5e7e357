"""Functions on columns that hold JSON text. Bad JSON never raises."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnwise.functions import let

# JSON texts of an empty value, and the form of a number that is zero.
EMPTY = ("null", "false", '""', "[]", "{}")
ZERO = r"^-?0(\.0*)?([eE][-+]?[0-9]+)?$"
# The fields of a predicted entity that are read.
PREDICTED = "struct<entity_type:string,type:string,value:variant,body:string>"

def _text(v: Column, path: str = "$") -> Column:
    return F.try_variant_get(v, path, "string")


def _lead(json: Column) -> Column:
    """First character of a JSON text; it tells text, list and object apart."""
    return F.substring(F.ltrim(json, F.lit(" \t\r\n")), 1, 1)


def decoded(c: Column) -> Column:
    """The parsed value; text that was encoded twice is parsed twice. Bad JSON gives null."""
    return let(
        F.try_parse_json(c),
        lambda once: F.when(_lead(c) == '"', F.try_parse_json(_text(once))).otherwise(once),
    )


def first_tag(c: Column) -> Column:
    """JSN-1: first item of a list, ``choices[0]`` of an object, a scalar, or the raw text."""

    def pick(raw: Column, value: Column) -> Column:
        return (
            F.when(value.isNull(), raw)
            .when(_lead(raw) == "[", _text(value, "$[0]"))
            .when(_lead(raw) == "{", _text(value, "$.choices[0]"))
            .otherwise(_text(value))
        )

    def unwrap(once: Column) -> Column:
        again = let(
            _text(once), lambda inner: let(F.try_parse_json(inner), lambda v: pick(inner, v))
        )
        return F.when(once.isNotNull() & (_lead(c) == '"'), again).otherwise(pick(c, once))

    return let(F.try_parse_json(c), unwrap)


def tag_text(c: Column) -> Column:
    """JSN-2: the ``text`` field, or the raw text if it is not JSON."""
    return let(
        F.try_parse_json(c), lambda v: F.when(v.isNull(), c).otherwise(_text(v, "$.text"))
    )


def _present(v: Column) -> Column:
    """Not missing, null, '', 0, false, [] or {}."""
    return let(
        F.to_json(v), lambda j: F.coalesce(~j.isin(*EMPTY) & ~j.rlike(ZERO), F.lit(False))
    )


def build_utterances(c: Column) -> Column:
    """JSN-3: ``utterances``, else ``alternatives``; strings as they are, others as JSON text."""

    def pick(value: Column) -> Column:
        main = F.try_variant_get(value, "$.utterances", "variant")
        return F.when(_present(main), _text(main)).otherwise(_text(value, "$.alternatives"))

    return let(decoded(c), pick)


def unpack_annotation(c: Column) -> Column:
    """JSN-4: struct (tag, ls_intent, ls_entities, ls_transcription) of an annotation result.

    The last item of a kind wins; entity items are kept as one JSON list.
    """

    def unpack(items: Column) -> Column:
        named = lambda name: F.filter(items, lambda i: i["from_name"] == name)
        last = lambda name: F.try_element_at(named(name), F.lit(-1))["value"]
        listed = F.transform(named("ls_entities"), lambda i: i["value"])
        return F.struct(
            F.get_json_object(last("tag"), "$.choices[0]").alias("tag"),
            F.get_json_object(last("tag"), "$.choices").alias("ls_intent"),
            F.when(
                F.size(listed) > 0,
                F.concat(F.lit("["), F.array_join(listed, ",", "null"), F.lit("]")),
            ).alias("ls_entities"),
            F.get_json_object(last("ls_transcription"), "$.text[0]").alias("ls_transcription"),
        )

    # A string field takes a nested object as its JSON text.
    return let(F.from_json(c, "array<struct<from_name:string,value:string>>"), unpack)


def unpack_prediction(c: Column) -> Column:
    """JSN-5: struct of the best intent, its score and slots, the entities and the first guess."""

    def unpack(p: Column) -> Column:
        best = F.get(p["intents"], F.lit(0))
        return F.struct(
            best["name"].alias("intent"),
            best["score"].alias("intent_score"),
            F.coalesce(best["slots"], F.lit("[]")).alias("slots"),
            F.coalesce(p["entities"], F.lit("[]")).alias("entities"),
            p["original_intent"].alias("original_intent"),
        )

    shape = (
        "struct<intents:array<struct<name:string,score:double,slots:string>>,"
        "entities:string,original_intent:string>"
    )
    return let(F.from_json(c, shape), unpack)


def primary_transcript(c: Column) -> Column:
    """JSN-6: transcript of the best alternative of the first utterance."""
    return _text(F.try_parse_json(c), "$[0][0].transcript")


def bot_response(c: Column) -> Column:
    """JSN-6: what the bot said, from the turn context."""
    return _text(F.try_parse_json(c), "$.bot_response")


def json_slice(c: Column) -> Column:
    """JSN-7: from the first ``{`` to the last ``}``, parsed; no braces give an empty object."""
    part = F.regexp_extract(c, r"(?s)\{.*\}", 0)
    return F.try_parse_json(F.when(part == "", "{}").otherwise(part))


def annotated_entities(c: Column, source: str) -> Column:
    """JSN-8: array of (type, text); entries without a text are left out.

    ``source`` is "labelled" (type = first label) or "typed" (type = ``type``).
    """
    if source not in ("labelled", "typed"):
        raise ValueError(f"unknown annotation source {source!r}")
    items = F.from_json(c, "array<struct<type:string,text:string,labels:array<string>>>")
    if source == "labelled":
        kind = lambda i: F.lower(F.get(i["labels"], F.lit(0)))
    else:
        kind = lambda i: F.lower(F.coalesce(i["type"], F.lit("")))
    kept = F.filter(items, lambda i: F.coalesce(i["text"], F.lit("")) != "")
    pairs = F.transform(kept, lambda i: F.struct(kind(i).alias("type"), i["text"].alias("text")))
    return F.coalesce(pairs, F.array().cast("array<struct<type:string,text:string>>"))


def quoted(text: Column) -> Column:
    """A text as JSON: quoted and escaped; null gives ``null``."""
    return let(F.to_json(F.array(text)), lambda j: F.substring(j, F.lit(2), F.length(j) - 2))


def _interval(v: Column, ends: Column) -> Column:
    """An interval with its ends from and to: text ends are wrapped; wrapped ends are kept; else
    null."""
    wrap = lambda key: let(
        F.to_json(ends[key]),
        lambda j: F.when(
            j.startswith('"'), F.concat(F.lit(f'"{key}":{{"value":'), j, F.lit("}"))
        ),
    )
    holds = lambda key: _present(F.try_variant_get(ends[key], "$.value", "variant"))
    return let(
        F.concat_ws(",", wrap("from"), wrap("to")),
        lambda w: F.when(w != "", F.try_parse_json(F.concat(F.lit("{"), w, F.lit("}")))).when(
            holds("from") | holds("to"), v
        ),
    )


def _entity_value(v: Column) -> Column:
    """The value of a predicted entity."""
    return let(
        F.try_variant_get(v, "$", "struct<from:variant,to:variant>"),
        lambda ends: F.when(ends["from"].isNotNull() | ends["to"].isNotNull(), _interval(v, ends)).otherwise(v),
    )


def normalize_predicted_entities(c: Column) -> Column:
    """JSN-9: predicted entities as a JSON list of (type, value, text).

    An item is taken apart once, into a typed row, and written once.
    """

    def shaped(item: Column) -> Column:
        def write(e: Column) -> Column:
            known = F.coalesce(e["body"], e["type"], e["entity_type"]).isNotNull()
            row = F.struct(
                F.coalesce(F.nullif(e["entity_type"], F.lit("")), e["type"]).alias("type"),
                _entity_value(e["value"]).alias("value"),
                e["body"].alias("text"),
            )
            # Items without these fields, or that are no objects, count if they hold anything.
            return F.when(known | _present(item), F.to_json(row, {"ignoreNullFields": "false"}))

        return let(F.try_variant_get(item, "$", PREDICTED), write)

    items = F.try_variant_get(F.try_parse_json(c), "$", "array<variant>")
    return let(
        F.array_compact(F.transform(items, shaped)),
        lambda w: F.when(
            F.size(w) > 0, F.concat(F.lit("["), F.array_join(w, ","), F.lit("]"))
        ),
    )


def json_key(c: Column, key: str) -> Column:
    """JSN-10: value of a top-level key; an empty value counts as missing."""
    whole = F.try_parse_json(c)
    if '"' in key:
        # Such a name cannot be written in a path.
        fields = F.try_variant_get(whole, "$", "map<string,variant>")
        value = F.try_element_at(fields, F.lit(key))
    else:
        value = F.try_variant_get(whole, f'$["{key}"]', "variant")
    return let(value, lambda v: F.when(_present(v), _text(v)))


def canonical_json(c: Column) -> Column:
    """JSN-11: JSON text written anew, keys in place: no needless escapes, no blanks."""
    # get_json_object would drop the quotes of a bare string.
    return let(
        F.try_parse_json(c),
        lambda v: F.when(_lead(c) == '"', F.to_json(v)).when(
            v.isNotNull(), F.get_json_object(c, "$")
        ),
    )
