import json

from pyspark.sql import functions as F

from turnwise.functions import jsons, times


def test_first_tag(column):
    cases = {
        '["a","b"]': "a",
        '{"choices":["_yes_"]}': "_yes_",
        '"[\\"a\\"]"': "a",
        '"a"': "a",
        "plain": "plain",
        "[]": None,
        "7": "7",
        '[{"b":1}]': '{"b":1}',
        '"broken': '"broken',
        "null": None,
    }
    assert column([*cases, None], jsons.first_tag) == [*cases.values(), None]


def test_tag_text(column):
    assert column(['{"text":"hi"}', "hi", None], jsons.tag_text) == ["hi", "hi", None]


def test_utterances(column):
    cells = ['{"utterances":[],"alternatives":[1]}', '{"utterances":"as is"}', json.dumps('{"alternatives":[[2]]}'), "{}", "bad", None]
    assert column(cells, jsons.build_utterances) == ["[1]", "as is", "[[2]]", None, None, None]


def test_annotation(column):
    item = lambda name, value: {"from_name": name, "value": value}
    cell = json.dumps([
        item("tag", {"choices": ["a"]}), item("tag", {"choices": ["b", "c"]}),
        item("ls_entities", {"text": "t", "labels": ["X"]}), item("ls_transcription", {"text": ["said"]}),
    ])
    full, empty, none = column([cell, "[]", None], jsons.unpack_annotation)
    assert (full.tag, json.loads(full.ls_intent), full.ls_transcription) == ("b", ["b", "c"], "said")
    assert json.loads(full.ls_entities) == [{"text": "t", "labels": ["X"]}]
    assert all(v is None for row in (empty, none) if row for v in row)


def test_prediction(column):
    cell = json.dumps({"intents": [{"name": "n", "score": 0.5, "slots": [{"k": 1}]}], "entities": []})
    full, empty, none = column([cell, "{}", None], jsons.unpack_prediction)
    assert tuple(full) == ("n", 0.5, '[{"k":1}]', "[]", None)
    assert tuple(empty) == tuple(none) == (None, None, "[]", "[]", None)


def test_slice(column):
    text = lambda c: F.to_json(jsons.json_slice(c))
    assert column(['x {"breach": true} y', "no json", "a {b} c"], text) == ['{"breach":true}', "{}", None]


def test_entities(column):
    cell = '[{"labels":["Date"],"text":"t"},{"labels":[],"text":"u"},{"text":""},{"labels":["x"]}]'
    got = column([cell, None, "bad"], jsons.annotated_entities, source="labelled")
    assert [[tuple(e) for e in row] for row in got] == [[("date", "t"), (None, "u")], [], []]
    got = column(['[{"type":"A/b","text":"t"},{"text":"u"}]'], jsons.annotated_entities, source="typed")
    assert [tuple(e) for e in got[0]] == [("a/b", "t"), ("", "u")]


PREDICTED = [
    (None, None), ("bad", None), ("[]", None), ("[{}]", None),
    ('[{"type":"date","value":"soon","body":"b"}]', [("date", "soon", "b")]),
    ('[{"entity_type":"time","type":"date","value":5,"body":"b\\n"}]', [("time", 5, "b\n")]),
    ('[{"entity_type":"","type":"date","value":""},{},{"body":"c"}]', [("date", "", None), (None, None, "c")]),
    ('[{"type":"t","value":{"from":"a"}}]', [("t", {"from": {"value": "a"}}, None)]),
    ('[{"type":"t","value":{"from":"a","to":"b","k":1}}]', [("t", {"from": {"value": "a"}, "to": {"value": "b"}}, None)]),
    ('[{"type":"t","value":{"from":"a","to":{"value":"x"}}}]', [("t", {"from": {"value": "a"}}, None)]),
    ('[{"type":"t","value":{"from":{"value":"x"},"k":1}}]', [("t", {"from": {"value": "x"}, "k": 1}, None)]),
    ('[{"type":"t","value":{"from":{"value":0},"to":{"value":""}}}]', [("t", None, None)]),
    ('[{"type":"t","value":{"from":null,"to":{"value":1}}}]', [("t", {"from": None, "to": {"value": 1}}, None)]),
    ('[{"type":"t","value":{"to":7}}]', [("t", None, None)]),
    ('[{"type":"t","value":{"k":"a"}}]', [("t", {"k": "a"}, None)]),
]


def test_predicted_entities(column):
    got = column([cell for cell, _ in PREDICTED], jsons.normalize_predicted_entities)
    listed = [json.loads(g) if g else None for g in got]
    assert [e and [(x["type"], x["value"], x["text"]) for x in e] for e in listed] == [want for _, want in PREDICTED]


def test_json_key(column):
    cells = ['{"a":0}', '{"a":"0"}', '{"a":[]}', '{"a":[null]}', '{"a":false}', '{"a":1.5}', '{"b":1}', '{"a":-0.0}', "bad", None]
    assert column(cells, jsons.json_key, key="a") == [None, "0", None, "[null]", None, "1.5", None, None, None, None]
    assert column(['{"it\'s":"x"}'], jsons.json_key, key="it's") == ["x"]
    assert column(['{"a\\"b":"x"}', "{}"], jsons.json_key, key='a"b') == ["x", None]


def test_canonical(column):
    assert column(['{"b":"\\u00e9", "a":[1, 2]}', '"\\u00e9"', "bad"], jsons.canonical_json) == ['{"b":"é","a":[1,2]}', '"é"', None]


def test_times(column):
    assert column(["2022-09-16T01:30:00+05:30", "bad", None], times.local_day) == ["2022-09-16", None, None]
    iso = ["2022-09-16T01:30:00+05:30", "2022-09-16T01:30:00.25Z", "bad"]
    assert column(iso, times.ref_epoch_ms, tz="Asia/Kolkata") == [1663272000000, 1663272000250, None]
    ends = lambda c: times.duration_end(times.ref_epoch_ms(c, "America/New_York"), F.lit(60), "America/New_York")
    assert column(iso, ends) == ["2022-09-16T01:31:00-04:00", "2022-09-16T01:31:00.250000-04:00", None]
    assert column(["1"], lambda c: times.duration_end(F.lit(0), F.lit(10**12), "UTC")) == [None]


def test_locale(column):
    langs = ["en", "en-US", "hi", None]
    assert column(langs, times.entity_locale, tz="Asia/Kolkata") == ["en_IN", "en_US", "hi", None]
    assert column(langs, times.entity_locale, tz="America/New_York") == ["en_US", "en_US", "en_US", None]


def test_probability(spark):
    import math

    rows = spark.createDataFrame([([-0.1, -0.2, -1.0, -1.0, -1.0],), ([-1.0],)], "l array<double>")
    got = [r.p for r in rows.select(times.sequence_probability(F.col("l")).alias("p")).collect()]
    assert math.isclose(got[0], math.exp(-0.3)) and got[1] == 1.0
