import hashlib
import random
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from turnwise.functions import text
from turnwise.operators import calls, columns, datasets, dimensions, evaluation, filters, inference, joins, skew
from turnwise.sources import readers, writers


def md5(*parts):
    return hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_date_bounds():
    today = date(2024, 3, 10)
    assert filters.date_bounds(today=today) == (datetime(2024, 3, 10), datetime(2024, 3, 10, 23, 59, 59, 999999))
    given = dict(start=datetime(2024, 1, 1), end=datetime(2024, 1, 2), start_days=-5, end_days=3)
    assert filters.date_bounds(**given) == (datetime(2024, 1, 1), datetime(2024, 1, 2, 23, 59, 59))
    assert filters.date_bounds(start_days=-7, end_days=-1, end_hours=1, today=today)[0] == datetime(2024, 3, 3)
    with pytest.raises(ValueError):
        filters.date_bounds(start_days=1, end_days=-1, today=today)


def test_labels_keep_nulls_and_are_renamed_once(spark):
    df = spark.createDataFrame([(None,), ("a",), ("b",), ("c",)], "tag string")
    assert [r.tag for r in filters.drop_labels(df, ["a"]).collect()] == [None, "b", "c"]
    renamed = columns.alias_labels(df, {"x": ["a"], "a": ["b"]})
    assert [r.tag for r in renamed.collect()] == [None, "x", "a", "c"]
    # The same through a table, and through a list too long for an expression.
    table = spark.createDataFrame([("a", "x"), ("b", "a")], "source string, target string")
    assert sorted(str(r.tag) for r in columns.alias_labels(df, table).collect()) == ["None", "a", "c", "x"]
    many = {"x": ["a"] + [f"n{i}" for i in range(300)], "a": ["b"]}
    assert sorted(str(r.tag) for r in columns.alias_labels(df, many).collect()) == ["None", "a", "c", "x"]
    gone = filters.drop_labels(df, ["a"] + [f"n{i}" for i in range(300)])
    assert sorted(str(r.tag) for r in gone.collect()) == ["None", "b", "c"]


def test_validation_messages(spark):
    df = spark.createDataFrame([("2024-02-30", "xx", None, "j"), ("2023-01-01", "en", "r", "k"), (None, None, None, "k")],
                               "start_date string, lang string, repo string, job string")
    checked = filters.validate_rows(df, date(2024, 1, 1), required={"j": [["repo"]]})
    assert [len(r.errors) for r in checked.collect()] == [3, 1, 0]


def turns_of(spark, sizes):
    data = [(c, i, f"u{c}", f"<b>bot {i}</b>", None if i % 2 else f"me {i}") for c, n in sizes.items() for i in range(n)]
    random.Random(1).shuffle(data)
    return spark.createDataFrame(data, "call_id long, conversation_id long, call_uuid string, bot_response string, primary_utterance string")


def transcript(n, start=0):
    lines = [f"BOT: bot {i}\nUSER: {'NA' if i % 2 else f'me {i}'}" for i in range(start, n)]
    return "<call>\n" + "\n".join(lines) + "\n</call>"


def test_calls_are_whole_and_in_order(spark):
    out = calls.render_transcript(calls.assemble_calls(turns_of(spark, {1: 3, 2: 12, 3: 1})))
    assert {r.call_id: r.transcript for r in out.collect()} == {1: transcript(3), 2: transcript(12), 3: transcript(1)}


def test_a_long_call_is_one_row(spark):
    out = calls.render_transcript(calls.assemble_calls(turns_of(spark, {1: 3, 2: 950, 3: 1}))).collect()
    assert sorted(r.call_id for r in out) == [1, 2, 3]
    long_call = next(r for r in out if r.call_id == 2)
    assert [t["id"] for t in long_call.turns] == sorted(t["id"] for t in long_call.turns)
    assert len(long_call.turns) == 1900 and long_call.transcript.count("<call>") == 1


def test_lookup_join_beyond_the_broadcast_size(spark):
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = skew.lookup_join(left, right, "k")
        text = plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [k" in text
    want = [(7 if i % 3 == 0 else i % 50, i) for i in range(3000)]
    assert rows(joined.select("k", "id", F.coalesce("v", F.lit(-1)))) == sorted(
        (k, i, 2 * k if k < 40 else -1) for k, i in want
    )


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def expected_split(keyed, percent, seed):
    """{key: side} by rank in hash order within each label."""
    sides, by_label = {}, {}
    for key, label in keyed:
        by_label.setdefault(label, []).append(key)
    for keys in by_label.values():
        ranked = sorted(keys, key=lambda k: (md5(k, seed), k))
        for i, k in enumerate(ranked):
            sides[k] = "train" if i < len(ranked) * percent // 100 else "test"
    return sides


@pytest.mark.parametrize("percent", [0, 1, 50, 85, 99, 100])
def test_split_is_exact_with_a_hot_and_a_null_label(spark, percent):
    keyed = [(i, "hot" if i % 3 else None if i % 5 else f"l{i % 7}") for i in range(900)]
    df = spark.createDataFrame(keyed, "id long, tag string").repartition(5)
    got = {r.id: r.split for r in datasets.split_train_test(df, "id", percent, "tag", 4).collect()}
    assert got == expected_split(keyed, percent, 4)
    got = {r.id: r.split for r in datasets.split_train_test(df, "id", percent, seed=4).collect()}
    assert got == expected_split([(i, 0) for i, _ in keyed], percent, 4)


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(500)
    one, many = (datasets.split_train_test(df.repartition(n), "id", 70) for n in (1, 13))
    assert rows(one) == rows(many)


def test_combining_sets(spark):
    make = lambda lo, hi: spark.range(lo, hi).withColumn("tag", F.lit("t"))
    ids = lambda df: {r.id for r in df.collect()}
    new, old_train, old_test, held = make(0, 100), make(100, 110), make(110, 120), make(120, 130)
    train, test = datasets.combine_train_test(new, "id", old_train, old_test, train_percent=80)
    assert len(ids(train)) == 90 and len(ids(test)) == 30 and not ids(train) & ids(test)
    train, test = datasets.combine_train_test(new, "id", old_train, old_test, held, train_percent=80)
    assert ids(train) == set(range(110)) and ids(test) == set(range(120, 130))
    train, test = datasets.combine_train_test(new, "id", old_train, old_test, train_percent=100)
    assert ids(train) == set(range(110)) and ids(test) == set(range(110, 120))
    train, test = datasets.combine_train_test(new, "id", old_train, old_test, use_previous=False, train_percent=90)
    assert ids(train) | ids(test) == set(range(100)) and len(ids(train)) == 90
    train, test = datasets.combine_train_test(new, "id", old_train, None, initial=True, train_percent=100)
    assert ids(train) == set(range(100)) and test is None
    with pytest.raises(ValueError):
        datasets.merge_tagged_sources(None, None)


def test_serial_numbers_are_dense(spark):
    df = spark.range(2000).repartition(7)
    got = {r.id: r.n for r in skew.serial_numbers(df, "id", F.lit(11), "n").collect()}
    ranked = sorted(range(2000), key=lambda k: (md5(k, ""), k))
    assert got == {k: 11 + i for i, k in enumerate(ranked)}


def test_get_or_create(spark):
    dim = spark.createDataFrame([(1, "a", True), (2, "b", False), (3, "a", True)], "id long, k string, is_valid boolean")
    asked = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "k string")
    ids, after = dimensions.get_or_create(dim, asked, ["k"])
    found = {(r.k, r.id) for r in ids.collect()}
    assert ids.count() == 4 and ("a", 1) in found and len({i for k, i in found if k == "c"}) == 1
    assert {i for k, i in found if k in "bc"} == {4, 5}
    again_ids, again = dimensions.get_or_create(after, asked, ["k"])
    assert again.count() == after.count() == 5 and {(r.k, r.id) for r in again_ids.collect()} == found
    gone = dimensions.invalidate(after, [1, 3, 77])
    assert {r.id for r in gone.where("is_valid").collect()} == {4, 5}


def test_get_or_create_keeps_null_keys_and_attributes(spark):
    dim = spark.createDataFrame([(1, "a", None, 5)], "id long, k string, l string, client_id long")
    asked = spark.createDataFrame(
        [("a", None, 7, "x"), ("a", "b", 8, "y"), (None, "b", 9, "z"), (None, "b", None, "z")],
        "k string, l string, client_id long, note string",
    )
    ids, after = dimensions.get_or_create(dim, asked, ["k", "l"])
    got = {(r.k, r.l): r.id for r in ids.collect()}
    assert ids.count() == 4 and got["a", None] == 1 and {got["a", "b"], got[None, "b"]} == {2, 3}
    assert {(r.k, r.l): r.client_id for r in after.collect()} == {("a", None): 5, ("a", "b"): 8, (None, "b"): 9}


def test_sample_of_calls_by_hash(spark):
    turns = spark.range(900).select(F.when(F.col("id") >= 9, F.col("id") % 300).alias("call_id"), "id")
    first = spark.range(300).orderBy(skew.hash_key("id", 3), "id")
    for n in (0, 1, 70, 299, 300, 1000):
        got = {r.call_id for r in calls.sample_calls(turns, n, seed=3).collect()}
        assert got == {r.id for r in first.limit(n).collect()}


def test_first_per_key_with_a_map(spark):
    df = spark.sql("SELECT 1 AS k, 2 AS o, map('a', v) AS m FROM VALUES (3), (1), (2) AS t(v)")
    assert [r.m for r in calls.first_per_key(df, "k", ["o"]).collect()] == [{"a": 1}]


def test_date_window_in_a_zone(spark):
    df = spark.sql(
        "SELECT i, timestamp'2024-03-09 18:00:00Z' + make_dt_interval(0, i) AS ts FROM range(0, 30) AS t(i)"
    )
    near = filters.date_window(df, "ts", today=date(2024, 3, 10), zone="Asia/Kolkata")
    # The day there starts at 18:30 and ends before 18:30 of the next day.
    assert sorted(r.i for r in near.collect()) == list(range(1, 25))


def test_redaction_keeps_odd_characters(spark):
    text_in = "\ufdd0 a \ufdd0\ufdd2 b \ufdd1 12345 (212) 555-0123"
    got = spark.createDataFrame([(text_in,)], "t string").select(text.redact_numbers(F.col("t"))).first()[0]
    assert got == "\ufdd0 a \ufdd0\ufdd2 b \ufdd1 11115 5555555555"


def test_foreign_keys(spark):
    one = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id long")
    facts = spark.createDataFrame([(1, 9), (2, 9), (3, 8)], "situation_id long, prompt_id long")
    got = dimensions.record_generated(one(), one(1, 3), one(9), facts).collect()
    assert [(r.situation_id, r.prompt_id, r.id) for r in got] == [(1, 9, 1)]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def asr_rows(spark, n=150):
    rng = random.Random(3)
    text = lambda: " ".join(rng.choice("a b c d ee ff".split()) for _ in range(rng.randrange(0, 14)))
    pairs = [(0, "the cat sat on mat", "the cat on the mat x"), (1, "", "a"), (2, "a  b", None)]
    pairs += [(i, text(), text()) for i in range(3, n)]
    return pairs, spark.createDataFrame(pairs, "id long, truth string, hypothesis string").fillna("")


def test_word_errors_against_brute_force(spark, monkeypatch):
    pairs, df = asr_rows(spark)
    want = {i: (len(t.split()), len((h or "").split()), levenshtein(t.split(), (h or "").split())) for i, t, h in pairs}
    assert want[0][2] == 3
    measured = lambda: {r.id: (r.ref_words, r.hyp_words, r.errors) for r in evaluation.asr_breakdown(df).collect()}
    assert measured() == want
    # Pairs too long for the in-JVM distance take another path to the same numbers.
    monkeypatch.setattr(evaluation, "MAX_SYMBOLS", 12)
    assert measured() == want


def test_edit_operations(spark):
    pairs, df = asr_rows(spark)
    texts = {i: (t.split(), (h or "").split()) for i, t, h in pairs}
    for r in evaluation.edit_operations(df).collect():
        t, h = texts[r.id]
        assert r.insertions + r.deletions + r.substitutions == levenshtein(t, h)
        assert r.hits + r.substitutions + r.deletions == len(t)
        assert r.hits + r.substitutions + r.insertions == len(h)
        assert min(r.insertions, r.deletions, r.substitutions, r.hits) >= 0


def test_report(spark):
    data = [("a", "a")] * 3 + [("a", "b")] * 1 + [("b", "b")] * 2 + [("b", "c")] * 2 + [(None, "a"), ("a", None)]
    df = spark.createDataFrame(data, "actual string, predicted string")
    got = {r[0]: tuple(r)[1:] for r in evaluation.classification_report(df, "actual", "predicted").collect()}
    assert got["a"] == (1.0, 0.75, pytest.approx(6 / 7), 4.0)
    assert got["b"] == (pytest.approx(2 / 3), 0.5, pytest.approx(4 / 7), 4.0)
    assert got["c"] == (0.0, 0.0, 0.0, 0.0)
    assert got["accuracy"] == (0.625, 0.625, 0.625, 8.0)
    assert got["macro avg"] == (pytest.approx(5 / 9), pytest.approx(1.25 / 3), pytest.approx((6 / 7 + 4 / 7) / 3), 8.0)
    assert got["weighted avg"][1] == 0.625
    wide = evaluation.wide_confusion(evaluation.confusion_matrix(df, "actual", "predicted"), ["a", "b", "c"])
    assert rows(wide) == [("a", 3, 1, 0), ("b", 0, 2, 2)]


def test_report_counts_abstentions_where_asked(spark):
    df = spark.createDataFrame([("a", "a"), ("a", None), ("b", "a"), ("b", "b")], "y string, p string")
    recall = lambda report: {r.label: (r.precision, r.recall, r.support) for r in report.collect()}
    plain, whole = (recall(evaluation.classification_report(df, "y", "p", x)) for x in (False, True))
    assert plain["a"] == (0.5, 1.0, 1) and whole["a"] == (0.5, 0.5, 2)
    assert whole["accuracy"] == (0.5, 0.5, 4) and None not in whole


def test_entity_truth_without_a_locale(spark):
    rows = spark.sql(
        "SELECT 1L AS id, 5L AS ref_ms, CAST(NULL AS STRING) AS locale, array(named_struct('type', 'date', 'text', 'today')) AS entities"
    )
    asked = inference.entity_requests(rows, "UTC")
    answers = asked.withColumn("value", F.lit('"2024-01-01"'))
    got = inference.entity_truth(rows, answers).first()
    assert "2024-01-01" in got.truth_entities_with_duckling


def test_report_comparison(spark):
    schema = "label string, precision double, recall double, `f1-score` double, support double"
    r1 = spark.createDataFrame([("b", 1.0, 1.0, 1.0, 1.0), (None, 0.0, 0.0, 0.0, 0.0), ("accuracy", 0.5, 0.5, 0.5, 2.0)], schema)
    r2 = spark.createDataFrame([("c", 0.2, 0.2, 0.2, 3.0), ("b", 0.1, 0.1, 0.1, 1.0)], schema)
    got = evaluation.compare_classification_reports(r1, r2).collect()
    assert [r.label for r in got] == ["b", "c", "accuracy", "macro avg", "weighted avg"]
    assert [tuple(r.precision) for r in got] == [(1.0, 0.1), (None, 0.2), (0.5, None), (None, None), (None, None)]
    assert evaluation.compare_classification_reports(r1) is r1


def test_confusion_comparison(spark):
    schema = "actual string, predicted string, n long"
    m1 = spark.createDataFrame([("a", "a", 2), ("a", "b", 1)], schema)
    m2 = spark.createDataFrame([("b", "a", 5), ("c", "c", 4)], schema)
    assert rows(evaluation.compare_confusion(m1, m2)) == [("a", "a", 2, 0), ("a", "b", 1, 0), ("b", "a", 0, 5), ("c", "c", None, 4)]


def test_inference_survives_failing_requests(spark):
    def service(row):
        if row["prompt"] == "boom":
            raise RuntimeError("down")
        return {"n": len(row["prompt"])}

    asked = spark.createDataFrame([("a",), ("boom",), ("abc",)], "prompt string")
    out = inference.run_inference(asked, service, "n bigint", ["prompt"], tasks=2)
    assert {(r.prompt, r.n, r.error) for r in out.collect()} == {("a", 1, None), ("boom", None, "down"), ("abc", 3, None)}


def test_entity_values(spark):
    cells = [
        '[{"dim":"time","value":{"value":"2024-02-01T10:00:00"}}]', '[{"dim":"time","value":{"value":"someday"}}]',
        '[{"dim":"time","value":{"from":{"value":"a"}}}]', '[{"dim":"number","value":{"value":7}}]', "[]", "bad", None,
        '[{"dim":"duration","value":{"value":1,"normalized":{"unit":"second","value":60}}}]',
    ]
    df = spark.createDataFrame([(i, c, "2024-05-06" if i == 1 else "x", 0) for i, c in enumerate(cells)], "i int, response string, text string, ref_ms long")
    got = [r.value for r in inference.entity_values(df, "Asia/Kolkata").orderBy("i").collect()]
    assert got == ['"2024-02-01T10:00:00"', '"2024-05-06T00:00:00.000000"', '{"from":{"value":"a"}}', None, None, None, None, '"1970-01-01T05:31:00+05:30"']


def test_annotation_jobs(spark):
    jobs = spark.createDataFrame([("1", datetime(2024, 1, 1)), ("2", datetime(2024, 1, 2)), ("3", datetime(2024, 1, 3))], "job_id string, tagged_at timestamp_ntz")
    assert readers.read_annotation_jobs(jobs, "1, 2").count() == 2
    assert readers.read_annotation_jobs(jobs, "1,2,3", end=datetime(2024, 1, 2)).count() == 2
    assert readers.read_annotation_jobs(jobs, "1,2,3", datetime(2000, 1, 1), start_days=-1, end_days=-1, today=date(2024, 1, 3)).count() == 1
    assert readers.read_annotation_jobs(jobs, "", empty_possible=True).count() == 0
    with pytest.raises(ValueError):
        readers.read_annotation_jobs(jobs, "")


def test_csv_union(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"two\nlines"\nNA,"q""q"\n')
    (tmp_path / "b.csv").write_text("y,z\n3,4\n")
    got = readers.read_csv_union(spark, f"{tmp_path}/a.csv, {tmp_path}/b.csv")
    assert {tuple(r) for r in got.collect()} == {("1", "two\nlines", None), (None, 'q"q', None), (None, "3", "4")}
    assert readers.read_csv_union(spark, "", empty_possible=True).count() == 0
    with pytest.raises(ValueError):
        readers.read_csv_union(spark, " , ")


def test_text_documents(spark, tmp_path):
    for name in ("7_a_b_c.txt", "7_a_b_c_d.txt", "8_a_b.txt", "x_a_b_c.txt"):
        (tmp_path / name).write_text(f"in {name}\nend")
    got = readers.read_text_documents(spark, str(tmp_path))
    assert {(r.situation_id, r.content) for r in got.collect()} == {(7, "in 7_a_b_c.txt\nend"), (7, "in 7_a_b_c_d.txt\nend")}


def test_dataset_names(spark, tmp_path):
    at = datetime(2024, 5, 6, 7, 8, 9)
    assert writers.dataset_path("/r/", "1,2", "t", at) == "/r/project/1_2/2024-05-06/1_2-07-08-09-t"
    path = writers.write_dataset(spark.range(3), str(tmp_path), "a", "t", at)
    assert writers.write_dataset(spark.range(4), str(tmp_path), "a", "t", at) == path
    assert spark.read.parquet(path).count() == 4


def test_overlay_keeps_all_matches(spark):
    base = spark.createDataFrame([("https://h/a.flac?x=1", "old", 1), ("https://h/b.wav", "old", 2)], "audio_url string, alternatives string, n int")
    preds = spark.createDataFrame([("a.mp3", '[ "x" ]', 5), ("a.wav", '["y"]', 6)], "filename string, asr_predictions string, n int")
    got = joins.overlay_predictions(base, preds)
    assert {(r.filename, r.alternatives, r.n, r.n_sqlite) for r in got.collect()} == {("a.wav", '["x"]', 1, 5), ("a.wav", '["y"]', 1, 6)}


def test_checked_append(spark):
    full = dict(call_uuid="c", audio_url="a", call_url=None, flow_uuid=None, client_uuid=None, reftime="2024-01-01 00:00:00",
                is_breach="true", compliance_output="o", tokens_consumed="3", call_information="i")
    bad = [dict(full, call_uuid=None), dict(full, tokens_consumed="x"), dict(full, compliance_output="o" * 5001), dict(full, is_breach=None)]
    df = spark.createDataFrame([full, *bad], ", ".join(f"{c} string" for c in full))
    accepted, rejected = writers.validated_append(df)
    assert accepted.count() == 1 and accepted.first().tokens_consumed == 3 and rejected.count() == 4
    assert calls.count_breaches(accepted).first().breaches == 1


def test_fanout_sends_every_row_to_every_project(spark):
    tasks, counts = writers.tagging_fanout(spark.range(10), [1, 2])
    assert Counter(r.project_id for r in tasks.collect()) == {"1": 10, "2": 10}
    assert rows(counts) == [("1", 10), ("2", 10)]


def test_inference_leaves_large_ids_and_nulls_alone(spark):
    from turnwise.operators import inference

    rows = spark.createDataFrame([(2**53 + 1, "a"), (None, "b")], "id long, q string").coalesce(1)
    seen = lambda row: {"said": f"{row['id']}{row['q']}"}
    out = inference.run_inference(rows, seen, "said string", ["id", "q"]).collect()
    assert {(r.id, r.said) for r in out} == {(2**53 + 1, f"{2**53 + 1}a"), (None, "Noneb")}
