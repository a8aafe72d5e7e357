"""Services: what is logged is not asked again; pace, retries and clients. Cuts and alignment."""

import os
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from registry.base import TURNS, derive
from registry.inference import TEMPLATE, entity_service, intent_service, tagged_rows
from registry.text import ZONE
from turnwise.operators import alignment, calls, datasets, evaluation, inference, skew
from turnwise.operators.answers import Pace, PerTask
from turnwise.plans import jobs

SF = "/root/testdata/sf0.001"


def counting(path, service):
    """The service, with a line in a file for each request."""

    def answer(row):
        with open(path, "a") as out:
            out.write(repr(sorted(row.items())) + "\n")
        return service(row)

    return answer


def asked(path):
    return Counter(path.read_text().splitlines())


def test_a_task_that_is_killed_asks_the_rest_only(spark, tmp_path):
    seen, killed, log = tmp_path / "seen", tmp_path / "killed", str(tmp_path / "log")

    def ask(row):
        if row["q"] == "q77" and not os.path.exists(killed):
            open(killed, "w").close()
            os._exit(1)
        with open(seen, "a") as out:
            out.write(row["q"] + "\n")
        return {"n": int(row["q"][1:]), "l": [0.5, None]}

    requests = spark.createDataFrame([(f"q{i}",) for i in range(200)], "q string")
    run = lambda: inference.run_inference(requests, ask, "n bigint, l array<double>", ["q"], tasks=3, log=log)
    with pytest.raises(Exception):
        run().collect()
    before = sum(asked(seen).values())
    assert 0 < before < 200
    for _ in range(2):
        out = run().collect()
        assert {(r.q, r.n, r.error) for r in out} == {(f"q{i}", i, None) for i in range(200)}
        assert out[0].l == [0.5, None]
        # Each request once over all runs, also those of the task that was killed half-way.
        assert sorted(asked(seen).values()) == [1] * 200


def test_failed_requests_are_asked_again_and_cut_lines_do_not_count(spark, tmp_path):
    seen, log = tmp_path / "seen", tmp_path / "log"
    down = tmp_path / "down"
    down.write_text("")

    def service(row):
        if row["q"] == "b" and down.exists():
            raise RuntimeError("down")
        return {"n": 1}

    requests = spark.createDataFrame([("a",), ("b",), ("a",)], "q string")
    run = lambda: sorted((r.q, r.n, r.error) for r in inference.run_inference(
        requests, counting(seen, service), "n bigint", ["q"], log=str(log)).collect())
    assert run() == [("a", 1, None), ("a", 1, None), ("b", None, "down")]
    down.unlink()
    for file in log.glob("*/*"):
        with open(file, "a") as out:
            out.write('["half')
    assert run() == [("a", 1, None), ("a", 1, None), ("b", 1, None)]
    assert sorted(asked(seen).values()) == [1, 2]


def test_pace_retries_and_clients(spark, tmp_path):
    made = tmp_path / "made"

    def make():
        with open(made, "a") as out:
            out.write("client\n")
        tries = Counter()

        def answer(row):
            tries[row["q"]] += 1
            if tries[row["q"]] < 3:
                raise RuntimeError("busy")
            time.sleep(0.02)
            return {"n": tries[row["q"]]}

        return answer

    requests = spark.range(40).select(F.col("id").cast("string").alias("q"))
    run = lambda **more: inference.run_inference(
        requests, PerTask(make), "n bigint", ["q"], tasks=2, at_once=5, backoff=0.001, **more)
    assert [r.n for r in run(retries=2).collect()] == [3] * 40
    assert made.read_text() == "client\n" * 2
    assert {r.error for r in run(retries=1).collect()} == {"busy"}
    pace, start = Pace(100), time.monotonic()
    for _ in range(11):
        pace.wait()
    assert 0.09 < time.monotonic() - start < 1


def test_jobs_ask_each_request_once(spark, tmp_path):
    turns, seen = derive(spark, SF, TURNS), tmp_path / "turns"
    out = jobs.tag_turns_and_calls_job(
        turns, ["21", "22"], ["31"], "https://s.example.com", "en", template=TEMPLATE,
        infer_fn=counting(seen, intent_service()),
    )
    total = out["turn_tasks"].count()
    assert sum(r["rows"] for r in out["counts"].collect() if r.level == "turn") == total
    failed = out["failed"].collect()
    assert failed and set(asked(seen).values()) == {1}
    seen = tmp_path / "entities"
    whole, failed = jobs.entity_dataset_job(
        tagged_rows(spark, SF).withColumnRenamed("event_id", "id"), "id", "labelled", counting(seen, entity_service()), ZONE)
    assert whole.count() and not failed.count() and set(asked(seen).values()) == {1}


def hashed(rows, seed):
    return sorted(rows, key=lambda k: (__import__("hashlib").md5(f"{k}|{seed}".encode()).hexdigest(), k))


def test_cuts_by_further_digits(spark, monkeypatch):
    monkeypatch.setattr(skew, "MOST_PLACES", 2)
    monkeypatch.setattr(skew, "PREFIX_DIGITS", 1)
    df = spark.range(700)
    order = hashed(range(700), 5)
    for n in (0, 1, 17, 699, 700, 900):
        assert {r.id for r in calls.limit_seeded(df, "id", n, 5).collect()} == set(order[:n])
    keyed = df.withColumn("tag", F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 5 > 0, F.concat(F.lit("l"), F.col("id") % 4)))
    for most in (100_000, 1):
        monkeypatch.setattr(skew, "MOST_STRATA", most)
        got = {r.id: (r.tag, r.split) for r in datasets.split_train_test(keyed, "id", 60, "tag", 5).collect()}
        by = {}
        for i in order:
            by.setdefault(got[i][0], []).append(got[i][1])
        assert len(by) == 6
        for sides in by.values():
            assert sides == ["train"] * (len(sides) * 60 // 100) + ["test"] * (len(sides) - len(sides) * 60 // 100)


def test_limit_with_repeated_and_null_keys(spark):
    rows = [(None if i % 3 == 0 else i % 4, i) for i in range(60)] + [(9, 1)] * 40
    df = spark.createDataFrame(rows, "k long, v long").repartition(7)
    for n in (0, 1, 5, 30, 59, 99, 100, 200):
        got = [tuple(r) for r in calls.limit_seeded(df, "k", n).collect()]
        assert len(got) == min(n, 100) and not Counter(got) - Counter(rows)
        # Whole keys but for that of the cut, and the same ones again.
        part = [k for k, c in Counter(k for k, _ in got).items() if c < Counter(k for k, _ in rows)[k]]
        assert len(part) <= 1
        assert Counter(got) == Counter(tuple(r) for r in calls.limit_seeded(df.repartition(3), "k", n).collect())


def plain_operations(ref, got):
    """The best (errors, -hits) by a whole table."""
    table = {(0, 0): (0, 0)}
    for i in range(len(ref) + 1):
        for j in range(len(got) + 1):
            ways = []
            if i:
                ways.append((table[i - 1, j][0] + 1, table[i - 1, j][1]))
            if j:
                ways.append((table[i, j - 1][0] + 1, table[i, j - 1][1]))
            if i and j:
                same = ref[i - 1] == got[j - 1]
                ways.append((table[i - 1, j - 1][0] + (not same), table[i - 1, j - 1][1] - same))
            if ways:
                table[i, j] = min(ways)
    return table[len(ref), len(got)][0], -table[len(ref), len(got)][1]


def test_alignment_in_a_band(monkeypatch):
    rnd = random.Random(6)
    pairs = [([rnd.randrange(k) for _ in range(rnd.randrange(n))], [rnd.randrange(k) for _ in range(rnd.randrange(n))])
             for k in (2, 3, 30) for n in (1, 4, 9, 40) for _ in range(60)]
    want = [plain_operations(*p) for p in pairs]
    sides = [[np.array(p[k], np.int32) for p in pairs] for k in (0, 1)]
    for cells in (alignment.CELLS, 200):
        monkeypatch.setattr(alignment, "CELLS", cells)
        for errors in ([e for e, _ in want], [None] * len(pairs)):
            for (e, hits), (ins, dels, subs, found), p in zip(want, alignment.operations(*sides, errors).tolist(), pairs):
                assert (ins + dels + subs, found) == (e, hits)
                assert found + subs + dels == len(p[0]) and found + subs + ins == len(p[1])


def test_long_pairs_with_few_errors(spark):
    rnd = random.Random(7)
    words = [f"w{rnd.randrange(900)}" for _ in range(20_000)]
    heard = [w for i, w in enumerate(words) if i % 4001] + ["more"] * 3
    df = spark.createDataFrame([(i, " ".join(words), " ".join(heard)) for i in range(4)], "id long, truth string, hypothesis string")
    start = time.monotonic()
    for r in evaluation.edit_operations(df).collect():
        assert r.insertions + r.deletions + r.substitutions == 8 and r.hits == 20_000 - 5
    assert time.monotonic() - start < 60
