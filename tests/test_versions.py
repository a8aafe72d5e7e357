"""Versions of dimension tables with writers at the same time, call lines, runs by name."""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from registry.base import TURNS, derive
from turnwise.operators import calls, dimensions, versions
from turnwise.plans import jobs
from turnwise.sources import readers, writers
from turnwise.sources.folders import create_once, newest

DIM = "id bigint, word string, is_valid boolean"
SF = "/root/testdata/sf0.001"


def words(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "word string")


def create(spark, root, *names):
    wanted = words(spark, *names)
    return versions.update_version(spark, root, lambda dim: dimensions.get_or_create(dim, wanted, ["word"]))


def test_a_slower_writer_works_again(spark, tmp_path):
    root = str(tmp_path)
    versions.start_versions(spark.createDataFrame([(5, "a", True)], DIM), root)
    met = []

    def slow(dim):
        got = dimensions.get_or_create(dim, words(spark, "a", "b", "c"), ["word"])
        if len(met) < 2:
            met.append(create(spark, root, "b", f"other{len(met)}")[1])
        return got

    ids, version = versions.update_version(spark, root, slow)
    assert met == [2, 3] and version == 4
    table = {r.word: r.id for r in versions.read_version(spark, root).collect()}
    assert len(table) == 5 and sorted(table.values()) == [5, 6, 7, 8, 9]
    assert {r.word: r.id for r in ids.collect()} == {w: table[w] for w in "abc"}
    # Earlier versions stay as they were.
    assert [versions.read_version(spark, root, v).count() for v in (1, 2, 3)] == [1, 3, 4]


def test_writers_in_threads_share_no_id(spark, tmp_path):
    root = str(tmp_path)
    versions.start_versions(spark.createDataFrame([(1, "w0", True)], DIM), root)
    asked = [[f"w{i}", f"w{i + 1}", f"w{i + 2}"] for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(lambda names: create(spark, root, *names), asked))
    assert sorted(v for _, v in done) == [2, 3, 4, 5]
    table = versions.read_version(spark, root).collect()
    assert sorted(r.word for r in table) == [f"w{i}" for i in range(6)]
    assert sorted(r.id for r in table) == [1, 2, 3, 4, 5, 6]
    kept = {r.word: r.id for r in table}
    assert all(kept[r.word] == r.id for ids, _ in done for r in ids.collect())


def test_invalidation_between_lookup_and_insert(spark, tmp_path):
    """A word that another run makes invalid in between gets a new id, not the dead one."""
    root = str(tmp_path)
    versions.start_versions(spark.createDataFrame([(1, "a", True)], DIM), root)
    met = []

    def slow(dim):
        got = dimensions.get_or_create(dim, words(spark, "a"), ["word"])
        if not met:
            met.append(versions.update_version(spark, root, lambda d: (None, dimensions.invalidate(d, [1]))))
        return got

    ids, _ = versions.update_version(spark, root, slow)
    assert ids.first().id == 2
    assert {(r.id, r.is_valid) for r in versions.read_version(spark, root).collect()} == {(1, False), (2, True)}


def test_conflicts_end_and_empty_tables(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ValueError):
        versions.read_version(spark, root)
    empty = spark.createDataFrame([], DIM)
    assert versions.start_versions(empty, root).count() == 0
    # The second start finds a version and changes nothing.
    assert versions.start_versions(spark.createDataFrame([(1, "a", True)], DIM), root).count() == 0

    def always_late(dim):
        assert versions.commit_version(dim, root, versions.last_version(spark, root) + 1)
        return None, dim

    with pytest.raises(versions.Conflict):
        versions.update_version(spark, root, always_late, tries=2)
    assert not versions.commit_version(empty, root, 1)


def test_a_file_is_created_by_one_writer(spark, tmp_path):
    path = str(tmp_path / "log" / "1")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: create_once(spark, path, str(i)), range(24)))
    assert sum(won) == 1 and open(path).read() == str(won.index(True))
    assert [f.name for f in (tmp_path / "log").iterdir() if not f.name.endswith(".crc")] == ["1"]


def test_a_call_of_a_million_turns(spark, tmp_path):
    n = 1_000_000
    turns = spark.range(n + 200).select(
        F.when(F.col("id") < n, -1).otherwise(F.col("id") % 20).alias("call_id"), F.col("id").alias("conversation_id"),
        F.concat(F.lit("<b>bot</b> "), "id").alias("bot_response"),
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("user "), "id")).alias("primary_utterance"),
        F.concat(F.lit("call "), "id").alias("call_uuid"),
    )
    path = writers.write_call_lines(calls.call_lines(turns), str(tmp_path / "lines"), files=16)
    stored = spark.read.parquet(path)
    order = F.struct("call_id", "id", "is_user")
    files = stored.groupBy(F.input_file_name().alias("f")).agg(
        F.min(order).alias("a"), F.max(order).alias("z"), F.count("*").alias("n"), F.count_if(F.col("call_id") == -1).alias("hot")
    ).orderBy("a").collect()
    assert sum(f.n for f in files) == 2 * (n + 200) and sum(f.hot > 0 for f in files) >= 8
    assert max(f.n for f in files) < 2 * n / 4
    # Files follow each other without an overlap.
    assert all(before.z < after.a for before, after in zip(files, files[1:]))
    assert [f.f.rpartition("/")[2] for f in files] == sorted(f.f.rpartition("/")[2] for f in files)
    heads = {r.call_id: (r.call_uuid, r.n_turns) for r in calls.call_heads(turns).collect()}
    assert heads[-1] == ("call 0", 2 * n) and heads[3] == (f"call {n + 3}", 20) and len(heads) == 21
    # Short calls are the same as in a cell.
    short = turns.where("call_id >= 0")
    cells = calls.assemble_calls(short).select("call_id", F.inline("turns"))
    assert cells.exceptAll(stored.where("call_id >= 0")).count() == 0
    lines = stored.where("call_id = 3").orderBy("id", "is_user").select(calls.transcript_line()).limit(3).collect()
    assert [r[0] for r in lines] == [f"BOT: bot {n + 3}", "USER: NA", f"BOT: bot {n + 23}"]


def test_newest_run_reads_one_folder(spark, tmp_path):
    for day, run, n in (("2024-01-02", 9, 1), ("2024-01-10", 2, 2), ("2024-01-10", 11, 3)):
        spark.range(n).write.parquet(f"{tmp_path}/day={day}/run={run}")
    (tmp_path / "day=2024-02-01").mkdir()
    (tmp_path / "_SUCCESS").write_text("")
    got = readers.read_newest_run(spark, str(tmp_path))
    # Runs are numbers, and a date without a run is passed over.
    assert got.count() == 3 and {(str(r.day), r.run) for r in got.collect()} == {("2024-01-10", 11)}
    files = got.inputFiles()
    assert files and all("/day=2024-01-10/run=11/" in f for f in files)
    with pytest.raises(ValueError):
        readers.read_newest_run(spark, str(tmp_path / "none"))
    assert newest(["a", "b=2", "b=10"]) == ["a", "b=2", "b=10"] and newest(["b=2", "b=10"]) == ["b=10", "b=2"]


def test_newest_dataset_of_a_kind(spark, tmp_path):
    for hour, kind, n in ((7, "tagged", 1), (8, "tagged", 2), (9, "raw", 3)):
        writers.write_dataset(spark.range(n), str(tmp_path), "4,5", kind, datetime(2024, 1, 2, hour))
    folder = f"{tmp_path}/project/4_5"
    assert readers.read_newest_run(spark, folder, "*-tagged").count() == 2
    assert readers.read_newest_run(spark, folder).count() == 3


def test_picked_annotations_filter_the_context_scan(spark, tmp_path):
    """JN-2 at scale: the keys of the sample reach the scan of the context as a Bloom filter."""
    turns = derive(spark, SF, TURNS)
    turns.select("conversation_uuid", "intent", F.lit("{}").alias("prediction"), "audio_url", "call_url",
                 F.lit("b").alias("audio_base_path"), F.lit("p").alias("audio_path"), "call_uuid",
                 F.lit("u").alias("call_url_id"), "reftime").write.parquet(f"{tmp_path}/context")
    turns.select("conversation_uuid", "flow_id", F.lit("Live").alias("data_label"), F.lit("[]").alias("annotation_result"),
                 F.col("call_time").alias("tagged_at")).write.parquet(f"{tmp_path}/annotations")
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    run = lambda: jobs.label_store_job(
        spark.read.parquet(f"{tmp_path}/annotations"), spark.read.parquet(f"{tmp_path}/context"), "1",
        dict(start=datetime(2024, 1, 2), end=datetime(2024, 1, 28)), "https://a", "https://c", 10,
    )
    plain = run().select("conversation_uuid").collect()
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        df = run()
        text = df._jdf.queryExecution().executedPlan().toString()
        got = df.select("conversation_uuid").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "might_contain" in text and "bloom_filter_agg" in text
    assert sorted(got) == sorted(plain) and len(got) == 10
