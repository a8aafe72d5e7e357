"""Readers on files that are cut into many blocks, and partitioned SQLite files."""

import csv
import io
import random
import sqlite3

import pytest
from pyspark.sql import functions as F

from turnwise.sources import readers, records, sqlite, writers


@pytest.fixture
def small_blocks(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def rows_of(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def made(rnd, n, breaks=True):
    pieces = ["a", "b c", ",", '"', "é", "", "x" * 30] + (["\n", "\r\n", "\n\n"] if breaks else [])
    cell = lambda: "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 6)))
    return [[f"k{i}", cell(), cell()] for i in range(n)]


def write(path, header, rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows([header, *rows])
    path.write_bytes(out.getvalue().encode())


def missing(cell):
    return None if cell in readers.NA_VALUES else cell


def test_quote_states_of_lines():
    cases = {
        "a,b": (False, True), '"a': (True, False), 'a"b,c"d': (False, False), '"a""b",c': (False, True),
        '","': (False, True), 'x,"': (True, False), '"a"b"c,"d': (True, False), '""': (False, True), '"""': (True, False),
    }
    for line, (outside, inside) in cases.items():
        assert records.ends_inside(line, False) == outside, line
    rnd = random.Random(2)
    for _ in range(3000):
        line = "".join(rnd.choice('a,"') for _ in range(rnd.randint(0, 12)))
        # Inside is what follows an open cell.
        assert records.ends_inside(line, True) == records.ends_inside('"' + line, False), line


@pytest.mark.parametrize("size", ["300b", "4k", "128m"])
def test_cells_with_line_breaks_in_many_blocks(spark, tmp_path, small_blocks, size):
    rnd = random.Random(5)
    first, second, third = made(rnd, 400), made(rnd, 300), made(rnd, 5)
    third[2][1] = "long\n" * 900 + '"'
    write(tmp_path / "a.csv", ["k", "s", "t"], first)
    write(tmp_path / "b.csv", ["t", "k", "u"], [[r[1], r[0], r[2]] for r in second], "\r\n")
    write(tmp_path / "c.csv", ["k", "s", "t"], third)
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "header.csv").write_bytes(b"only,k\n")
    small_blocks(size)
    got = readers.read_csv_union(spark, str(tmp_path))
    assert got.columns == ["k", "s", "t", "u", "only"]
    want = [(k, s, t, None, None) for k, s, t in first + third] + [(k, None, t, u, None) for k, t, u in second]
    assert rows_of(got) == sorted(str(tuple(c if c is None else missing(c) for c in r)) for r in want)
    if size == "300b":
        blocks = records.scan_blocks(records.text_lines(spark, [str(tmp_path)]), True)
        assert blocks.groupBy("path").count().count() >= 4 and blocks.count() > 30
        assert records.text_lines(spark, [str(tmp_path)]).rdd.getNumPartitions() > 30


def test_columns_of_one_folder_line_up_by_name(spark, tmp_path):
    rows = made(random.Random(6), 50, breaks=False)
    write(tmp_path / "a b.csv", ["k", "s", "t"], rows)
    write(tmp_path / "b.csv", ["s", "t", "k"], [[r[1], r[2], r[0]] for r in rows])
    for multi_line in (True, False):
        got = readers.read_csv_union(spark, str(tmp_path), multi_line=multi_line)
        assert rows_of(got) == sorted(str(tuple(map(missing, r))) for r in rows * 2)
        assert got.columns == ["k", "s", "t"]


def test_header_names(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿k,,a`b,K,"x\ny"\r\n1,2,3,4,5\r\n\r\n6,7\r\n'.encode())
    got = readers.read_csv_union(spark, str(tmp_path), na_values=())
    assert got.columns == ["k0", "_c1", "a`b", "K3", "x\ny"]
    assert rows_of(got) == sorted(map(str, [("1", "2", "3", "4", "5"), ("6", "7", None, None, None)]))
    assert readers.read_csv_union(spark, [], empty_possible=True).columns == []


def shard(path, first, n):
    with sqlite3.connect(path) as con:
        con.execute("CREATE TABLE calls (id INTEGER PRIMARY KEY, name TEXT, score REAL, data BLOB, kind VARCHAR(9))")
        rows = [(i, None if i % 7 == 0 else f"n{i % 5}", i / 4, bytes([i % 256]), "a'b" if i % 2 else "c") for i in range(first, first + n)]
        con.executemany("INSERT INTO calls VALUES (?, ?, ?, ?, ?)", rows)
    con.close()
    return rows


def test_sqlite_files_in_key_ranges(spark, tmp_path):
    rows = shard(tmp_path / "a.db", 0, 1000) + shard(tmp_path / "b.db", 5000, 10)
    before = spark.conf.get(sqlite.PUSHDOWN)
    try:
        for pushed in ("true", "false"):
            spark.conf.set(sqlite.PUSHDOWN, pushed)
            read = lambda where=None, columns=None: readers.read_table(
                spark, "calls", columns, where, sqlite={"path": str(tmp_path), "partitions": "4"}
            )
            whole = read()
            assert [f.dataType.simpleString() for f in whole.schema] == ["bigint", "string", "double", "binary", "string"]
            assert whole.rdd.getNumPartitions() >= 5
            assert rows_of(whole.withColumn("data", F.hex("data"))) == sorted(str((*r[:3], r[3].hex().upper(), r[4])) for r in rows)
            wheres = [
                ((F.col("id") >= 990) & (F.col("id") < 5003), lambda r: 990 <= r[0] < 5003),
                ((F.col("name") == "n3") & (F.col("kind") == "a'b"), lambda r: r[1] == "n3" and r[4] == "a'b"),
                (F.col("name").isNull(), lambda r: r[1] is None),
                (F.col("name").isin("n1", "n2") & (F.col("score") <= 60.5), lambda r: r[1] in ("n1", "n2") and r[2] <= 60.5),
                (~F.col("name").eqNullSafe("n1"), lambda r: r[1] != "n1"),
                (F.col("name").startswith("n") & (F.length("name") == 2) & (F.col("id") > 900), lambda r: r[1] and r[0] > 900),
            ]
            for where, keeps in wheres:
                got = read(where, ["id", "name"])
                assert rows_of(got) == sorted(str(r[:2]) for r in rows if keeps(r))
            text = read(wheres[0][0])._jdf.queryExecution().executedPlan().toString()
            assert ("Filter (" not in text) == (pushed == "true")
    finally:
        spark.conf.set(sqlite.PUSHDOWN, before)


def test_sqlite_columns_and_odd_tables(spark, tmp_path):
    shard(tmp_path / "a.db", 0, 20)
    read = lambda **more: readers.read_table(spark, "calls", sqlite={"path": str(tmp_path / "a.db"), **more})
    assert readers.read_table(spark, "calls", ["name"], sqlite={"path": str(tmp_path / "a.db")}).columns == ["name"]
    assert read(key="id", partitions="100").count() == 20
    with sqlite3.connect(tmp_path / "e.db") as con:
        con.execute("CREATE TABLE calls (id INTEGER, name TEXT, score REAL, data BLOB, kind TEXT)")
    con.close()
    assert readers.read_table(spark, "calls", sqlite={"path": str(tmp_path / "e.db")}).count() == 0
    with sqlite3.connect(tmp_path / "w.db") as con:
        con.execute("CREATE TABLE t (k TEXT, v INTEGER, PRIMARY KEY (k)) WITHOUT ROWID")
        con.executemany("INSERT INTO t VALUES (?, ?)", [("a", 1), ("b", None)])
    con.close()
    assert rows_of(readers.read_table(spark, "t", sqlite={"path": str(tmp_path / "w.db")})) == ["('a', 1)", "('b', None)"]
    with pytest.raises(Exception, match="no such table|no table"):
        readers.read_table(spark, "x", sqlite={"path": str(tmp_path / "a.db")}).count()


def test_a_batch_written_twice_adds_nothing(spark, tmp_path):
    table = {"k": ("int", None, True), "s": ("string", 3, False)}
    rows = lambda values: spark.createDataFrame(values, "k string, s string")
    batches = [("07", [("1", "a"), ("x", "b"), ("2", "long")]), ("b", [("3", None)]), ("07", [("1", "a"), ("x", "b"), ("2", "long")])]
    for batch, values in batches:
        accepted, rejected = writers.append_batch(rows(values), str(tmp_path), batch, table)
    assert rows_of(accepted) == ["(1, 'a', '07')", "(3, None, 'b')"]
    assert sorted((r.k, len(r.errors), r.batch) for r in rejected.collect()) == [("2", 1, "07"), ("x", 1, "07")]
    with pytest.raises(ValueError):
        writers.append_batch(rows([]), str(tmp_path), "a/b", table)
