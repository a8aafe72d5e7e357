"""CSV files as records: headers of all files from one scan, and cells with line breaks read by
many tasks.

A text scan deals physical lines to tasks, so a task does not know whether its block starts
inside a quoted cell. Each block is therefore taken as a function of two states (outside or
inside quotes) to two states; composing these functions along a file, a prefix scan over a row
per block, gives every block its start. Then each task cuts its own lines into records, and
only the pieces of records that cross a block border are put together by a shuffle.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from turnwise.session import store

QUOTES = dict(quote='"', escape='"')
# Up to so many blocks of files (16 bytes or so each), their states are sent to all tasks.
MOST_BLOCKS = 1_000_000

_WHOLE_CELLS = re.compile(r'(?:(?:"(?:[^"]++|"")*+"|(?!"))[^,]*+,)*+')
_CLOSED = re.compile(r'"(?:[^"]++|"")*+"')
_INSIDE = re.compile(r'(?:[^"]++|"")*+')


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line that starts inside or outside a quoted cell ends inside one. A quote
    opens a cell only at its start; inside, two quotes are one character."""
    if '"' not in line:
        return inside
    at = 0
    if inside:
        at = _INSIDE.match(line).end()
        if at == len(line):
            return True
        # What stands between the closing quote and the comma belongs to the cell.
        at = line.find(",", at + 1) + 1
        if not at:
            return False
    at = _WHOLE_CELLS.match(line, at).end()
    return line.startswith('"', at) and not _CLOSED.match(line, at)


def text_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(value, file, path, block): the physical lines, in order within a block. ``path`` is
    there in the first block of a file only."""
    lines = spark.read.option("lineSep", "\n").text(list(paths))
    block = F.col("_metadata.file_block_start")
    return lines.select(
        "value", F.xxhash64("_metadata.file_path").alias("file"),
        F.when(block == 0, F.col("_metadata.file_path")).alias("path"), block.alias("block"),
    )


def _runs(batch, *keys: str) -> Iterator[tuple[int, int]]:
    """Stretches of a batch with equal keys."""
    import numpy as np

    changed = np.zeros(max(batch.num_rows - 1, 0), bool)
    for k in keys:
        values = batch.column(k).to_numpy()
        changed |= values[1:] != values[:-1]
    starts = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
    yield from ((a, b) for a, b in zip(starts, starts[1:]) if b > a)


def scan_blocks(lines: DataFrame, quoted: bool) -> DataFrame:
    """One row per block: file, path, block, the state after it if it starts outside (``f0``)
    or inside (``f1``) quotes, whether some line of it then ends outside (``closes``), whether
    one ends inside if it starts outside (``spans``), and the header record where it is the
    first block. Without ``quoted`` every line is a record."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        done, key, state = [], None, {}
        for batch in batches:
            for a, b in _runs(batch, "file", "block"):
                part = batch.slice(a, b - a)
                now = (part.column("file")[0].as_py(), part.column("block")[0].as_py())
                if now != key:
                    if key is not None:
                        done.append(state)
                    key = now
                    state = {
                        "file": now[0], "path": part.column("path")[0].as_py(), "block": now[1],
                        "f0": False, "f1": True, "closes": False, "spans": False, "header": None, "open": [],
                    }
                values = part.column("value")
                if now[1] == 0 and state["header"] is None:
                    for line in (v.as_py() for v in values):
                        state["open"].append(line)
                        if not quoted or not ends_inside("\n".join(state["open"]), False):
                            state["header"], state["open"] = "\n".join(state["open"]), []
                            break
                if quoted:
                    for line in values.filter(pc.match_substring(values, '"')).to_pylist():
                        state["f0"] = ends_inside(line, state["f0"])
                        state["f1"] = ends_inside(line, state["f1"])
                        state["closes"] |= not state["f1"]
                        state["spans"] |= state["f0"]
        if key is not None:
            done.append(state)
        names = ["file", "path", "block", "f0", "f1", "closes", "spans", "header"]
        kinds = [pa.int64(), pa.string(), pa.int64(), *[pa.bool_()] * 4, pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([s[n] for s in done], k) for n, k in zip(names, kinds)], names)

    return lines.mapInArrow(
        run,
        "file bigint, path string, block bigint, f0 boolean, f1 boolean, closes boolean, spans boolean, header string",
    )


def block_states(blocks: DataFrame) -> DataFrame:
    """Adds ``inside``, the state in which a block starts, and ``opener``, the block in which
    the record that is open there began: a prefix scan of the functions of a file's blocks.

    A block either keeps the state, turns it round, or ends in one state whatever it started
    in. So the state is that after the last block of the third kind, turned round as often as
    blocks since then do. A file has a row per block, which one task can hold.
    """
    ordered = Window.partitionBy("file").orderBy("block")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    fixed, turns = F.col("f0") == F.col("f1"), F.col("f0") & ~F.col("f1")
    upto = F.sum(turns.cast("int")).over(ordered)
    known = blocks.withColumn("_turns", upto).withColumns({
        "_value": F.last(F.when(fixed, F.col("f0").cast("int")), ignorenulls=True).over(before),
        "_at": F.last(F.when(fixed, F.col("_turns")), ignorenulls=True).over(before),
        "_before": F.lag("_turns", 1, 0).over(ordered),
    })
    turned = F.coalesce("_value", F.lit(0)) + F.col("_before") - F.coalesce("_at", F.lit(0))
    stated = known.withColumn("inside", turned % 2 == 1)
    ends = F.when(F.col("inside"), F.col("f1")).otherwise(F.col("f0"))
    opens = ends & (~F.col("inside") | F.col("closes"))
    opener = F.last(F.when(opens, F.col("block")), ignorenulls=True).over(before)
    return stated.withColumn("opener", opener).drop("_turns", "_value", "_at", "_before")


def cut_records(lines: DataFrame, pieces: bool, quoted: bool = True) -> DataFrame:
    """The records of lines with file, block, inside, opener and number: (number, text), or
    with ``pieces`` only the parts of records that cross a block border: (number, text, file,
    opener, block). The header record of a file and blank lines are left out."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ["number", "text", "file", "opener", "block"]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        key, open_, state = None, [], {}

        def tail() -> Iterator:
            # What is open at the end of a block goes on in the next one.
            if pieces and open_:
                started = state["opener"] if state["head"] else key[1]
                yield state["number"], "\n".join(open_), key[0], started, key[1]

        def cut(part) -> Iterator:
            nonlocal open_
            for line in part.column("value").to_pylist():
                if not open_ and not state["inside"] and (not quoted or '"' not in line):
                    text = line
                else:
                    open_.append(line)
                    state["inside"] = ends_inside(line, state["inside"])
                    if state["inside"]:
                        continue
                    text, open_ = "\n".join(open_), []
                if state["head"]:
                    state["head"] = False
                    if pieces:
                        yield state["number"], text, key[0], state["opener"], key[1]
                elif state["header"]:
                    state["header"] = False
                elif not pieces and text.strip():
                    yield state["number"], text.removesuffix("\r"), None, None, None

        for batch in batches:
            rows = []
            for a, b in _runs(batch, "file", "block"):
                part = batch.slice(a, b - a)
                now = (part.column("file")[0].as_py(), part.column("block")[0].as_py())
                if now != key:
                    rows += tail() if key is not None else ()
                    key, open_ = now, []
                    state = {n: part.column(n)[0].as_py() for n in ("inside", "opener", "number")}
                    state |= {"head": state["inside"], "header": now[1] == 0}
                rows += cut(part)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 5, kinds)], names)
        if key is not None and (rows := list(tail())):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    out = lines.mapInArrow(run, "number int, text string, file bigint, opener bigint, block bigint")
    return out if pieces else out.select("number", "text")


def column_names(header: str) -> list[str]:
    """The names of a header record; empty and repeated ones get their place."""
    names = next(csv.reader(io.StringIO(header.removeprefix("﻿").removesuffix("\r"))), [])
    same = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if same.count(n.lower()) > 1 else n for i, n in enumerate(names)]


def files_of(blocks: DataFrame, rank: Callable[[str], int]) -> list[Row]:
    """(path, header, spans) of each file with a line, in order: whether some record of it
    has a line break in a cell."""
    each = blocks.groupBy("file").agg(
        F.max("path").alias("path"), F.max("header").alias("header"), F.max("spans").alias("spans")
    )
    found = sorted(each.select("path", "header", "spans").collect(), key=lambda f: (rank(f.path), f.path))
    if any(f.header is None for f in found):
        raise ValueError("a header does not end within the first block of its file")
    return found


def parsed(records: DataFrame, headers: Sequence[str]) -> DataFrame:
    """Records (number, text) as columns: ``number`` tells which header a record is under.
    All cells are text; columns of several headers line up by name."""
    names = [column_names(h) for h in headers]
    schema = lambda columns: ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    cells = records.select(*[
        F.when(F.col("number") == i, F.from_csv("text", schema(columns), QUOTES)).alias(f"h{i}")
        for i, columns in enumerate(names)
    ])
    every = list(dict.fromkeys(c for columns in names for c in columns))
    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    return cells.select(*[
        F.coalesce(*[F.col(f"h{i}.{quoted(c)}") for i, columns in enumerate(names) if c in columns]).alias(c)
        for c in every
    ])


def read_multi_line(spark: SparkSession, files: Sequence[Row]) -> DataFrame:
    """The records of files with line breaks inside quoted cells; each file is read by as many
    tasks as it has blocks."""
    lines = text_lines(spark, [unquote(f.path) for f in files])
    blocks = store(scan_blocks(lines, True), "blocks")
    headers = list(dict.fromkeys(f.header for f in files))
    numbered = spark.createDataFrame([(h, i) for i, h in enumerate(headers)], "header string, number int")
    of_file = blocks.where("block = 0").join(F.broadcast(numbered), "header").select("file", "number")
    states = store(
        block_states(blocks).select("file", "block", "inside", "opener").join(of_file, "file"), "states"
    )
    ordered = lines.select("value", "file", "block")
    if states.count() <= MOST_BLOCKS:
        # Rows keep their order where only the states are sent.
        stated = ordered.join(F.broadcast(states), ["file", "block"], "left")
    else:
        stated = (
            ordered.withColumn("_line", F.monotonically_increasing_id())
            .join(states, ["file", "block"], "left").repartition("file", "block")
            .sortWithinPartitions("file", "block", "_line").drop("_line")
        )
    # The blocks of both scans are those of one plan; if they ever differ, this is an error.
    lost = F.raise_error(F.lit("the blocks of the files changed between two scans"))
    stated = stated.withColumn("number", F.coalesce("number", lost.cast("int")))
    crossing = cut_records(stated, pieces=True).groupBy("number", "file", "opener").agg(
        F.array_sort(F.collect_list(F.struct("block", "text"))).alias("l")
    )
    joined = crossing.select("number", F.regexp_replace(F.array_join("l.text", "\n"), "\r$", "").alias("text"))
    return parsed(cut_records(stated, pieces=False).unionByName(joined), headers)
