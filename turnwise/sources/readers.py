"""Sources: CSV lists, text folders, tables, annotation jobs."""

from __future__ import annotations

import fnmatch
from collections.abc import Iterable, Sequence
from datetime import date, datetime
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from turnwise.operators.filters import date_bounds
from turnwise.session import store
from turnwise.sources import records
from turnwise.sources.folders import child_names, newest
from turnwise.sources.sqlite import read_sqlite

# CSV cells that count as missing.
NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Fixed value: least number of ``_`` parts in the name of a conversation file.
NAME_PARTS = 4


def split_paths(paths: str | Iterable[str]) -> list[str]:
    listed = paths.split(",") if isinstance(paths, str) else list(paths)
    return [p.strip() for p in listed if p.strip()]


def read_csv_union(
    spark: SparkSession,
    paths: str | Iterable[str],
    empty_possible: bool = False,
    na_values: Sequence[str] = NA_VALUES,
    multi_line: bool = True,
) -> DataFrame:
    """SRC-1: a list of CSV paths, stacked by column name; all cells are text.

    Files are grouped by their header, which one scan gets for all of them, so columns line
    up by name whatever folder a file is in. Cells of ``na_values`` are missing. With
    ``multi_line`` a cell may hold line breaks: a first scan finds the quoted cells that
    cross block borders, so that a large file is still read by many tasks. Lines end with
    a line feed, maybe after a carriage return. A file without a line gives nothing.
    """
    listed = split_paths(paths)
    if not listed:
        if empty_possible:
            return spark.createDataFrame([], StructType([]))
        raise ValueError("no CSV path given")
    blocks = store(records.scan_blocks(records.text_lines(spark, listed), multi_line), "blocks")
    place = lambda path: next((i for i, p in enumerate(listed) if p.strip("/") in path), len(listed))
    files = records.files_of(blocks, place)
    if not files:
        return spark.createDataFrame([], StructType([]))
    # Files whose records are lines are read as such, with pruned columns.
    plain = {f.header: [unquote(g.path) for g in files if g.header == f.header and not g.spans] for f in files}
    kind = lambda header: StructType([StructField(c, StringType()) for c in records.column_names(header)])
    parts = [
        spark.read.schema(kind(header)).csv(paths, header=True, **records.QUOTES)
        for header, paths in plain.items() if paths
    ]
    if any(f.spans for f in files):
        parts.append(records.read_multi_line(spark, [f for f in files if f.spans]))
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    every = dict.fromkeys(c for header in plain for c in records.column_names(header))
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    table = table.select(*[quoted(c) for c in every])
    if not na_values:
        return table
    held = lambda c: F.when(~quoted(c).isin(list(na_values)), quoted(c))
    return table.select(*[held(c).alias(c) for c in table.columns])


def read_text_documents(spark: SparkSession, folder: str) -> DataFrame:
    """SRC-2: (situation_id, file_name, content), one row per file of a folder.

    Only names ``<id>_a_b_c...`` with a whole number as id are kept.
    """
    files = spark.read.option("pathGlobFilter", "*_*_*_*").text(folder, wholetext=True)
    named = files.select(F.col("value").alias("content"), F.col("_metadata.file_name"))
    parts = F.split("file_name", "_")
    return (
        named.where(F.size(parts) >= NAME_PARTS)
        .select(F.get(parts, 0).try_cast("bigint").alias("situation_id"), "file_name", "content")
        .where("situation_id is not null")
    )


def read_table(
    spark: SparkSession,
    source: str,
    columns: Sequence[str] | None = None,
    where: Column | None = None,
    jdbc: dict[str, str] | None = None,
    predicates: Sequence[str] | None = None,
    fetchsize: int = 1000,
    sqlite: dict[str, str] | None = None,
) -> DataFrame:
    """SRC-3: a filtered, column-pruned table scan.

    ``source`` is a parquet path, with ``jdbc`` (url, user, ...) a database table, or with
    ``sqlite`` (path, key, partitions) a table of SQLite files, read in ranges of a key.
    ``predicates`` are non-overlapping conditions; each one is a partition of its own.
    """
    if sqlite:
        # A filter may need further columns, so then they are all read.
        df = read_sqlite(spark, source, sqlite, list(columns) if columns and where is None else None)
    elif jdbc:
        options = {k: v for k, v in jdbc.items() if k != "url"}
        options["fetchsize"] = str(fetchsize)
        if predicates:
            df = spark.read.jdbc(
                jdbc["url"], source, predicates=list(predicates), properties=options
            )
        else:
            df = spark.read.jdbc(jdbc["url"], source, properties=options)
    else:
        df = spark.read.parquet(source)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def read_annotation_jobs(
    jobs: DataFrame,
    job_ids: str | Iterable | None,
    start: datetime | None = None,
    end: datetime | None = None,
    start_days: int = 0,
    end_days: int = 0,
    today: date | None = None,
    empty_possible: bool = False,
    job: str = "job_id",
    ts: str = "tagged_at",
) -> DataFrame:
    """SRC-4: annotated rows of several jobs in a date range, from one table.

    Day offsets that are not zero replace the given dates. No ids give an empty table or
    an error. Where the table is partitioned by job, other partitions are not read.
    """
    listed = split_paths(job_ids) if isinstance(job_ids, str) else list(job_ids or [])
    if not listed:
        if empty_possible:
            return jobs.limit(0)
        raise ValueError("a job or project id is needed")
    rows = jobs.where(F.col(job).isin(listed))
    kind = jobs.schema[ts].dataType.simpleString()
    literal = lambda moment: F.lit(moment.isoformat(sep=" ")).cast(kind)
    if start_days or end_days:
        start, end = date_bounds(start_days=start_days, end_days=end_days, today=today)
    if start:
        rows = rows.where(F.col(ts) >= literal(start))
    if end:
        rows = rows.where(F.col(ts) <= literal(end))
    return rows


def read_newest_run(spark: SparkSession, root: str, run: str = "*", format: str = "parquet", **options) -> DataFrame:
    """WIN-4 by names: the newest run in the newest date folder below ``root``.

    Only the names of the date folders and those in the newest one are listed, and only the
    run's own files are read; ``latest_snapshot`` gives the same rows where the two are columns of
    a table. ``run`` is a pattern for names of runs (``*-tagged`` for datasets of one kind). Date
    folders without such a run are passed over. Folders named ``column=value`` give these
    columns, as usual for partitions.
    """
    for day in newest(child_names(spark, root)):
        runs = fnmatch.filter(child_names(spark, f"{root}/{day}"), run)
        if runs:
            # The names of the listing, as text, are the path: what they escape stays so.
            return spark.read.format(format).options(**options, basePath=root).load(f"{root}/{day}/{newest(runs)[0]}")
    raise ValueError(f"{root} holds no run {run}")
