"""SQLite files as a Spark source: partitions by key ranges, filters inside the database.

The files lie where the driver and all tasks can open them (a shared folder). Several files
with one table each, as tasks write them, are one table.
"""

from __future__ import annotations

import glob
import os
import sqlite3
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringStartsWith,
)
from pyspark.sql.types import BinaryType, DataType, DoubleType, LongType, StringType, StructField, StructType

# With this setting Spark offers filters to sources that are written in Python.
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
# Rows that a task hands over at a time.
ROWS = 10_000
COMPARED = {EqualTo: "=", EqualNullSafe: "IS", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def _files(path: str) -> list[str]:
    parsed = urlparse(path)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"SQLite files are opened by path, not from {parsed.scheme}:")
    local = unquote(parsed.path) if parsed.scheme else path
    found = sorted(glob.glob(os.path.join(local, "*"))) if os.path.isdir(local) else [local]
    return [f for f in found if not os.path.basename(f).startswith((".", "_"))]


def _open(file: str) -> sqlite3.Connection:
    """Read-only, so that reading never makes or changes a file."""
    return sqlite3.connect(f"file:{quote(os.path.abspath(file))}?mode=ro", uri=True)


def _name(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _kind(declared: str) -> DataType:
    """The type of a column, by the rules of type affinity; what is neither a whole number
    nor a float nor bytes is text."""
    declared = declared.upper()
    if "INT" in declared:
        return LongType()
    if any(k in declared for k in ("REAL", "FLOA", "DOUB")):
        return DoubleType()
    return BinaryType() if "BLOB" in declared else StringType()


def _condition(f: Filter) -> tuple[str, list] | None:
    """A filter as SQL with parameters, None where SQLite might judge otherwise than Spark."""
    if isinstance(f, Not):
        inner = _condition(f.child)
        return inner and (f"NOT ({inner[0]})", inner[1])
    if len(f.attribute) > 1:
        return None
    column, plain = _name(f.attribute[0]), lambda v: isinstance(v, (int, float, str)) and not isinstance(v, bool) and v == v
    if isinstance(f, (IsNull, IsNotNull)):
        return f"{column} IS {'NOT ' * isinstance(f, IsNotNull)}NULL", []
    if type(f) in COMPARED and plain(f.value):
        return f"{column} {COMPARED[type(f)]} ?", [f.value]
    if isinstance(f, In) and all(map(plain, f.value)) and len(f.value) <= 500:
        return f"{column} IN ({', '.join('?' * len(f.value))})", list(f.value)
    if isinstance(f, StringStartsWith) and plain(f.value):
        return f"substr({column}, 1, ?) = ?", [len(f.value), f.value]
    return None


@dataclass
class KeyRange(InputPartition):
    """Rows of one file from ``first`` on, before ``end``; all rows where there is no key."""

    file: str
    first: int | None
    end: int | None


class Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.options = schema, dict(options)
        self.conditions: list[tuple[str, list]] = []

    def partitions(self) -> list[KeyRange]:
        """Each file in ``partitions`` ranges of its key, which an index has the ends of."""
        wanted, key, table = int(self.options.get("partitions", 8)), self.options.get("key"), _name(self.options["table"])
        out = []
        for file in _files(self.options["path"]):
            con = _open(file)
            try:
                column = _name(key) if key else "rowid"
                low, high = con.execute(f"SELECT min({column}), max({column}) FROM {table}").fetchone()
            except sqlite3.OperationalError:
                if key or con.execute("SELECT 1 FROM sqlite_master WHERE name = ?", [self.options["table"]]).fetchone() is None:
                    raise
                out.append(KeyRange(file, None, None))  # a table without row ids
                continue
            finally:
                con.close()
            if low is not None:
                step = max(1, -(-(high - low + 1) // wanted))
                out += [KeyRange(file, a, min(a + step, high + 1)) for a in range(low, high + 1, step)]
                if key:
                    out.append(KeyRange(file, None, high + 1))  # rows whose key is null
        return out or [KeyRange("", None, None)]

    def read(self, partition: KeyRange) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        if not partition.file:
            return
        kinds = to_arrow_schema(self.schema)
        key = self.options.get("key")
        conditions = list(self.conditions)
        if partition.first is not None:
            conditions.append((f"{_name(key) if key else 'rowid'} >= ? AND {_name(key) if key else 'rowid'} < ?", [partition.first, partition.end]))
        elif key:
            conditions.append((f"{_name(key)} IS NULL", []))
        columns = ", ".join(map(_name, self.schema.names)) or "1"
        where = " AND ".join(f"({c})" for c, _ in conditions) or "1"
        con = _open(partition.file)
        try:
            rows = con.execute(f"SELECT {columns} FROM {_name(self.options['table'])} WHERE {where}", [v for _, p in conditions for v in p])
            while some := rows.fetchmany(ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*some), kinds)], schema=kinds)
        finally:
            con.close()


class FilteringReader(Reader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            found = _condition(f)
            if found:
                self.conditions.append(found)
            else:
                yield f


class SqliteFiles(DataSource):
    """Options: path (a file or a folder of files), table, columns (a list, all by default),
    key (a whole-number column to cut by, the row id by default), partitions (of each file)."""

    @classmethod
    def name(cls) -> str:
        return "sqlite_files"

    def schema(self) -> StructType:
        files = _files(self.options["path"])
        con = _open(files[0]) if files else None
        found = con.execute("SELECT name, type FROM pragma_table_info(?)", [self.options["table"]]).fetchall() if con else []
        if con:
            con.close()
        if not found:
            raise ValueError(f"no table {self.options['table']} in {self.options['path']}")
        kinds = {n: _kind(t or "") for n, t in found}
        columns = [c for c in self.options.get("columns", "").split("\n") if c] or list(kinds)
        return StructType([StructField(c, kinds[c]) for c in columns])

    def reader(self, schema: StructType) -> Reader:
        return (FilteringReader if self.options.get("pushdown") == "true" else Reader)(schema, self.options)


def read_sqlite(spark: SparkSession, table: str, options: dict[str, str], columns: list[str] | None) -> DataFrame:
    """The table of all files, with ``columns`` only where given. Filters reach SQLite where
    the session has PUSHDOWN on; else Spark applies them."""
    spark.dataSource.register(SqliteFiles)
    reader = spark.read.format("sqlite_files").options(
        **options, table=table, pushdown=spark.conf.get(PUSHDOWN, "false")
    )
    return (reader.option("columns", "\n".join(columns)) if columns else reader).load()
