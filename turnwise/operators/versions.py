"""Versions of a small dimension table in a shared folder.

``<root>/data`` holds a parquet folder per attempt, ``<root>/log`` a file per version that names
one of them. A writer works on the version it has read and commits the next number; if another
writer was faster, it works again on what that one left. So two runs at once neither hand out one
id twice nor lose rows, and readers always see a whole version.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

from turnwise.sources.folders import child_names, create_once, read_line

Result = TypeVar("Result")
# Digits of a version number in the names of the log.
DIGITS = 12
TRIES = 20


class Conflict(RuntimeError):
    """Other writers were faster each time."""


def last_version(spark: SparkSession, root: str) -> int:
    """The number of the newest version, 0 where there is none."""
    names = child_names(spark, f"{root}/log")
    return int(names[-1]) if names else 0


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A version of the table as it was committed, the newest one by default."""
    number = last_version(spark, root) if version is None else version
    if number < 1:
        raise ValueError(f"{root} has no version yet")
    return spark.read.parquet(f"{root}/data/{read_line(spark, f'{root}/log/{number:0{DIGITS}}')}")


def commit_version(after: DataFrame, root: str, version: int) -> bool:
    """Write ``after`` as this version; False where that version is already there, which leaves
    the table as it is."""
    name = uuid.uuid4().hex
    after.write.parquet(f"{root}/data/{name}")
    return create_once(after.sparkSession, f"{root}/log/{version:0{DIGITS}}", name)


def start_versions(dim: DataFrame, root: str) -> DataFrame:
    """Commit ``dim`` as the first version unless there is one; gives the newest version."""
    spark = dim.sparkSession
    if last_version(spark, root) == 0:
        commit_version(dim, root, 1)
    return read_version(spark, root)


def update_version(
    spark: SparkSession, root: str, change: Callable[[DataFrame], tuple[Result, DataFrame]], tries: int = TRIES
) -> tuple[Result, int]:
    """Apply ``change`` to the newest version and commit what it gives; (result, version).

    ``change`` gets the table and gives a result and the table after it, such as
    ``get_or_create`` (JN-8); it runs again for each version that came between, so only the
    result that fits the committed version is given. Folders of lost attempts stay in ``data``.
    """
    for attempt in range(tries):
        before = last_version(spark, root)
        result, after = change(read_version(spark, root, before))
        if commit_version(after, root, before + 1):
            return result, before + 1
        # Writers that met once should not meet at each try.
        time.sleep(min(2.0, 0.05 * 2**attempt) * (uuid.uuid4().int % 1000) / 1000)
    raise Conflict(f"{root}: other writers were faster {tries} times")
