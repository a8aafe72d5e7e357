"""Names in a folder of the shared file system, and files that are created once."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def child_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the visible entries of a folder, in order; none where it does not exist."""
    at, system = _hadoop(spark, folder)
    if not system.exists(at):
        return []
    found = (status.getPath().getName() for status in system.listStatus(at))
    return sorted(name for name in found if name[0] not in "._")


def read_line(spark: SparkSession, path: str) -> str:
    at, system = _hadoop(spark, path)
    stream = system.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, line: str) -> bool:
    """Create a file together with its content; False where somebody else has created it.

    The content goes to a hidden file first, which then gets the name if that is free. Where
    the file system renames atomically (HDFS), or is a path of this machine, only one of
    several writers succeeds; an object store without such a rename does not promise it.
    """
    at, system = _hadoop(spark, path)
    system.mkdirs(at.getParent())
    hidden = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}-{uuid.uuid4().hex}")
    stream = system.create(hidden, False)
    try:
        stream.write(bytearray(line.encode()))
    finally:
        stream.close()
    if system.getUri().getScheme() == "file":
        # The local rename of Hadoop looks and then renames; a link is one step.
        try:
            os.link(hidden.toUri().getPath(), at.toUri().getPath())
            return True
        except FileExistsError:
            return False
        finally:
            system.delete(hidden, False)
    jvm = spark._jvm.org.apache.hadoop.fs
    context = jvm.FileContext.getFileContext(at.toUri(), spark._jsc.hadoopConfiguration())
    no_overwrite = spark._sc._gateway.new_array(getattr(jvm, "Options$Rename"), 0)
    try:
        context.rename(hidden, at, no_overwrite)
        return True
    except Exception as error:
        if "FileAlreadyExists" not in str(error):
            raise
        system.delete(hidden, False)
        return False


def newest(names: list[str]) -> list[str]:
    """Names from the newest on: by number where all are numbers, else as text. Names
    ``column=value`` are compared by their value."""
    value = lambda name: unquote(name.partition("=")[2]) if "=" in name else name
    numbers = all(value(name).lstrip("-").isdecimal() for name in names)
    return sorted(names, key=lambda name: int(value(name)) if numbers else value(name), reverse=True)
