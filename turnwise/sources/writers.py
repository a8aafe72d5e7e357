"""Sinks: named datasets, text lines, checked appends, batches for tagging projects."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from turnwise.operators.datasets import corpus_lines

# Fixed value: data label of rows sent for tagging.
DEFAULT_DATA_LABEL = "Live"
# The table of audited calls. Type, longest text, must be present.
BREACH_TABLE = {
    "call_uuid": ("string", 255, True),
    "audio_url": ("string", 511, False),
    "call_url": ("string", 511, False),
    "flow_uuid": ("string", 255, False),
    "client_uuid": ("string", 255, False),
    "reftime": ("timestamp", None, False),
    "is_breach": ("boolean", None, True),
    "compliance_output": ("string", 5000, True),
    "tokens_consumed": ("int", None, True),
    "call_information": ("string", 10000, False),
}


def dataset_path(root: str, reference: str, file_type: str, run_time: datetime) -> str:
    """``<root>/project/<reference>/<day>/<reference>-<time>-<type>``; commas become ``_``."""
    name = str(reference).replace(",", "_")
    return (
        f"{root.rstrip('/')}/project/{name}/{run_time:%Y-%m-%d}/"
        f"{name}-{run_time:%H-%M-%S}-{file_type}"
    )


def write_dataset(
    df: DataFrame,
    root: str,
    reference: str,
    file_type: str,
    run_time: datetime,
    format: str = "parquet",
) -> str:
    """SNK-1: write under a name made of its arguments only; a second run with the same
    arguments replaces its own output. Gives the path."""
    path = dataset_path(root, reference, file_type, run_time)
    writer = df.write.mode("overwrite")
    if format == "csv":
        writer = writer.options(header=True, quote='"', escape='"')
    writer.format(format).save(path)
    return path


def write_text_lines(df: DataFrame, col: str, path: str) -> str:
    """SNK-2: one line per row; what is no text becomes an empty line."""
    df.select(corpus_lines(df, col).alias("value")).write.mode("overwrite").text(path)
    return path


def write_call_lines(lines: DataFrame, path: str, files: int | None = None) -> str:
    """AGG-1 stored: the rows of ``call_lines`` in the order (call_id, id, is_user), over as many
    files as ``files`` or the shuffle partitions say.

    Files follow each other in that order, so a call of any length goes on from one file to the
    next, no task holds it whole, and a reader of one call opens only the files it lies in.
    """
    order = ["call_id", "id", "is_user"]
    ranges = lines.repartitionByRange(files, *order) if files else lines.repartitionByRange(*order)
    ranges.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)
    return path


def with_errors(df: DataFrame, table: Mapping[str, tuple]) -> DataFrame:
    """Adds ``errors``, the reasons why a row does not fit the typed table."""
    rules: list[Column] = []
    for name, (kind, longest, required) in table.items():
        value = F.col(name)
        if required:
            rules.append(F.when(value.isNull(), F.lit(f"{name} is missing")))
        if kind != "string":
            bad = value.isNotNull() & value.try_cast(kind).isNull()
            rules.append(F.when(bad, F.lit(f"{name} is no {kind}")))
        if longest:
            rules.append(
                F.when(F.length(value) > longest, F.lit(f"{name} is longer than {longest}"))
            )
    return df.withColumn("errors", F.array_compact(F.array(*rules)))


def validated_append(
    df: DataFrame, table: Mapping[str, tuple] = BREACH_TABLE
) -> tuple[DataFrame, DataFrame]:
    """SNK-3: (accepted, rejected). Accepted rows are cast to the table; rejected ones
    keep their values and list their ``errors``. One bad row does not stop the others."""
    checked = with_errors(df, table)
    accepted = checked.where(F.size("errors") == 0).select(
        *[F.col(n).try_cast(kind).alias(n) for n, (kind, _, _) in table.items()]
    )
    return accepted, checked.where(F.size("errors") > 0)


def append_batch(
    df: DataFrame, root: str, batch: str, table: Mapping[str, tuple] = BREACH_TABLE
) -> tuple[DataFrame, DataFrame]:
    """SNK-3 with storage: the accepted rows of a batch go to ``root``/accepted, the rejected
    ones with their errors to ``root``/rejected; gives both tables as they are then.

    Each batch has a partition of its own, which it writes as a whole. So a batch that is
    written again, after a failure or by mistake, adds nothing.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
        raise ValueError(f"{batch!r} cannot name a batch")
    parts = dict(zip(("accepted", "rejected"), validated_append(df, table)))
    for name, rows in parts.items():
        rows.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch}")
    # Every name is text, also one that looks like a number.
    read = lambda name: df.sparkSession.read.schema(
        StructType([*parts[name].schema.fields, StructField("batch", StringType())])
    ).parquet(f"{root}/{name}")
    return read("accepted"), read("rejected")


def tagging_fanout(
    df: DataFrame, project_ids: Sequence[int | str], data_label: str = DEFAULT_DATA_LABEL
) -> tuple[DataFrame, DataFrame]:
    """SNK-5: (tasks, counts): every row once per project, and the rows per project."""
    projects = F.array(*[F.lit(str(p)) for p in project_ids]).cast("array<string>")
    tasks = df.withColumns(
        {"data_label": F.lit(data_label), "project_id": F.explode(projects)}
    )
    return tasks, tasks.groupBy("project_id").agg(F.count("*").alias("rows"))
