"""Tables made of one folder per load, and their compaction.

A load writes ``<table>/Load_Batch=<name>``. Compaction rewrites many loads into one: it writes to a hidden folder, which
also lists the loads that it replaces, and publishes it by one rename. Readers leave out loads that a published folder
replaces, so at every moment they see each row once: before the rename by the old folders, after it by the
new one. A compaction that dies before the rename has changed nothing. Replaced folders stay for readers that have planned
already; the next compaction deletes them.

A stream may run the newest batch of a query again, so that one is not compacted: its folder stays its own.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tillstar.session import hadoop_path, path_exists, remove

PART = "Load_Batch"
_COMPACTED, _HIDDEN, _REPLACES = "compacted-", "_compacting-", "_replaces.json"
_STREAM_BATCH = re.compile(r"(.+)-(\d+)")


def part_folder(path: str, part: str) -> str:
    """The folder of one load below a table; batch and stream loads share this layout."""
    return f"{path}/{PART}={part}"


def folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """What follows ``prefix`` in the names of the folders of a table that begin with it."""
    if not path_exists(spark, path):
        return []
    files, place = hadoop_path(spark, path)
    return sorted(n.removeprefix(prefix) for n in (f.getPath().getName() for f in files.listStatus(place)) if n.startswith(prefix))


def _replaced_by(spark: SparkSession, path: str, part: str) -> list[str]:
    files, place = hadoop_path(spark, f"{part_folder(path, part)}/{_REPLACES}")
    lines = files.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(lines, "UTF-8"))
    finally:
        lines.close()


def replaced_loads(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Compacted loads with the loads that each replaces."""
    found = [_COMPACTED + rest for rest in folders(spark, path, f"{PART}={_COMPACTED}")]
    return {part: _replaced_by(spark, path, part) for part in found}


def visible_loads(spark: SparkSession, path: str) -> list[str]:
    """The loads that hold the table's rows at this moment."""
    names = folders(spark, path, f"{PART}=")
    gone = {old for olds in replaced_loads(spark, path).values() for old in olds} if any(n.startswith(_COMPACTED) for n in names) else set()
    return [n for n in names if n not in gone]


def read_parts(spark: SparkSession, path: str, layout: StructType, loads: list[str] | None = None) -> DataFrame:
    """Loads of a table (all visible ones, if None), with the name of each in ``Load_Batch``; empty before the first one."""
    named = StructType([*layout.fields, StructField(PART, StringType())])
    if loads is None:
        names = folders(spark, path, f"{PART}=")
        if path_exists(spark, path) and not any(n.startswith(_COMPACTED) for n in names):
            return spark.read.schema(named).parquet(path)
        loads = visible_loads(spark, path)
    if not loads:
        return spark.createDataFrame([], named).limit(0)  # known to be empty, so of no size
    return spark.read.schema(named).option("basePath", path).parquet(*[part_folder(path, n) for n in loads])


def _may_run_again(names: list[str]) -> set[str]:
    """The newest batch of each stream."""
    newest: dict[str, tuple[int, str]] = {}
    for name in names:
        if (batch := _STREAM_BATCH.fullmatch(name)) and not name.startswith((_COMPACTED, "batch-")):
            newest[batch[1]] = max(newest.get(batch[1], (-1, "")), (int(batch[2]), name))
    return {name for _, name in newest.values()}


def compact(spark: SparkSession, path: str, layout: StructType, write: Callable[[DataFrame, str], None], least: int = 2) -> str | None:
    """Rewrite all loads of a table, but for stream batches that may run again, into one; returns its name.

    ``write`` writes rows to a folder. With fewer than ``least`` loads nothing is done. One compaction of a table runs at a
    time; loads and readers may go on meanwhile.
    """
    for leftover in folders(spark, path, _HIDDEN):  # of compactions that died
        remove(spark, f"{path}/{_HIDDEN}{leftover}")
    for part, olds in replaced_loads(spark, path).items():
        for old in olds:
            remove(spark, part_folder(path, old))
    names = visible_loads(spark, path)
    chosen = [n for n in names if n not in _may_run_again(names)]
    if len(chosen) < least:
        return None
    part = f"{_COMPACTED}{uuid.uuid4().hex}"
    hidden = f"{path}/{_HIDDEN}{part}"
    write(read_parts(spark, path, layout, chosen).drop(PART), hidden)
    files, place = hadoop_path(spark, f"{hidden}/{_REPLACES}")
    out = files.create(place, True)
    out.write(bytearray(json.dumps(chosen).encode()))
    out.close()
    publish(spark, hidden, part_folder(path, part))
    return part


def publish(spark: SparkSession, hidden: str, folder: str) -> None:
    """Rename a finished folder to the name under which readers see it."""
    files, place = hadoop_path(spark, hidden)
    if not files.rename(place, hadoop_path(spark, folder)[1]):
        raise OSError(f"cannot rename {hidden} to {folder}")
