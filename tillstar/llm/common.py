"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: space and the five controls from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: Characters that one numpy step works on at once; a longer text is a step of its own.
STEP_CHARS = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Bound the Arrow batches of Python stages, so that a batch of long texts fits in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def in_steps(texts: list[str], limit: int = STEP_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` that hold about ``limit`` characters together."""
    begin = held = 0
    for k, text in enumerate(texts):
        if k > begin and held + len(text) > limit:
            yield begin, k
            begin, held = k, 0
        held += len(text)
    if begin < len(texts):
        yield begin, len(texts)


class BoundedCache(dict):
    """Memo of ``make``; emptied when it holds ``limit`` keys, so that a worker's memory is bounded."""

    def __init__(self, make, limit: int = 200_000, cacheable=lambda key: True):
        super().__init__()
        self.make, self.limit, self.cacheable = make, limit, cacheable

    def __missing__(self, key):
        value = self.make(key)
        if self.cacheable(key):
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


def columns_of(frame: DataFrame, names: Iterable[str]) -> DataFrame:
    """Only the named columns: whatever else a table has cannot clash with derived names."""
    return frame.select(*[F.col(f"`{n}`") for n in names])
