"""Continuous fact load: a folder of transaction files to facts and rejects.

The joins are stateless lookups against dimensions that exist before the stream starts. A batch may
run again after a failure, so it overwrites its own folders and compares only with earlier batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tillstar import schemas
from tillstar.plans import load
from tillstar.plans.dims import together
from tillstar.plans.star import Warehouse
from tillstar.session import is_loaded, path_exists, release, remove_stored, stored
from tillstar.sources import readers

#: Identifies a query across restarts, set by Spark for the thread that runs a batch.
_QUERY_ID = "sql.streaming.queryId"


def transaction_stream(
    spark: SparkSession, path: str, layout: StructType, file_format: str = "parquet", files_per_batch: int = 4,
    bytes_per_batch: int | None = None, archive: str | None = None,
) -> DataFrame:
    """Cleaned transactions from new files; ``layout`` names every column of the files in order.

    With ``bytes_per_batch`` a batch holds files of about so many bytes, whatever their number, instead of
    ``files_per_batch``; a larger file is a batch of its own. With ``archive``, a folder outside ``path``, files that a batch
    has loaded are moved there when a later batch is done, so that the folder which is listed stays small.
    """
    reader = spark.readStream.schema(layout)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    else:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if file_format == "csv":
        reader = reader.option("header", True)
    return readers.clean_transactions(reader.format(file_format).load(path))


def batch_rates(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Batch, rows read, seconds and rows a second of the batches that Spark keeps the progress of (100 if not set otherwise)."""
    rates = [
        (p.batchId, p.numInputRows, p.batchDuration / 1000, p.numInputRows * 1000 / max(p.batchDuration, 1))
        for p in query.recentProgress if p.numInputRows
    ]
    return spark.createDataFrame(rates, "Batch long, Rows_In long, Seconds double, Rows_Per_Second double")


class FactStream:
    """Loads a transaction stream into ``<root>/fact_sales`` and ``<root>/fact_rejects``.

    Every batch has folders of its own, named by query and batch: a batch that runs again replaces just these, and
    a new checkpoint, which is a new query, starts folders that no other load touches. Batch loads share the layout.
    """

    def __init__(self, warehouse: Warehouse, root: str):
        self.spark = warehouse.spark
        self.lookups = warehouse.lookups()
        self.root = root

    def start(self, transactions: DataFrame, checkpoint: str | None = None) -> StreamingQuery:
        """Process everything that is there, then stop; a restart goes on behind the last batch.

        A checkpoint belongs to the facts that it was started for: one that another warehouse has used, or this one before it
        was created anew, would skip files whose facts are not here, and is refused.
        """
        place = checkpoint or f"{self.root}/checkpoint"
        self._claim(place)
        return (
            transactions.writeStream.foreachBatch(self._load_and_release)
            .option("checkpointLocation", place)
            .trigger(availableNow=True)
            .start()
        )

    def _claim(self, checkpoint: str) -> None:
        own, mark = schemas.warehouse_id(self.spark, self.root), f"{checkpoint}/{schemas.IDENTITY}"
        if is_loaded(self.spark, mark):
            if self.spark.read.parquet(mark).first()[0] != own:
                raise ValueError(f"checkpoint {checkpoint} belongs to other facts than those in {self.root}")
        elif path_exists(self.spark, f"{checkpoint}/offsets"):
            raise ValueError(f"checkpoint {checkpoint} does not say which facts it belongs to")
        else:
            self.spark.createDataFrame([(own,)], "id string").coalesce(1).write.mode("overwrite").parquet(mark)

    def _load_and_release(self, batch: DataFrame, batch_id: int) -> None:
        self.load_batch(batch, batch_id)
        release(self.spark)

    def load_batch(self, batch: DataFrame, batch_id: int, query: str | None = None) -> None:
        part = f"{query or self.spark.sparkContext.getLocalProperty(_QUERY_ID) or 'direct'}-{batch_id}"
        taken = stored(batch, "stage_batch")  # read from its source once
        narrow, lines = load.without_idle_arrivals(taken)
        watched, staged = load.observed_stage(load.resolve(narrow, *self.lookups))
        resolved = stored(watched, "stage_sales")
        rows = load.loadable(resolved)
        repeated = stored(load.repeated_sales(rows), "stage_repeated")
        sales = load.unique_sales(rows, repeated)
        marked, written = load.marked_sales(sales, load.stored_keys(self._others("fact_sales", part), rows))
        rejects = load.all_rejects(resolved, repeated).unionByName(load.already_loaded(marked))
        loaded, _ = together(
            lambda: load.write_sales(load.not_loaded(marked), self._folder("fact_sales", part), mode="overwrite"),
            lambda: rejects.write.mode("overwrite").parquet(self._folder("fact_rejects", part)),
        )
        load.write_audit(self.spark, f"{self.root}/load_audit", part, staged, loaded)
        for done in (taken, *lines, *written, repeated, resolved):
            remove_stored(done)

    def facts(self) -> DataFrame:
        return load.read_parts(self.spark, f"{self.root}/fact_sales", schemas.FACT_SALES).drop(load.PART)

    def rejects(self) -> DataFrame:
        return load.read_parts(self.spark, f"{self.root}/fact_rejects", schemas.FACT_REJECTS).drop(load.PART)

    def audit(self) -> DataFrame:
        """The load audit over all batches: rows in, rows matched, match rate per stage."""
        return load.load_audit(self.spark, f"{self.root}/load_audit")

    def _folder(self, kind: str, part: str) -> str:
        return load.part_folder(f"{self.root}/{kind}", part)

    def _others(self, kind: str, part: str) -> DataFrame:
        """Facts of every load but this batch, whichever query or batch job wrote them."""
        return load.read_parts(self.spark, f"{self.root}/{kind}", schemas.FACT_SALES).where(F.col(load.PART) != part)
