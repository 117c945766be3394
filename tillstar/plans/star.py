"""The star the queries read, and how it is built once from the raw inputs."""

from __future__ import annotations

import threading
import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession

from tillstar import schemas
from tillstar.plans import dims, load, parts
from tillstar.session import COMPRESSION, estimated_bytes, new_work_folder, remove, remove_stored, stored, write_if_empty
from tillstar.sources import binding, readers

LANDING_FILE_BYTES = 256 * 2**20  # of the order lines: a task joins, and writes, as much at a time
LANDING_MIN_FILES = 24
FILES_PER_BATCH = 8  # of a stream, of files of that size: batches are of one size, whatever the table's


@dataclass(frozen=True)
class Star:
    fact_sales: DataFrame
    dim_date: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_store: DataFrame
    dim_supplier: DataFrame
    #: Parts of all facts that hold different customers, the first one bucketed as dim_customer is (``plans.bucketed``).
    fact_parts: tuple[DataFrame, ...] = ()


class Warehouse:
    """Stored tables below one folder: masters, dimensions, staged sales and facts."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def table(self, name: str) -> DataFrame:
        if name == "fact_sales":
            return load.read_facts(self.spark, f"{self.root}/{name}")
        return self.spark.read.parquet(f"{self.root}/{name}")

    @cached_property
    def star(self) -> Star:
        return Star(**{name: self.table(name) for name in schemas.STAR_TABLES})

    def load_masters(self, customers: DataFrame, products: DataFrame) -> None:
        dims.store_masters(customers, products, self.root)

    def load_dimensions(self, years: DataFrame) -> None:
        dims.store_dimensions(self.spark, self.root, years)
        parts = [self.table(t) for t in ("master_product", "dim_product", "dim_store", "dim_supplier")]
        write_if_empty(load.product_keys(*parts), f"{self.root}/product_keys")

    def lookups(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Customer keys, product keys (with price, store and supplier keys) and the calendar.

        All are stored tables: a join with a plain scan on each side is one that adaptive execution
        can broadcast, or split when a key is skewed.
        """
        return load.customer_keys(self.table("dim_customer")), self.table("product_keys"), self.table("dim_date")

    def load_sales(self, transactions: DataFrame) -> None:
        """Rebuild the facts: stage the resolved rows, then replace the facts from the stage.

        The stage is written because facts, rejects and audit all read it and because it cuts the
        lineage: a lost executor costs a re-read, not the joins.
        """
        self.load_staged(self.stage_sales(transactions))

    def stage_sales(self, transactions: DataFrame) -> Observation:
        """The resolved rows and the keys that occur more than once, which is all that rejects need."""
        narrow, written = load.without_idle_arrivals(transactions)
        resolved, staged = load.observed_stage(load.resolve(narrow, *self.lookups()))
        resolved.write.option("compression", COMPRESSION).mode("overwrite").parquet(f"{self.root}/stage_sales")
        load.repeated_sales(load.loadable(self.table("stage_sales"))).write.mode("overwrite").parquet(f"{self.root}/stage_repeated")
        for done in written:
            remove_stored(done)
        return staged

    def load_staged(self, staged: Observation) -> None:
        sales = load.unique_sales(load.loadable(self.table("stage_sales")), self.table("stage_repeated"))
        for name in ("fact_sales", *schemas.DERIVED):
            remove(self.spark, f"{self.root}/{name}")
        loaded = load.write_sales(sales, load.part_folder(f"{self.root}/fact_sales", "rebuilt"), mode="overwrite")
        load.write_audit(self.spark, f"{self.root}/load_audit", "rebuilt", staged, loaded)
        self.__dict__.pop("star", None)  # its file listing is out of date

    def append_sales(self, transactions: DataFrame) -> DataFrame:
        """Add transactions to the facts, if there are any, and to the rejects; returns the rejects of this load.

        A row whose fact key is already stored is a duplicate, so loading the same input again, or
        again after a failure half way, adds no fact. Every load writes a folder of its own.
        """
        part = f"batch-{uuid.uuid4().hex}"
        narrow, lines = load.without_idle_arrivals(transactions)
        watched, staged = load.observed_stage(load.resolve(narrow, *self.lookups()))
        resolved = stored(watched, "stage_sales")
        rows = load.loadable(resolved)
        repeated = stored(load.repeated_sales(rows), "stage_repeated")
        sales = load.unique_sales(rows, repeated)
        marked, written = load.marked_sales(sales, load.stored_keys(self.table("fact_sales"), rows))
        rejects = load.all_rejects(resolved, repeated).unionByName(load.already_loaded(marked))
        rejects.write.parquet(load.part_folder(f"{self.root}/fact_rejects", part))
        loaded = load.write_sales(load.not_loaded(marked), load.part_folder(f"{self.root}/fact_sales", part))
        load.write_audit(self.spark, f"{self.root}/load_audit", part, staged, loaded)
        self.__dict__.pop("star", None)  # its file listing is out of date
        for done in (*lines, resolved, repeated, *written):
            remove_stored(done)
        return self.spark.read.schema(schemas.FACT_REJECTS).parquet(load.part_folder(f"{self.root}/fact_rejects", part))

    def all_rejects(self) -> DataFrame:
        """The rejects of every appended batch and stream load."""
        return load.read_parts(self.spark, f"{self.root}/fact_rejects", schemas.FACT_REJECTS).drop(load.PART)

    def audit(self) -> DataFrame:
        """Rows in, rows matched and match rate per stage over all loads, as their writes counted them."""
        return load.load_audit(self.spark, f"{self.root}/load_audit")

    def compact(self) -> None:
        """Rewrite the folders of many loads as one, for facts and rejects; readers and loads may go on."""
        parts.compact(self.spark, f"{self.root}/fact_sales", schemas.FACT_SALES, load.write_facts)
        parts.compact(self.spark, f"{self.root}/fact_rejects", schemas.FACT_REJECTS, lambda rows, path: rows.write.parquet(path))
        self.__dict__.pop("star", None)  # its file listing is out of date

    def rejects(self) -> DataFrame:
        return load.all_rejects(self.table("stage_sales"), self.table("stage_repeated"))


def land_transactions(spark: SparkSession, sf_dir: str, path: str, files: int) -> None:
    """Write raw transactions as a folder of files, as a stream source, behind one shuffle; an order's lines, so a sale's copies, share a file."""
    binding.raw_transactions(spark, sf_dir, files).write.option("compression", COMPRESSION).mode("overwrite").parquet(path)


class Workspace:
    """Everything the registered queries share for one data folder, each part built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.root = new_work_folder(spark, "tillstar")
        self._lock = threading.RLock()
        self._built: dict[str, object] = {}

    def once(self, name: str, build):
        with self._lock:
            if name not in self._built:
                self._built[name] = build()
            return self._built[name]

    @property
    def transactions(self) -> DataFrame:
        """Cleaned transactions of the landing folder."""
        return readers.clean_transactions(self.spark.read.parquet(self.landing))

    @property
    def landing(self) -> str:
        def build():
            path = f"{self.root}/landing"
            land_transactions(self.spark, self.sf_dir, path, self._landing_files())
            return path

        return self.once("landing", build)

    def _landing_files(self) -> int:
        size = estimated_bytes(self.spark.read.parquet(f"{self.sf_dir}/lineitem.parquet"))
        return max(LANDING_MIN_FILES, size // LANDING_FILE_BYTES)

    @property
    def files_per_batch(self) -> int:
        """Of a stream over the landing folder: as many files as hold what ``FILES_PER_BATCH`` of the asked-for number do.

        Spark writes more, smaller files than asked for if a shuffle has more partitions. The driver keeps the plans and tasks
        of every batch, and every batch is compared with all facts before it, so that their number must not follow that setting.
        """

        def build():
            written = len(self.spark.read.parquet(self.landing).inputFiles())
            batches = -(-self._landing_files() // FILES_PER_BATCH)
            return max(FILES_PER_BATCH, -(-written // batches))

        return self.once("files_per_batch", build)

    @property
    def late(self) -> str:
        """A folder of lines that repeat some of the landing folder's."""

        def build():
            binding.late_transactions(self.spark, self.sf_dir).write.parquet(f"{self.root}/late")
            return f"{self.root}/late"

        return self.once("late", build)

    @property
    def all_transactions(self) -> DataFrame:
        """Cleaned transactions with the faulty ones added to all others."""

        def build():
            binding.faulty_transactions(self.spark, self.sf_dir).write.parquet(f"{self.root}/faulty_lines")
            return readers.clean_transactions(self.spark.read.parquet(f"{self.root}/faulty_lines"))

        return self.transactions.unionByName(self.once("faulty_lines", build))

    @property
    def customers(self) -> DataFrame:
        return readers.clean_customers(binding.raw_customers(self.spark, self.sf_dir))

    @property
    def products(self) -> DataFrame:
        return readers.clean_products(binding.raw_products(self.spark, self.sf_dir))

    @property
    def full(self) -> Warehouse:
        def build():
            self.full_dimensions.load_sales(self.transactions)
            return self.full_dimensions

        return self.once("full", build)

    @property
    def faulty(self) -> Warehouse:
        """Loaded from the whole tables and added faulty rows, so that rows are rejected for every reason."""

        def build():
            self.faulty_staged.load_staged(self.once("faulty_stage", None))
            return self.faulty_dimensions

        return self.once("faulty", build)

    @property
    def faulty_staged(self) -> Warehouse:
        """The same warehouse for queries that read its stage, but not its facts."""
        self.once("faulty_stage", lambda: self.faulty_dimensions.stage_sales(self.all_transactions))
        return self.faulty_dimensions

    @property
    def full_dimensions(self) -> Warehouse:
        """The same warehouse for queries that read no facts, which are then not loaded for them."""
        return self.once("full_dimensions", lambda: self._load_dimensions("full", faulty=False))

    @property
    def faulty_dimensions(self) -> Warehouse:
        return self.once("faulty_dimensions", lambda: self._load_dimensions("faulty", faulty=True))

    @property
    def star(self) -> Star:
        return self.full.star

    def _load_dimensions(self, name: str, faulty: bool) -> Warehouse:
        warehouse = Warehouse(self.spark, f"{self.root}/{name}")
        warehouse.load_masters(
            readers.clean_customers(binding.raw_customers(self.spark, self.sf_dir)),
            readers.clean_products(binding.raw_products(self.spark, self.sf_dir, faulty)),
        )
        warehouse.load_dimensions(dims.years_of(self.transactions, "Sale_Date"))
        return warehouse


_workspaces: dict[tuple[str, str], Workspace] = {}
_workspaces_lock = threading.Lock()


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    """The workspace of a data folder within this Spark application."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _workspaces_lock:
        if key not in _workspaces:
            _workspaces[key] = Workspace(spark, sf_dir.rstrip("/"))
        return _workspaces[key]
