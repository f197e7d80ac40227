"""What the operators share: durable intermediate tables and the id convention."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A null id stands for the smallest possible id, so every row takes part in joins and orders.
NULL_ID = -(2**63)

_own_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: the cluster's ``spark.checkpoint.dir``.

    Where that setting is absent, it is the warehouse, and on one machine, as in tests, a temporary folder.
    """
    global _own_dir
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_vestigo"
    if _own_dir is None:
        _own_dir = "file://" + tempfile.mkdtemp(prefix="vestigo-")
    return _own_dir


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Lets Spark delete a finished query's shuffle files at once; a lost one is rebuilt from its stages.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_table(df: DataFrame, path: str, *partition_by: str) -> None:
    """Write ``df`` as Parquet. The shuffle files behind it are of no more use then and go with the write."""
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)


def materialise(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a durable cut of its lineage."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    write_table(df, path, *partition_by)
    return spark.read.schema(df.schema).parquet(path)


def id_in(col: str = "doc_id") -> Column:
    return F.coalesce(F.col(col).cast("long"), F.lit(NULL_ID))


def id_out(col: str = "doc_id") -> Column:
    return F.when(F.col(col) != NULL_ID, F.col(col))


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """These names for working columns, with underscores in front where ``docs`` has them."""
    taken, out = {c.lower() for c in docs.columns}, []
    for n in names:
        while n in taken:
            n = "_" + n
        out.append(n)
    return out


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _trim = None

#: Bytes of a batch between the JVM and a Python worker. Spark's own bound of 64 MB is held several times on either side.
ARROW_BYTES = 4 << 20
_ARROW = "spark.sql.execution.arrow.maxBytesPerBatch"


def _give_back() -> None:
    """Returns memory that Arrow and the allocator keep for later to the system: workers share an executor's limit."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` in batches of bounded bytes; a smaller bound of the session stays."""
    conf = df.sparkSession.conf
    bound = re.fullmatch(r"(\d+)b?", conf.get(_ARROW, str(1 << 30)))
    if not bound or not 0 < int(bound[1]) <= ARROW_BYTES:
        conf.set(_ARROW, str(ARROW_BYTES))

    def bounded(batches):
        def counted():
            for k, batch in enumerate(batches):
                if k % 2:
                    _give_back()
                yield batch

        yield from run(counted())
        _give_back()

    return df.mapInArrow(bounded, schema)
