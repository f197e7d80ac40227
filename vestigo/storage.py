"""Durable intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dir: str | None = None
_tables: dict[tuple, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where that is unset, the warehouse, or on one machine a temporary folder."""
    global _own_dir
    if base := spark.conf.get("spark.checkpoint.dir", None):
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_vestigo"
    if _own_dir is None:
        _own_dir = "file://" + tempfile.mkdtemp(prefix="vestigo-")
    return _own_dir


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def persisted(spark: SparkSession, key: tuple, make) -> DataFrame:
    """The table that ``make()`` gives, written once per application and key and then read."""
    key = (spark.sparkContext.applicationId, *key)
    if key not in _tables:
        df: DataFrame = make()
        path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
        df.write.parquet(path)
        _tables[key] = path
    return spark.read.parquet(_tables[key])


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
