"""Append-only logs as streams: checkpoint lines, incremental hashes, label upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas


def stream_records(spark: SparkSession, folder: str) -> DataFrame:
    """Checkpoint lines as they arrive; a line without ``arquivo`` is passed over."""
    lines = spark.readStream.text(folder)
    row = F.from_json("value", schemas.RECORD, {"mode": "PERMISSIVE"})
    return schemas.with_defaults(lines.select(row.alias("r")).filter(F.col("r.arquivo").isNotNull()).select("r.*"))


def append_table(records: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Exactly-once append: the file sink's log and the checkpoint skip batches that were written."""
    return records.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def new_hashes(files: DataFrame, horizon: str = "7 days") -> DataFrame:
    """(arquivo, sha256, lido_em) once per path; state is kept for ``horizon`` of event time."""
    rows = files.withWatermark("lido_em", horizon).dropDuplicatesWithinWatermark(["arquivo"])
    return rows.select("arquivo", F.sha2("conteudo", 256).alias("sha256"), "lido_em")


def upsert_labels(labels: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Appends each batch's last label of every content by ``seq``; ``current_labels`` reads the table.

    A batch is a partition of its own number, so one that runs again replaces its own rows only, and
    what earlier batches wrote is never rewritten.
    """

    def write(batch: DataFrame, number: int) -> None:
        _last(batch.select("sha256", "tem_assinatura", "seq")).write.mode("overwrite").parquet(f"{target}/lote={number}")

    return labels.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _last(rows: DataFrame) -> DataFrame:
    last = rows.groupBy("sha256").agg(F.max_by(F.struct("tem_assinatura"), "seq").alias("last"), F.max("seq").alias("seq"))
    return last.select("sha256", "last.tem_assinatura", "seq")


def current_labels(spark: SparkSession, target: str) -> DataFrame:
    """The last label of each content over all batches: sha256, tem_assinatura, seq."""
    return _last(spark.read.parquet(target))


def status_counts(records: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Documents per status and window of ``processado_em``."""
    at = F.to_timestamp("processado_em").alias("at")
    return records.select("status", at).withWatermark("at", late).groupBy(F.window("at", window), "status").agg(F.count("*").alias("n_docs"))
