"""Line-oriented relations: checkpoint, hashes, index, labels, triage.

Lines are parsed leniently; a line without its key is passed over, one with a
mistyped field keeps its other fields. ``seq`` is the line's place, which
decides "the last line wins".
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import schemas
from ..functions.classify import back_in_scope
from ..storage import materialise, shuffle_width


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, seq): text lines with their order: batch, file name, then place in the file.

    ``append_lines`` numbers its batches in the names of their folders, so later appends come later.
    ``monotonically_increasing_id`` follows the order of splits, which Spark keeps within a file.
    """
    text = spark.read.option("recursiveFileLookup", "true").text(path)
    lines = text.select("value", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line"))
    batch = F.coalesce(F.regexp_extract("file", "/lote-([0-9]+)/[^/]*$", 1).try_cast("long"), F.lit(0))
    return lines.select("value", F.struct(batch.alias("batch"), "file", "line").alias("seq"))


def parse(lines: DataFrame, schema: str, key: str) -> DataFrame:
    """Fields of every line that is a JSON object with ``key``."""
    row = F.from_json("value", schema, {"mode": "PERMISSIVE"})
    return lines.select(row.alias("r"), "seq").filter(F.col("r").isNotNull() & F.col(f"r.{key}").isNotNull()).select("r.*", "seq")


def latest(rows: DataFrame, key: str) -> DataFrame:
    """The last row of each key with ``first_seq``, the place where the key came first.

    ``max_by`` combines before the shuffle: a hot key costs one row per task.
    """
    fields = [c for c in rows.columns if c not in (key, "seq")]
    picked = rows.groupBy(key).agg(F.max_by(F.struct(*fields), "seq").alias("last"), F.min("seq").alias("first_seq"))
    return picked.select(key, "last.*", "first_seq")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The checkpoint's latest record of every document, in path order when sorted by ``ordered``."""
    return schemas.with_defaults(latest(parse(numbered_lines(spark, path), schemas.RECORD, "arquivo"), "arquivo"))


def ordered(records: DataFrame) -> DataFrame:
    extra = ["first_seq"] if "first_seq" in records.columns else ["arquivo"]
    return records.orderBy(F.lower("arquivo"), *extra)


def numbered(records: DataFrame) -> DataFrame:
    """Records with ``n``, their number in path order from 1 on.

    Ranges are sorted where they lie and counted; a range's first number is the sum of the counts before it.
    """
    parts = shuffle_width(records.sparkSession)
    by = [F.lower("arquivo"), *(["first_seq"] if "first_seq" in records.columns else []), "arquivo"]
    at = F.monotonically_increasing_id()
    rows = records.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumns({"range": F.shiftright(at, 33).cast("int"), "place": at.bitwiseAND(F.lit((1 << 33) - 1))})
    rows = materialise(rows, "numbered")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("range").agg(F.count("*").alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return rows.join(F.broadcast(sizes), "range").withColumn("n", F.col("before") + F.col("place") + 1).drop("range", "place", "before")  # a row per range


def completed(rows: DataFrame) -> DataFrame:
    """Documents that need no new run: any of their lines is final (all lines count, not only the last)."""
    return rows.filter(~F.coalesce(back_in_scope(), F.lit(False))).select("arquivo").distinct()


def pending(files: DataFrame, done: DataFrame) -> DataFrame:
    return files.join(done, "arquivo", "left_anti")


def read_hashes(spark: SparkSession, path: str) -> DataFrame:
    rows = parse(numbered_lines(spark, path), schemas.HASH, "arquivo").filter("sha256 is not null")
    return latest(rows, "arquivo").select("arquivo", "sha256")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    rows = parse(numbered_lines(spark, path), schemas.SAMPLE, "arquivo").filter("sha256 is not null and estrato is not null")
    return rows.withColumn("paginas", F.coalesce("paginas", F.lit(0)))


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """sha256, tem_assinatura (NULL is doubt), seq; a line without the field isn't a label."""
    lines = numbered_lines(spark, path).filter(F.get_json_object("value", "$").isNotNull() & F.col("value").contains('"tem_assinatura"'))
    rows = parse(lines, schemas.LABEL, "sha256")
    last = rows.groupBy("sha256").agg(F.max_by(F.struct("tem_assinatura"), "seq").alias("last"), F.max("seq").alias("at"))
    return last.select("sha256", "last.tem_assinatura", F.col("at.line").alias("seq"))  # a content has one row by now


def read_triage(spark: SparkSession, path: str) -> DataFrame:
    """The exported triage; malformed JSON raises."""
    return spark.read.schema(schemas.TRIAGE).json(path, multiLine=True, mode="FAILFAST")


def write_labels(labels: DataFrame, path: str) -> None:
    """Labels by content, sorted; a doubtful label keeps its NULL."""
    rows = labels.select("sha256", "tem_assinatura").orderBy("sha256")
    rows.write.option("ignoreNullFields", "false").mode("overwrite").json(path)


def append_lines(rows: DataFrame, path: str) -> None:
    """One more batch of JSON lines: written aside, then given the next number by a rename.

    A task that runs again adds no second line, and a run that dies leaves a folder that readers pass
    over. Two writers at once are kept apart by the run lock, not here.
    """
    spark = rows.sparkSession
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(path)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    aside = f"{path.rstrip('/')}/_novo-{uuid.uuid4().hex}"
    rows.write.option("ignoreNullFields", "false").json(aside)
    names = [s.getPath().getName() for s in fs.listStatus(base)]
    last = max((int(n.removeprefix("lote-")) for n in names if n.startswith("lote-")), default=0)
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(aside), jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/lote-{last + 1:08}")):
        raise OSError(f"the batch in {aside} can't be given its number")


def append_records(records: DataFrame, path: str) -> None:
    append_lines(records.drop("seq", "first_seq"), path)


def append_label(spark: SparkSession, path: str, sha256: str, label: bool | None) -> None:
    """One more label; the last one of a content counts."""
    append_lines(spark.createDataFrame([(sha256, label)], schemas.LABEL), path)


def read_parameters(path: str) -> dict:
    """A small JSON document; missing or broken is empty."""
    try:
        with open(path, encoding="utf-8") as f:
            value = json.load(f)
    except (OSError, ValueError):
        return {}
    return value if isinstance(value, dict) else {}
