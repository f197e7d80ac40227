"""Two-pass external shuffle of documents into shards.

Pass one scatters records uniformly into memory-sized buckets by a seeded hash.
Pass two brings each bucket into one canonical order, shuffles it by a seeded
Fisher-Yates permutation and writes it. Buckets laid end to end are one random
order of the corpus; shards are equal runs of it, so their row counts differ by
one at most and slots have no gaps. Places come from the counts of the written
buckets, so a task that is run again after a lost executor can't shift them.

A bucket holds about ``bucket_bytes`` of all columns, at most, and there are
FEWEST of them at least. Beyond MOST buckets the scatter has two levels: a shuffle
partition takes a run of buckets, is sorted by bucket, and streams them in turn, so
a task never holds more than one. Copies of one record that fill more than a
quarter bucket, a short list by its definition, are scattered one by one. No
more than one row per bucket is brought together.

Defined results: a null text has no bytes and is written as null; a null doc_id
is a record like others; repeated rows are separate records, of which those that
fill more than a quarter bucket may lie otherwise where the input is partitioned
otherwise; other columns are carried along unless they bear a name of the output;
an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .shared import map_arrow, materialise

LAW = "rows"
#: Buckets that a small corpus has, so that its pass two runs in parallel, and shuffle partitions of a large one.
FEWEST, MOST = 8, 20_000
_OWN = ["size", "tag", "bucket", "place", "shard", "slot"]


def _fisher_yates(n: int, seed: int, bucket: int) -> list[int]:
    """A permutation of range(n): from the last place down, each is swapped with a random one up to itself."""
    draws = np.random.Generator(np.random.PCG64([seed, bucket])).integers(0, np.arange(1, n + 1)).tolist()
    order = list(range(n))
    for i in range(n - 1, 0, -1):
        j = draws[i]
        order[i], order[j] = order[j], order[i]
    return order


def _bytes(field: T.StructField) -> Column:
    """About the bytes that a column's value takes."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 8
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + 8
    return F.lit(8)


def _shuffle_buckets(placed: DataFrame, seed: int) -> DataFrame:
    """Every bucket's rows in their new order, with ``place`` in the bucket; rows come bucket by bucket."""
    schema = T.StructType([*placed.schema.fields, T.StructField("place", T.LongType())])

    def emit(held: list):
        table = pa.Table.from_batches(held)
        bucket = table.column("bucket")[0].as_py()
        canonical = pc.sort_indices(table.select(["tag", "doc_id"]), sort_keys=[("tag", "ascending"), ("doc_id", "ascending")]).to_numpy()
        order = canonical[_fisher_yates(table.num_rows, seed, bucket)]
        for a in range(0, len(order), 4096):
            part = table.take(pa.array(order[a : a + 4096]))
            yield from part.append_column("place", pa.array(np.arange(a, a + part.num_rows), pa.int64())).combine_chunks().to_batches()

    def run(batches):
        held: list = []
        for batch in batches:
            at = batch.column(batch.schema.get_field_index("bucket")).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)] if len(at) else []
            for a, b in zip(cuts, cuts[1:], strict=False):
                if held and held[0].column(held[0].schema.get_field_index("bucket"))[0].as_py() != at[a]:
                    yield from emit(held)
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield from emit(held)

    return map_arrow(placed, run, schema)


def external_shuffle(docs: DataFrame, shards: int = 40, seed: int = 42, bucket_bytes: int = 32 << 20) -> DataFrame:
    """All records with size, shard (0 to shards - 1) and slot; read from the written buckets, each of which lies in a run of slots."""
    docs = docs.drop(*_OWN)
    size = (F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)) + 16).cast("long")
    every = sum((_bytes(f) for f in docs.schema.fields), F.lit(0).cast("long"))
    sized = docs.withColumn("size", size).withColumn("tag", F.xxhash64(F.lit(seed), "doc_id", "text"))
    copies = sized.withColumn("bytes", every).groupBy("tag").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
    copies = materialise(copies, "copies")
    total = copies.agg(F.sum("bytes").alias("bytes")).first()["bytes"] or 0
    buckets = max(FEWEST, -(-total // bucket_bytes))
    hot = copies.filter((F.col("bytes") > total // (4 * buckets) + 4096) & (F.col("n") > 1)).select("tag", F.lit(True).alias("hot"))  # at most 4 * buckets
    apart = F.when(F.col("hot"), F.xxhash64("tag", F.monotonically_increasing_id())).otherwise(F.col("tag"))
    placed = sized.join(F.broadcast(hot), "tag", "left").withColumn("bucket", F.pmod(apart, F.lit(buckets)).cast("int"))
    placed = placed.select(*docs.columns, "size", "tag", "bucket")
    run = -(-buckets // MOST)
    dealt = placed.repartitionById(-(-buckets // run), F.expr(f"bucket div {run}").cast("int"))
    dealt = dealt.sortWithinPartitions("bucket") if run > 1 else dealt
    written = materialise(_shuffle_buckets(dealt, seed).drop("tag"), "buckets")
    counts = written.groupBy("bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.sum("n").over(Window.partitionBy()).alias("rows"))
    at = F.col("first") + F.col("place")
    laid = written.join(F.broadcast(counts), "bucket")  # a row per bucket
    laid = laid.withColumn("shard", F.expr(f"cast(((first + place) * {shards}L) div rows as int)"))
    return laid.withColumn("slot", at - F.expr(f"(shard * rows + {shards - 1}L) div {shards}L")).drop("bucket", "place", "first", "rows")


def write_shards(laid: DataFrame, path: str) -> None:
    """One folder per shard, each file in slot order."""
    laid.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
