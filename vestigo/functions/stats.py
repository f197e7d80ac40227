"""Intervals, rates and index percentiles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..vocabulary import Z95


def wilson(successes: Column, n: Column, z: float = Z95) -> tuple[Column, Column]:
    """Bounds of the Wilson interval, clamped to [0, 1]; (0, 0) without trials."""
    p = successes / n
    base = 1 + z * z / n
    centre = (p + z * z / (2 * n)) / base
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / base
    some = n > 0
    return (
        F.when(some, F.greatest(centre - half, F.lit(0.0))).otherwise(F.lit(0.0)),
        F.when(some, F.least(centre + half, F.lit(1.0))).otherwise(F.lit(0.0)),
    )


def rate(num: Column, den: Column, n: Column) -> tuple[Column, Column, Column]:
    """(value, low, high): the weighted share with the interval of the raw number of trials; NULL without either."""
    some = (den > 0) & (n > 0)
    value = F.when(some, num / den)
    low, high = wilson(value * n, n)
    return value, F.when(some, low), F.when(some, high)


#: Slices of a band.
SLICES = 1 << 20


def _band(value: Column) -> Column:
    """A coarse integer that never falls as ``value`` rises: at most some hundred thousand bands for all doubles."""
    size = F.floor(F.log2(F.abs(value)) * 64) + 100_000
    return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0)).cast("bigint")


def at_indexes(df: DataFrame, value: str, indexes: dict[str, Callable[[Column], Column]], *keys: str) -> DataFrame:
    """(keys, name, v): per group the value at each named 0-based index; an index is a function of the group's size.

    Counts of bands, pre-aggregated, tell which band holds an index; that band is cut into about a
    million slices between its least and largest value, and only the values of one slice, each once,
    are put in order. No task sorts or collects a whole group, and all indexes share the three passes.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("v"), _band(F.col(value)).alias("band"))
    bands = rows.groupBy(*keys, "band").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    upto = lambda by, *part: F.sum("n").over(Window.partitionBy(*part).orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    holds = lambda at: (F.col("upto") > F.col(at)) & (F.col("upto") - F.col("n") <= F.col(at))
    total = F.col("total")
    named = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), f(total).cast("bigint").alias("at")) for k, f in indexes.items()]))
    bands = bands.withColumns({"upto": upto("band", *keys), "total": F.sum("n").over(Window.partitionBy(*keys))}).withColumn("w", named).select("*", "w.*")
    hit = bands.filter(holds("at")).select(*keys, "name", "band", "low", "high", (F.col("at") - F.col("upto") + F.col("n")).alias("inside"))
    inside = rows.join(hit, [*keys, "band"])
    place = (F.col("v") - F.col("low")) / (F.col("high") - F.col("low")) * SLICES  # never falls as v rises
    inside = inside.withColumn("slice", F.when(F.col("high") > F.col("low"), F.floor(place)).otherwise(F.lit(0)).cast("bigint"))
    slices = inside.groupBy(*keys, "name", "slice").agg(F.count("*").alias("n"), F.first("inside").alias("inside"))
    slices = slices.withColumn("upto", upto("slice", *keys, "name")).filter(holds("inside"))
    last = slices.select(*keys, "name", "slice", (F.col("inside") - F.col("upto") + F.col("n")).alias("last"))
    counts = inside.join(last, [*keys, "name", "slice"]).groupBy(*keys, "name", "v", "last").agg(F.count("*").alias("n"))
    return counts.withColumn("upto", upto("v", *keys, "name")).filter(holds("last")).select(*keys, "name", "v")


def index_percentile(df: DataFrame, value: str, percent: int, *keys: str) -> DataFrame:
    """The value at 0-based index least(floor(n * percent / 100), n - 1) of each group."""
    found = at_indexes(df, value, {"p": lambda n: F.least(F.floor(n * percent / 100), n - 1)}, *keys)
    return found.select(*keys, F.col("v").alias(f"p{percent}_{value}"))
