"""Stratified, nested, seeded sampling.

The order inside a stratum is the MD5 of seed, stratum and path. It is the same
on every engine, independent between strata, and a larger budget takes a longer
prefix, so a larger sample contains the smaller one.

Only the needed prefix of each stratum is ranked: a stratum may hold most of the
lot, so rows are first cut to those under a hash threshold that surely holds the
prefix, and only where that cut falls short all rows are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import vocabulary as V
from ..functions.classify import form_group, stratum
from ..storage import materialise


def draw_key(seed: int, group: Column, path: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), group, path))


def evaluable(records: DataFrame) -> DataFrame:
    """Records with ``estrato``; those that aren't auditable go."""
    return records.withColumn("estrato", stratum()).filter("estrato <> ''")


def population(records: DataFrame) -> DataFrame:
    return evaluable(records).groupBy("estrato").agg(F.count("*").alias("populacao"))


def allocate(sizes: DataFrame, negatives: int, positives: int, floor: int = 20) -> DataFrame:
    """estrato, tamanho, quota: proportional to size per side, with a floor, at most the stratum itself.

    Ties of rounding go to the even number. At most eleven rows take part.
    """
    side = F.substring("estrato", 1, 4)
    budget = F.when(side == "neg_", F.lit(negatives)).otherwise(F.lit(positives))
    total = F.sum("tamanho").over(Window.partitionBy(side))
    share = F.bround(budget * F.col("tamanho") / total, 0).cast("bigint")
    return sizes.select("estrato", "tamanho", F.least("tamanho", F.greatest(F.lit(floor).cast("bigint"), share)).alias("quota"))


def _prefix(rows: DataFrame, group: str, quota: DataFrame, size: str) -> DataFrame:
    """The first ``quota`` rows of each group by (draw, arquivo); ``quota`` has group, size and quota.

    A uniform key's expected share of rows under x is x; a margin of eight standard
    deviations and 64 rows makes the cut hold the prefix. Where it doesn't, the rank
    over all rows decides: the count under the cut is checked.
    """
    need = F.col("quota") + 8 * F.sqrt(F.col("quota").cast("double")) + 64
    cut = quota.select(group, "quota", F.least(need / F.col(size), F.lit(1.0)).alias("share"))
    x = F.conv(F.substring("draw", 1, 13), 16, 10).cast("double") / float(16**13)
    marked = rows.join(F.broadcast(cut), group).withColumn("x", x)  # at most a row per group of a fixed list
    near = marked.filter("x < share")
    got = near.groupBy(group).agg(F.count("*").alias("got"))
    short = cut.join(got, group, "left").filter("coalesce(got, 0) < quota and share < 1").select(group)
    rest = marked.filter("x >= share").join(F.broadcast(short), group, "left_semi")
    w = Window.partitionBy(group).orderBy("draw", "arquivo")
    return near.unionByName(rest).withColumn("nth", F.row_number().over(w)).filter("nth <= quota").drop("nth", "quota", "share", "x")


def draw(records: DataFrame, hashes: DataFrame, negatives: int, positives: int, seed: int = 42, floor: int = 20) -> DataFrame:
    """The sample: id, sha256, arquivo, estrato, status, paginas. Documents without a hash can't be drawn."""
    pool = evaluable(records).join(hashes.filter("sha256 <> ''").select("arquivo", "sha256"), "arquivo")
    pool = pool.withColumn("draw", draw_key(seed, F.col("estrato"), F.col("arquivo"))).select("estrato", "arquivo", "sha256", "status", "paginas", "draw")
    pool = materialise(pool, "pool")  # read three times: sizes, near and rest
    quota = allocate(pool.groupBy("estrato").agg(F.count("*").alias("tamanho")), negatives, positives, floor)
    rows = _prefix(pool, "estrato", quota, "tamanho")
    return rows.select(F.substring("sha256", 1, V.ID_LENGTH).alias("id"), "sha256", "arquivo", "estrato", "status", F.coalesce("paginas", F.lit(0)).alias("paginas"))


def colliding_ids(index: DataFrame) -> DataFrame:
    """Short ids that stand for several contents; writing an index with any must fail."""
    return index.groupBy("id").agg(F.count_distinct("sha256").alias("n_contents")).filter("n_contents > 1")


def write_index(index: DataFrame, path: str) -> None:
    if not colliding_ids(index).isEmpty():
        raise ValueError("two contents share a short id")
    index.orderBy("estrato", "arquivo").write.mode("overwrite").json(path)


def draw_forms(records: DataFrame, hashes: DataFrame, per_group: int, seed: int = 42) -> DataFrame:
    """grupo, arquivo, conteudo: per evidence group the first distinct contents, group after group.

    A content taken in the first group is barred from the second; one that the first
    group didn't reach isn't.
    """
    pool = records.withColumn("grupo", form_group()).filter("grupo is not null").join(hashes.select("arquivo", "sha256"), "arquivo", "left")
    pool = pool.select("grupo", "arquivo", F.coalesce("sha256", "arquivo").alias("conteudo"), draw_key(seed, F.col("grupo"), F.col("arquivo")).alias("draw"))
    taken = None
    for name in V.FORM_GROUPS:
        group = pool.filter(F.col("grupo") == name)
        if taken is not None:
            group = group.join(taken.select("conteudo"), "conteudo", "left_anti")
        # One row per content, pre-aggregated; then the top of the order, which needs no full sort.
        firsts = group.groupBy("grupo", "conteudo").agg(F.min(F.struct("draw", "arquivo")).alias("first"))
        picked = firsts.select("grupo", "conteudo", "first.draw", "first.arquivo").orderBy("draw", "arquivo").limit(per_group)
        taken = picked if taken is None else taken.unionByName(picked)
    return taken.select("grupo", "arquivo", "conteudo")


def labelling_queue(index: DataFrame, seed: int = 42, only: DataFrame | None = None) -> DataFrame:
    """One item per content in seeded order, optionally only the given ids; the last path of the index stands for it."""
    items = index.groupBy("id", "sha256").agg(F.max_by(F.struct("arquivo", "estrato"), F.struct("estrato", "arquivo")).alias("item"), F.count("*").alias("copias"))
    if only is not None:
        items = items.join(only.select("id").distinct(), "id", "left_semi")
    return items.select("id", "sha256", "item.arquivo", "item.estrato", "copias", F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("fila"), F.col("id"))).alias("ordem"))
