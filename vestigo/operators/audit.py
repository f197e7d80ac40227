"""How far verdicts can be trusted: reweighted confusion matrices with Wilson intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classify import confusion_class, stratum_order
from ..functions.stats import rate
from .sampling import evaluable, population

CELLS = ("vp", "fp", "vn", "fn")


def resolve_labels(persisted: DataFrame, folders: DataFrame) -> DataFrame:
    """Labels by content; a folder's label, even doubt (NULL), replaces a persisted one.

    Both have sha256, tem_assinatura and seq; the last row of a source wins.
    """
    both = persisted.select("sha256", "tem_assinatura", F.lit(0).alias("rank"), "seq").unionByName(folders.select("sha256", "tem_assinatura", F.lit(1).alias("rank"), "seq"))
    last = both.groupBy("sha256").agg(F.max_by(F.struct("tem_assinatura"), F.struct("rank", "seq")).alias("last"))
    return last.select("sha256", "last.tem_assinatura")


def folder_labels(files: DataFrame, known: DataFrame) -> DataFrame:
    """Labels from folders (id, rotulo_pasta): unknown ids are passed over, a later folder of the fixed order wins."""
    place = F.when(F.col("pasta") == "com_assinatura", 0).when(F.col("pasta") == "sem_assinatura", 1).when(F.col("pasta") == "duvida", 2)
    label = F.when(F.col("pasta") == "com_assinatura", True).when(F.col("pasta") == "sem_assinatura", False)
    rows = files.withColumns({"seq": place, "tem_assinatura": label}).filter("seq is not null").join(known.select("id", "sha256").distinct(), "id")
    return rows.groupBy("sha256").agg(F.max_by(F.struct("tem_assinatura"), "seq").alias("last"), F.max("seq").alias("seq")).select("sha256", "last.tem_assinatura", "seq")


def labelled(index: DataFrame, labels: DataFrame) -> DataFrame:
    """Index rows with has_label, label and class (NULL where there is no label)."""
    known = labels.select("sha256", F.lit(True).alias("has_label"), F.col("tem_assinatura").alias("label"))
    rows = index.join(known, "sha256", "left").withColumn("has_label", F.coalesce("has_label", F.lit(False)))
    return rows.withColumn("classe", F.when(F.col("has_label"), confusion_class(F.col("status") == "assinado", F.col("label"))))


def by_stratum(records: DataFrame, index: DataFrame, labels: DataFrame) -> DataFrame:
    """Per stratum of the index: population, drawn, labelled, doubts, cells, weight and estimated errors."""
    cells = [F.count_if(F.col("classe") == c).alias(c) for c in CELLS]
    drawn = labelled(index, labels).groupBy("estrato").agg(
        F.count("*").alias("sorteados"), F.count_if(F.col("has_label") & F.col("label").isNotNull()).alias("rotulados"), F.count_if(F.col("classe") == "duvida").alias("duvidas"), *cells
    )
    rows = drawn.join(population(records), "estrato", "left").withColumn("populacao", F.coalesce("populacao", F.lit(0)))
    weight = F.when((F.col("rotulados") > 0) & (F.col("populacao") > 0), F.col("populacao") / F.col("rotulados"))
    return rows.withColumn("fator", weight).withColumn("erros_estimados", F.coalesce((F.col("fp") + F.col("fn")) * F.col("fator"), F.lit(0.0)))


def matrices(strata: DataFrame) -> DataFrame:
    """One row: the weighted cells (est_*) and the raw ones; strata without labels add nothing to the weighted."""
    est = [F.coalesce(F.sum(F.col(c) * F.col("fator")), F.lit(0.0)).alias(f"est_{c}") for c in CELLS]
    return strata.agg(*est, *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in CELLS])


def rates(matrix: DataFrame) -> DataFrame:
    """indicador, valor, baixo, alto, n: five rates with intervals of the raw size, and F1."""
    e = {c: F.col(f"est_{c}") for c in CELLS}
    r = {c: F.col(c) for c in CELLS}
    sums = {
        "acuracia": (("vp", "vn"), CELLS),
        "precisao": (("vp",), ("vp", "fp")),
        "recall": (("vp",), ("vp", "fn")),
        "especificidade": (("vn",), ("vn", "fp")),
        "vpn": (("vn",), ("vn", "fn")),
    }
    add = lambda of, names: sum((of[c] for c in names[1:]), of[names[0]])
    rows, values = [], {}
    for name, (num, den) in sums.items():
        n = add(r, den)
        value, low, high = rate(add(e, num), add(e, den), n)
        values[name] = value
        rows.append(F.struct(F.lit(name).alias("indicador"), value.alias("valor"), low.alias("baixo"), high.alias("alto"), n.alias("n")))
    p, q = values["precisao"], values["recall"]
    f1 = F.when((p > 0) & (q > 0), 2 * p * q / (p + q))
    none = F.lit(None).cast("double")
    rows.append(F.struct(F.lit("f1").alias("indicador"), f1.alias("valor"), none.alias("baixo"), none.alias("alto"), add(r, CELLS).alias("n")))
    return matrix.select(F.inline(F.array(*rows)))


def coverage(records: DataFrame, hashes: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: evaluable documents, and those whose content has a decided label."""
    decided = labels.filter("tem_assinatura is not null").select("sha256").distinct()
    docs = evaluable(records).join(hashes.select("arquivo", "sha256"), "arquivo", "left")
    seen = docs.join(decided.withColumn("decided", F.lit(True)), "sha256", "left")
    return seen.agg(F.count("*").alias("documentos_avaliaveis"), F.count_if(F.coalesce("decided", F.lit(False))).alias("com_rotulo_direto"))


def represented(strata: DataFrame, records: DataFrame) -> DataFrame:
    """One row: population of strata with labels, and its share of the evaluable documents."""
    part = strata.agg(F.coalesce(F.sum(F.when(F.col("rotulados") > 0, F.col("populacao"))), F.lit(0)).cast("bigint").alias("populacao_representada"))
    whole = evaluable(records).agg(F.count("*").alias("avaliaveis"))
    one = part.join(F.broadcast(whole), how="left")  # one row each
    return one.select("populacao_representada", "avaliaveis", F.when(F.col("avaliaveis") > 0, F.col("populacao_representada") / F.col("avaliaveis")).otherwise(F.lit(0.0)).alias("fracao_representada"))


def sample_header(index: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: drawn, contents, labelled, doubts, pending contents and the share of doubt."""
    rows = labelled(index, labels)
    got = rows.agg(
        F.count("*").alias("sorteados"),
        F.count_distinct("sha256").alias("conteudos_distintos"),
        F.count_if(F.col("has_label") & F.col("label").isNotNull()).alias("rotulados"),
        F.count_if(F.col("classe") == "duvida").alias("duvidas"),
        F.count_distinct(F.when(~F.col("has_label"), F.col("sha256"))).alias("pendentes"),
    )
    known = F.col("rotulados") + F.col("duvidas")
    return got.withColumn("fracao_duvida", F.when(known > 0, F.col("duvidas") / known).otherwise(F.lit(0.0)))


def error_shares(strata: DataFrame) -> DataFrame:
    """estrato and its share of all estimated errors; at most one row per stratum."""
    total = strata.agg(F.sum("erros_estimados").alias("all"))
    rows = strata.select("estrato", "erros_estimados").join(F.broadcast(total), how="left")  # one row
    return rows.select("estrato", "erros_estimados", (F.col("erros_estimados") / F.when(F.col("all") > 0, F.col("all")).otherwise(F.lit(1.0))).alias("parcela"), stratum_order("estrato").alias("ordem"))


def duplication(records: DataFrame, hashes: DataFrame) -> DataFrame:
    docs = evaluable(records).join(hashes.select("arquivo", "sha256"), "arquivo")
    got = docs.agg(F.count("*").alias("documentos"), F.count_distinct("sha256").alias("conteudos"))
    return got.withColumn("fator", F.col("documentos") / F.greatest("conteudos", F.lit(1)))
