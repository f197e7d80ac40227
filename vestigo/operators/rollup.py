"""Roll-ups of a record table: one global aggregation plus small grouped ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocabulary as V
from ..functions.stats import at_indexes


def _sum(c: str):
    return F.coalesce(F.sum(F.col(c).cast("bigint")), F.lit(0)).cast("bigint")


def by_status(records: DataFrame) -> DataFrame:
    """status, n_docs: every known status, zero where none."""
    known = records.sparkSession.createDataFrame([(s,) for s in V.STATUSES], "status string")
    counts = records.groupBy("status").agg(F.count("*").alias("n"))
    return known.join(counts, "status", "left").select("status", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_docs"))


def by_format(records: DataFrame) -> DataFrame:
    """formato, documentos, assinados, sem_assinatura, alerta (anything else)."""
    s = F.col("status")
    return records.groupBy("formato").agg(
        F.count("*").alias("documentos"),
        F.count_if(s == "assinado").alias("assinados"),
        F.count_if(s == "sem_assinatura").alias("sem_assinatura"),
        F.count_if(~s.isin("assinado", "sem_assinatura")).alias("alerta"),
    )


def by_error(records: DataFrame) -> DataFrame:
    return records.filter("erro_tipo <> ''").groupBy("erro_tipo").agg(F.count("*").alias("n_docs"))


def counts(records: DataFrame) -> DataFrame:
    """Documents, signatures, methods, fallback and pages in one pass (one row)."""
    n0, n1, tiles = F.col("nivel0_total") > 0, F.col("nivel1_total") > 0, F.col("paginas_ladrilhadas") > 0
    total = F.col("assinaturas_total").cast("bigint")
    return records.agg(
        F.count("*").alias("documentos"),
        (F.count("*") - F.count_if(F.col("status") == "container")).alias("documentos_avaliaveis"),
        F.count_if(F.col("status").isin("assinado", "sem_assinatura")).alias("documentos_completos"),
        F.count_if(F.col("tentativas") > 1).alias("documentos_com_retry"),
        _sum("tamanho_bytes").alias("bytes_processados"),
        _sum("assinaturas_total").alias("assinaturas_total"),
        _sum("nivel0_total").alias("assinaturas_nivel0"),
        _sum("nivel1_total").alias("assinaturas_nivel1"),
        F.count_if(n0 & ~n1).alias("somente_nivel0"),
        F.count_if(n1 & ~n0).alias("somente_nivel1"),
        F.count_if(n0 & n1).alias("ambos"),
        F.count_if(tiles).alias("fallback_documentos"),
        _sum("paginas_ladrilhadas").alias("fallback_paginas"),
        F.count_if(tiles & (total > 0)).alias("fallback_resgatados"),
        F.coalesce(F.sum(F.when(tiles & (total > 0), total)), F.lit(0)).cast("bigint").alias("fallback_assinaturas"),
        _sum("paginas").alias("paginas_total"),
        _sum("paginas_em_branco").alias("paginas_em_branco"),
        _sum("paginas_analisadas_nivel1").alias("paginas_analisadas"),
        F.count_if(F.col("paginas_limitadas")).alias("documentos_limitados"),
    )


def times(records: DataFrame) -> DataFrame:
    """Times over the records that took any (one row); zero where there are none.

    The median is exact: the mean of the two middle values, found with the 95th percentile in the same passes.
    """
    took = F.when(F.col("tempo_ms") != 0, F.col("tempo_ms"))
    base = records.agg(
        F.coalesce(F.sum(took), F.lit(0.0)).alias("total_ms"),
        F.coalesce(F.avg(took), F.lit(0.0)).alias("medio_ms"),
        F.coalesce(F.max(took), F.lit(0.0)).alias("maximo_ms"),
        F.coalesce(F.sum("tempo_inferencia_ms"), F.lit(0.0)).alias("inferencia_ms"),
        F.coalesce(F.sum(F.col("paginas").cast("bigint")), F.lit(0)).alias("paginas"),
    )
    places = {"low": lambda n: F.floor((n - 1) / 2), "high": lambda n: F.floor(n / 2), "p95": lambda n: F.least(F.floor(n * 95 / 100), n - 1)}
    found = at_indexes(records.filter("tempo_ms <> 0"), "tempo_ms", places)
    found = found.agg(*[F.max(F.when(F.col("name") == k, F.col("v"))).alias(k) for k in places])
    one = base.join(F.broadcast(found), how="left")  # one row each
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return one.select(
        (F.col("total_ms") / 1000).alias("total_segundos"),
        "medio_ms",
        F.coalesce((F.col("low") + F.col("high")) / 2, F.lit(0.0)).alias("mediana_ms"),
        F.coalesce("p95", F.lit(0.0)).alias("p95_ms"),
        "maximo_ms",
        ratio(F.col("total_ms"), F.col("paginas")).alias("ms_por_pagina"),
        (F.col("inferencia_ms") / 1000).alias("inferencia_segundos"),
        (ratio(F.col("inferencia_ms"), F.col("total_ms")) * 100).alias("percentual_inferencia"),
    )


def rates(records: DataFrame) -> DataFrame:
    """Shares of the evaluable documents, alerts, and the signed share with and without the tile fallback."""
    s = F.col("status")
    base = records.agg(
        F.greatest(F.count_if(s != "container"), F.lit(1)).alias("n"),
        F.count_if(s == "assinado").alias("assinado"),
        F.count_if(s == "sem_assinatura").alias("sem_assinatura"),
        F.count_if(s.isin("erro", "indeterminado", "nao_suportado")).alias("alertas"),
        F.count_if((F.col("paginas_ladrilhadas") > 0) & (F.col("assinaturas_total") > 0)).alias("resgatados"),
    )
    share = lambda c: F.col(c) / F.col("n")
    return base.select(
        "alertas",
        share("assinado").alias("taxa_assinado"),
        share("sem_assinatura").alias("taxa_sem_assinatura"),
        share("alertas").alias("taxa_alertas"),
        ((F.col("assinado") - F.col("resgatados")) / F.col("n")).alias("taxa_sem_fallback"),
    )


def slowest(records: DataFrame, k: int = 10) -> DataFrame:
    rows = records.orderBy(F.desc("tempo_ms"), F.lower("arquivo"), "arquivo").limit(k)
    return rows.select("arquivo", "tempo_ms", "paginas", "status")


def first_errors(records: DataFrame, k: int = 15) -> DataFrame:
    rows = records.filter("status = 'erro'").orderBy(F.lower("arquivo"), "arquivo").limit(k)
    return rows.select("arquivo", "erro_tipo", "erro", "tentativas")


def remark() -> Column:
    """A record's remark: the non-empty parts joined, or a dash."""
    some = lambda c: F.nullif(F.col(c), F.lit(""))
    pages = F.when(
        F.col("paginas_ladrilhadas") > 0,
        F.concat(F.lit("fallback 3×3 em "), F.col("paginas_ladrilhadas").cast("string"), F.lit(" pág"), F.when(F.col("assinaturas_total") > 0, " — assinatura resgatada").otherwise("")),
    )
    limited = F.when(F.col("paginas_limitadas"), F.concat(F.lit("Nível 1 limitado às primeiras "), F.col("paginas_analisadas_nivel1").cast("string"), F.lit(" págs")))
    tries = F.when(F.col("tentativas") > 1, F.concat(F.col("tentativas").cast("string"), F.lit(" tentativas")))
    text = F.concat_ws("; ", some("observacao"), some("erro"), F.concat(F.lit("Nível 1 indisponível: "), some("nivel1_erro")), pages, limited, tries)
    text = F.regexp_replace(F.regexp_replace(text, r"\|", r"\\|"), "\n", " ")
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("—"))


def observations(records: DataFrame) -> DataFrame:
    """arquivo and its remark."""
    return records.select("arquivo", remark().alias("observacao"))
