"""Small per-document operators: preparability, page choice, result documents, test-run and resource summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRICE_PER_THOUSAND_PAGES = "3.50"


def preparability(files: DataFrame) -> DataFrame:
    """Adds erro, erro_tipo and retentavel; all NULL where a file (tipo, formato, tamanho_bytes, abre) can be processed.

    ``abre`` tells whether a backend opens it; NULL means that nobody tried. None of these failures goes away by itself.
    """
    outside = F.col("tipo").isin("nao_suportado", "zip")
    empty = F.col("tamanho_bytes") == 0
    closed = F.coalesce(~F.col("abre"), F.lit(False)) & (F.col("tipo") == "pdf")
    error = F.when(outside, F.concat(F.lit("formato "), F.col("formato"))).when(empty, "arquivo vazio").when(closed, "PDF ilegível ou com senha")
    kind = F.when(outside, "FormatoNaoSuportadoError").when(empty | closed, "DocumentoInvalidoError")
    return files.withColumns({"erro": error, "erro_tipo": kind, "retentavel": F.when(kind.isNotNull(), False)})


def select_pages(pages: Column, count: Column) -> Column:
    """Wanted pages, distinct, sorted and in range; all pages where none are named."""
    every = F.when(count >= 1, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    wanted = F.array_sort(F.array_distinct(F.filter(pages, lambda p: (p >= 1) & (p <= count))))
    return F.when(pages.isNull(), every).otherwise(wanted)


def ignored_pages(pages: Column, count: Column) -> Column:
    every = F.when(count >= 1, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.array_except(every, select_pages(pages, count))


def first_useful(pages: Column, most: int | None = None) -> Column:
    """Numbers of the pages that aren't blank, at most ``most``."""
    numbers = F.transform(F.filter(pages, lambda p: ~p["em_branco"]), lambda p: p["numero"])
    return numbers if not most else F.slice(numbers, 1, most)


def sheet_columns(pages: Column) -> Column:
    """Columns of a contact sheet."""
    return F.when(pages <= 1, 1).when(pages <= 4, 2).otherwise(3)


def result_document(rows: DataFrame) -> DataFrame:
    """doc and its detection result as one JSON document, from the cascade's rows."""
    rename = F.struct(
        (F.col("assinaturas_total") > 0).alias("tem_assinatura"), "fontes", "signatarios", "visual", "digital", "embedded", F.col("nivel1_erro").alias("visual_error"),
        F.struct(F.col("nivel0_total").alias("total"), (F.col("paginas") - F.col("paginas_em_branco")).alias("paginas_uteis"), "paginas_em_branco").alias("nivel0"),
        F.struct(F.col("nivel1_total").alias("total"), "paginas_analisadas", "paginas_ladrilhadas", "tempo_inferencia_ms").alias("nivel1"),
    )
    return rows.select("doc", F.to_json(rename, {"ignoreNullFields": "false"}).alias("resultado"))


def run_verdict() -> Column:
    n0, n1 = F.col("nivel0_total") > 0, F.col("nivel1_total") > 0
    failed = F.coalesce("nivel1_erro", F.lit("")) != ""
    return F.when(n0 & n1, "assinado (N0+N1)").when(n0, "assinado (N0)").when(n1, "assinado (N1)").when(failed, "indeterminado").otherwise("sem assinatura")


def run_summary(rows: DataFrame, price: str = PRICE_PER_THOUSAND_PAGES) -> DataFrame:
    """One row for a test run: pages, hits, times, and what a priced service would have cost per page, in decimals."""
    n = lambda c: F.coalesce(F.sum(F.col(c).cast("bigint")), F.lit(0))
    got = rows.agg(
        F.count("*").alias("documentos"), n("paginas").alias("paginas"), n("paginas_em_branco").alias("paginas_em_branco"), n("nivel0_total").alias("nivel0"), n("nivel1_total").alias("nivel1"),
        F.count_if(F.col("nivel0_total") > 0).alias("docs_nivel0"), F.count_if(F.col("nivel1_total") > 0).alias("docs_nivel1"),
        F.count_if((F.col("nivel0_total") > 0) | (F.col("nivel1_total") > 0)).alias("docs_assinados"), F.count_if(F.coalesce("nivel1_erro", F.lit("")) != "").alias("docs_com_erro"),
    )
    cost = lambda pages: (pages.cast("decimal(18,0)") * F.lit(price).cast("decimal(10,4)") / F.lit(1000).cast("decimal(4,0)")).cast("decimal(18,4)")
    useful = F.col("paginas") - F.col("paginas_em_branco")
    return got.withColumns({"custo": cost(F.col("paginas")), "custo_triado": cost(useful)})


def resource_summary(samples: DataFrame) -> DataFrame:
    """Mean and maximum of cpu, ram and rss samples, one decimal; zero without samples."""
    made = []
    for c in ("cpu", "ram", "rss"):
        made += [F.coalesce(F.bround(F.avg(c), 1), F.lit(0.0)).alias(f"{c}_media"), F.coalesce(F.bround(F.max(c), 1), F.lit(0.0)).alias(f"{c}_maxima")]
    return samples.agg(F.count("*").alias("amostras"), *made)


def valid_id(id_: Column) -> Column:
    return id_.rlike("^[0-9a-f]{12}$")


def label_of(word: Column) -> Column:
    """A label word as a boolean; doubt is NULL, and so is an unknown word (test membership first)."""
    return F.when(word == "sim", True).when(word == "nao", False)
