"""A lot derived from the driver's tables: records, labels and fields by integer arithmetic on documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classify import detection_status, file_type
from ..storage import persisted

#: The records as DuckDB SQL, for the oracles.
RECORDS_SQL = """
a AS (SELECT doc_id, coalesce(text, '') AS text, source, coalesce(n_chars, 0) AS n_chars,
    CASE WHEN doc_id % 20 < 12 THEN '.pdf' WHEN doc_id % 20 < 15 THEN '.png' WHEN doc_id % 20 = 15 THEN '.docx'
         WHEN doc_id % 20 = 16 THEN '.pptx' WHEN doc_id % 20 = 17 THEN '.zip' WHEN doc_id % 20 = 18 THEN '.xlsx' ELSE '.tif' END AS formato
    FROM documents),
b AS (SELECT *, concat(source, '/doc', doc_id, formato) AS arquivo, sha256(text) AS sha256, octet_length(encode(text)) AS tamanho_bytes,
    CASE WHEN formato = '.pdf' THEN 'pdf' WHEN formato IN ('.png', '.tif') THEN 'imagem' WHEN formato IN ('.docx', '.pptx') THEN 'ooxml'
         WHEN formato = '.zip' THEN 'zip' ELSE 'nao_suportado' END AS tipo FROM a),
c AS (SELECT *, tipo NOT IN ('zip', 'nao_suportado') AND doc_id % 31 <> 0 AS lido FROM b),
d AS (SELECT *, CASE WHEN NOT lido THEN 0 WHEN tipo = 'imagem' THEN 1 ELSE n_chars // 3000 + 1 END AS paginas,
    CASE WHEN lido AND doc_id % 37 = 0 THEN 'modelo indisponível' END AS nivel1_erro,
    CASE WHEN lido AND doc_id % 14 = 0 THEN 2 WHEN lido AND doc_id % 7 = 0 THEN 1 ELSE 0 END AS nivel0_total FROM c),
e AS (SELECT *, CASE WHEN doc_id % 11 = 0 THEN paginas ELSE 0 END AS paginas_em_branco,
    CASE WHEN NOT lido OR nivel1_erro IS NOT NULL OR doc_id % 11 = 0 THEN 0 WHEN n_chars % 5 = 0 THEN 1 WHEN n_chars % 5 = 1 THEN 2 ELSE 0 END AS nivel1_total FROM d),
f AS (SELECT *, CASE WHEN lido AND nivel1_erro IS NULL THEN least(paginas - paginas_em_branco, 3) ELSE 0 END AS paginas_analisadas_nivel1,
    lido AND paginas - paginas_em_branco > 3 AS paginas_limitadas, nivel0_total + nivel1_total AS assinaturas_total FROM e),
records AS (SELECT *, CASE WHEN nivel0_total = 0 AND (nivel1_total = 0 OR doc_id % 3 = 0) THEN paginas_analisadas_nivel1 ELSE 0 END AS paginas_ladrilhadas,
    CASE WHEN tipo = 'zip' THEN 'container' WHEN tipo = 'nao_suportado' THEN 'nao_suportado' WHEN NOT lido THEN 'erro'
         WHEN assinaturas_total > 0 THEN 'assinado' WHEN nivel1_erro IS NOT NULL THEN 'indeterminado' ELSE 'sem_assinatura' END AS status,
    CASE WHEN tipo = 'nao_suportado' THEN 'FormatoNaoSuportadoError' WHEN tipo <> 'zip' AND NOT lido AND doc_id % 2 = 0 THEN 'DocumentoInvalidoError'
         WHEN tipo <> 'zip' AND NOT lido THEN 'RuntimeError' END AS erro_tipo,
    CASE WHEN lido AND doc_id % 41 <> 0 THEN CAST(n_chars AS DOUBLE) ELSE 0.0 END AS tempo_ms,
    CASE WHEN lido THEN CAST(n_chars // 4 AS DOUBLE) ELSE 0.0 END AS tempo_inferencia_ms,
    CASE WHEN tipo NOT IN ('zip', 'nao_suportado') AND NOT lido THEN 1 + doc_id % 3 WHEN doc_id % 53 = 0 THEN 2 ELSE 1 END AS tentativas FROM f),
labels_ AS (SELECT r.sha256, CASE WHEN max(l.toxic) = 1 THEN NULL ELSE max(l.quality) = 1 END AS tem_assinatura
    FROM labels l JOIN records r ON r.doc_id = l.doc_id GROUP BY r.sha256)"""

#: The stratum of a record, in DuckDB SQL.
STRATUM_SQL = """CASE WHEN status = 'sem_assinatura' THEN CASE WHEN paginas_limitadas THEN 'neg_paginas_limitadas'
    WHEN paginas_analisadas_nivel1 = 0 THEN 'neg_sem_pagina_analisada' WHEN tipo = 'ooxml' THEN 'neg_ooxml' WHEN tipo = 'imagem' THEN 'neg_imagem'
    WHEN paginas <= 1 THEN 'neg_pdf_1pag' WHEN paginas = 2 THEN 'neg_pdf_2pag' ELSE 'neg_pdf_3pag_ou_mais' END
  WHEN status = 'assinado' THEN CASE WHEN nivel0_total > 0 THEN 'pos_nivel0' WHEN paginas_ladrilhadas > 0 THEN 'pos_resgatado_fallback'
    WHEN nivel1_total = 1 THEN 'pos_nivel1_uma_deteccao' ELSE 'pos_nivel1_varias' END ELSE '' END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lot's record table: derived once, then read column by column like any persisted checkpoint."""
    return persisted(spark, ("records", sf_dir), lambda: derive(spark, sf_dir))


def derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per document."""
    i, n = F.col("doc_id"), F.coalesce("n_chars", F.lit(0))
    m = lambda k: i % k
    ext = F.when(m(20) < 12, ".pdf").when(m(20) < 15, ".png").when(m(20) == 15, ".docx").when(m(20) == 16, ".pptx").when(m(20) == 17, ".zip").when(m(20) == 18, ".xlsx").otherwise(".tif")
    body = F.coalesce("text", F.lit(""))
    d = table(spark, sf_dir, "documents").withColumns({"n_chars": n, "formato": ext, "text": body})
    d = d.withColumns({"arquivo": F.concat("source", F.lit("/doc"), i.cast("string"), F.col("formato")), "sha256": F.sha2("text", 256), "tamanho_bytes": F.octet_length("text").cast("bigint"), "tipo": file_type("formato")})
    outside = F.col("tipo").isin("zip", "nao_suportado")
    d = d.withColumn("lido", ~outside & (m(31) != 0))
    d = d.withColumns(
        {
            "paginas": F.when(~F.col("lido"), 0).when(F.col("tipo") == "imagem", 1).otherwise(F.floor(F.col("n_chars") / 3000) + 1).cast("int"),
            "nivel1_erro": F.when(F.col("lido") & (m(37) == 0), "modelo indisponível"),
            "nivel0_total": F.when(F.col("lido") & (m(14) == 0), 2).when(F.col("lido") & (m(7) == 0), 1).otherwise(0),
        }
    )
    blind = ~F.col("lido") | F.col("nivel1_erro").isNotNull() | (m(11) == 0)
    d = d.withColumns(
        {
            "paginas_em_branco": F.when(m(11) == 0, F.col("paginas")).otherwise(0),
            "nivel1_total": F.when(blind, 0).when(F.col("n_chars") % 5 == 0, 1).when(F.col("n_chars") % 5 == 1, 2).otherwise(0),
        }
    )
    useful = F.col("paginas") - F.col("paginas_em_branco")
    d = d.withColumns(
        {
            "paginas_analisadas_nivel1": F.when(F.col("lido") & F.col("nivel1_erro").isNull(), F.least(useful, F.lit(3))).otherwise(0),
            "paginas_limitadas": F.col("lido") & (useful > 3),
            "assinaturas_total": F.col("nivel0_total") + F.col("nivel1_total"),
        }
    )
    failed = ~outside & ~F.col("lido")
    stamp = (F.col("nivel0_total") > 0) & (m(2) == 1)
    form = (F.col("nivel0_total") > 0) & (m(2) == 0)
    d = d.withColumns(
        {
            "paginas_ladrilhadas": F.when((F.col("nivel0_total") == 0) & ((F.col("nivel1_total") == 0) | (m(3) == 0)), F.col("paginas_analisadas_nivel1")).otherwise(0),
            "status": F.when(F.col("tipo") == "zip", "container").when(outside, "nao_suportado").when(failed, "erro").otherwise(detection_status("assinaturas_total", "nivel1_erro")),
            "erro_tipo": F.when(F.col("tipo") == "nao_suportado", "FormatoNaoSuportadoError").when(failed & (m(2) == 0), "DocumentoInvalidoError").when(failed, "RuntimeError"),
            "tempo_ms": F.when(F.col("lido") & (m(41) != 0), F.col("n_chars").cast("double")).otherwise(F.lit(0.0)),
            "tempo_inferencia_ms": F.when(F.col("lido"), F.floor(F.col("n_chars") / 4).cast("double")).otherwise(F.lit(0.0)),
            "tentativas": F.when(failed, 1 + m(3)).when(m(53) == 0, 2).otherwise(1).cast("int"),
            "fontes": F.array_compact(F.array(F.when(stamp, "digital"), F.when(form, "pdf_embedded"), F.when(F.col("nivel1_total") > 0, "visual"))),
            "signatarios": F.when(stamp, F.array(F.concat(F.lit("Signer "), (i % 9).cast("string")))).otherwise(F.array().cast("array<string>")),
            "seq": i,
        }
    )
    d = d.withColumns({"erro": F.when(F.col("erro_tipo").isNotNull(), F.concat(F.lit("falha | "), F.col("erro_tipo"))), "observacao": F.when(F.col("tipo") == "zip", "contêiner expandido"), "retentavel": F.col("erro_tipo") == "RuntimeError"})
    return d.drop("text")


def hashes(records_: DataFrame) -> DataFrame:
    return records_.select("arquivo", "sha256")


def labels(spark: SparkSession, sf_dir: str, records_: DataFrame) -> DataFrame:
    """By content: true where any copy has quality 1, doubt (NULL) where any is toxic."""
    rows = table(spark, sf_dir, "labels").join(records_.select("doc_id", "sha256"), "doc_id")
    return rows.groupBy("sha256").agg(F.when(F.max("toxic") == 1, F.lit(None).cast("boolean")).otherwise(F.max("quality") == 1).alias("tem_assinatura"))


def fields(records_: DataFrame) -> DataFrame:
    """arquivo, campos, erro: signature fields of documents with form evidence."""
    i = F.col("doc_id")
    one = F.struct(
        F.lit(1).alias("pagina"), F.lit("sig").alias("nome"), (i % 5 != 0).alias("tem_valor"), (i % 3 != 0).alias("tem_byterange"), (i % 200).cast("int").alias("bytes_pkcs7"),
        F.when(i % 4 == 0, "Fulano").alias("nome_declarado"),
        F.when(i % 8 == 0, F.array(F.lit("FULANO DE TAL"))).otherwise(F.array().cast("array<string>")).alias("nomes_no_certificado"),
    )
    campos = F.when(i % 9 == 0, F.array().cast("array<struct<pagina:int,nome:string,tem_valor:boolean,tem_byterange:boolean,bytes_pkcs7:int,nome_declarado:string,nomes_no_certificado:array<string>>>")).otherwise(F.array(one))
    bad = i % 29 == 0
    return records_.filter(F.array_contains("fontes", "pdf_embedded")).select("arquivo", F.when(~bad, campos).alias("campos"), F.when(bad, "ilegível").alias("erro"))
