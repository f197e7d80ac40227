import json
from decimal import Decimal

from pyspark.sql import functions as F

from vestigo.operators import documents as D


def test_preparability(spark):
    rows = [("a", "pdf", ".pdf", 5, True), ("b", "pdf", ".pdf", 0, None), ("c", "pdf", ".pdf", 5, False), ("d", "nao_suportado", ".xls", 5, None), ("e", "imagem", ".png", 5, False)]
    got = {r.k: (r.erro_tipo, r.retentavel) for r in D.preparability(spark.createDataFrame(rows, "k string, tipo string, formato string, tamanho_bytes long, abre boolean")).collect()}
    bad, out = ("DocumentoInvalidoError", False), ("FormatoNaoSuportadoError", False)
    assert got == {"a": (None, None), "b": bad, "c": bad, "d": out, "e": (None, None)}


def test_pages(spark):
    df = spark.createDataFrame([([3, 1, 3, 9, 0], 4), (None, 2), ([], 2), (None, 0)], "p array<int>, n int")
    got = df.select(D.select_pages(F.col("p"), F.col("n")).alias("s"), D.ignored_pages(F.col("p"), F.col("n")).alias("i")).collect()
    assert [(r.s, r.i) for r in got] == [([1, 3], [2, 4]), ([1, 2], []), ([], [1, 2]), ([], [])]
    pages = F.expr("array(named_struct('numero', 1, 'em_branco', true), named_struct('numero', 2, 'em_branco', false), named_struct('numero', 3, 'em_branco', false))")
    r = spark.range(1).select(D.first_useful(pages).alias("a"), D.first_useful(pages, 1).alias("b"), *[D.sheet_columns(F.lit(k)).alias(f"c{k}") for k in (1, 4, 5)]).first()
    assert (r.a, r.b, r.c1, r.c4, r.c5) == ([2, 3], [2], 1, 2, 3)


def test_run_and_resources(spark):
    rows = spark.createDataFrame([(29, 0, 3, 0, None), (0, 0, 0, 2, None), (1, 1, 0, 0, "x"), (0, 0, 0, 0, None), (0, 0, 1, 1, None)], "paginas int, paginas_em_branco int, nivel0_total int, nivel1_total int, nivel1_erro string")
    assert [r.v for r in rows.select(D.run_verdict().alias("v")).collect()] == ["assinado (N0)", "assinado (N1)", "indeterminado", "sem assinatura", "assinado (N0+N1)"]
    s = D.run_summary(rows).first()
    assert (s.documentos, s.paginas, s.docs_assinados, s.docs_com_erro) == (5, 30, 3, 1) and s.custo == Decimal("0.1050") and s.custo_triado == Decimal("0.1015")
    r = D.resource_summary(spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 2.0, 5.0)], "cpu double, ram double, rss double")).first()
    assert (r.amostras, r.cpu_media, r.rss_maxima) == (2, 1.5, 5.0)
    assert D.resource_summary(spark.createDataFrame([], "cpu double, ram double, rss double")).first().cpu_media == 0


def test_ids_and_words(spark):
    r = spark.range(1).select(D.valid_id(F.lit("0123456789ab")).alias("a"), D.valid_id(F.lit("0123456789aB")).alias("b"), D.label_of(F.lit("sim")).alias("c"), D.label_of(F.lit("duvida")).alias("d")).first()
    assert (r.a, r.b, r.c, r.d) == (True, False, True, None)


def test_result_document(spark):
    row = spark.range(1).select(
        F.lit("a").alias("doc"), F.lit(1).alias("assinaturas_total"), F.array(F.lit("digital")).alias("fontes"), F.array(F.lit("ANA")).alias("signatarios"), F.array().alias("visual"), F.array().alias("digital"), F.array().alias("embedded"),
        F.lit(None).cast("string").alias("nivel1_erro"), *[F.lit(k).alias(c) for k, c in enumerate(("nivel0_total", "paginas_em_branco", "nivel1_total", "paginas", "paginas_analisadas", "paginas_ladrilhadas", "tempo_inferencia_ms"))],
    )
    d = json.loads(D.result_document(row).first().resultado)
    assert d["tem_assinatura"] is True and d["visual_error"] is None and d["nivel0"]["paginas_uteis"] == 2 and d["nivel1"]["paginas_analisadas"] == 4
