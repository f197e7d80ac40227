import json

from pyspark.sql import functions as F

from tests.lots import TEN, records
from vestigo import cli, schemas
from vestigo.operators import audit, forms
from vestigo.plans import report


def test_summary_from_the_command_line(spark, tmp_path):
    lines = [r.value for r in records(spark, TEN).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).collect()]
    (tmp_path / "r.jsonl").write_text("\n".join(lines), encoding="utf-8")
    assert cli.main(["resumo", "--registros", str(tmp_path / "r.jsonl"), "--saida", str(tmp_path)]) == 0
    found = json.loads((tmp_path / "RESUMO.json").read_text())
    assert found["documentos"] == 10 and found["fallback"] == {"documentos": 2, "paginas": 5, "documentos_resgatados": 1, "assinaturas": 1} and found["tempo"]["p95_ms_por_documento"] == 80.0
    assert "33.3 %" in (tmp_path / "RESUMO.md").read_text() and len((tmp_path / "COMPLETO.md").read_text().splitlines()) == 12
    assert (tmp_path / "COMPLETO.md").read_text().splitlines()[2].startswith("| 1 | ✅ | obras/contrato-7.pdf |")


def test_pages_of_cards_and_runs(spark):
    cards = [{"id": "0" * 12, "classe": "fn", "estrato": "s", "arquivo": "a b/<x>.pdf", "copias": 1, "detalhes": [["Arquivo", "</script><b>"]]}]
    page = "\n".join(report.cards_page(cards, "/lote", "/lote/saida"))
    assert "</script><b>" not in page and "../a%20b/%3Cx%3E.pdf" in page and json.loads(page.split('id="dados">')[1].split("</script>")[0])[0]["arquivo"] == "a b/<x>.pdf"
    page, found = report.run_report(records(spark, TEN[:3]))
    assert found["resumo"]["documentos"] == 3 and found["resumo"]["custo"] == "0.0315" and [d["veredito"] for d in found["documentos"]] == ["assinado (N0)", "assinado (N1)", "assinado (N0+N1)"] and page[0] == "# Resultados"


def test_validation_pages(spark):
    r = records(spark, [{"arquivo": f"{k}", "status": "sem_assinatura", "paginas": 1} for k in range(10)])
    index = spark.createDataFrame([(f"{k}" * 12, f"{k}" * 64, f"{k}", "neg_pdf_1pag", "sem_assinatura", 1) for k in range(4)], schemas.SAMPLE)
    labels = spark.createDataFrame([("0" * 64, True), ("1" * 64, False), ("2" * 64, None)], schemas.LABEL)
    hashes = r.select("arquivo", F.repeat("arquivo", F.lit(64)).alias("sha256"))
    found = report.validation(r, hashes, index, labels)
    assert found["por_estrato"]["neg_pdf_1pag"]["fator"] == 5.0 and found["matriz_estimada"]["falso_negativo"] == 5.0 and found["lote"]["documentos_com_rotulo_direto"] == 2
    assert any("Dúvida em 33.3 %" in x for x in report.validation_page(found))
    none = report.validation(r, hashes, index, labels.limit(0))
    assert report.validation_page(none)[-1] == "Ainda não há rótulos."
    cards = report.card_documents(r, index, labels)
    assert [c["classe"] for c in cards] == ["fn", "duvida", "vn"] and len(cards[0]["detalhes"]) == 12
    assert audit.error_shares(audit.by_stratum(r, index, labels)).first().parcela == 1.0


def test_form_page(spark):
    r = records(spark, [{"arquivo": "a", "fontes": ["pdf_embedded"]}, {"arquivo": "b", "fontes": ["pdf_embedded"]}])
    sample = r.select(F.lit("so_acroform").alias("grupo"), "arquivo")
    field = "named_struct('tem_valor', true, 'tem_byterange', true, 'bytes_pkcs7', 80, 'nome_declarado', '', 'nomes_no_certificado', array('ANA SILVA'))"
    fields = r.select("arquivo", F.expr(f"if(arquivo = 'a', array({field}), array())").alias("campos"), F.lit(None).cast("string").alias("erro"))
    page = "\n".join(report.form_page(forms.audited(sample, fields), r))
    assert "1 de 2 documentos" in page and "1 de 1 campos estão assinados, 1 deles sem nome declarado; 1 nomes" in page
