import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.lots import FORMATS, STATUS, TEN, records
from vestigo import schemas
from vestigo.functions.classify import stratum
from vestigo.operators import audit, forms, rollup, sampling, triage


def test_counts_of_a_lot(spark):
    r = records(spark, TEN)
    c = rollup.counts(r).first()
    assert (c.documentos, c.documentos_avaliaveis, c.documentos_completos, c.documentos_com_retry) == (10, 9, 6, 1)
    assert (c.assinaturas_total, c.assinaturas_nivel0, c.assinaturas_nivel1) == (7, 3, 4) and (c.somente_nivel0, c.somente_nivel1, c.ambos) == (1, 2, 1)
    assert {x.status: x.n_docs for x in rollup.by_status(r).collect()} == STATUS
    assert {x.formato: tuple(x)[1:] for x in rollup.by_format(r).collect()} == FORMATS
    assert {x.erro_tipo: x.n_docs for x in rollup.by_error(r).collect()} == {"OSError": 1, "FormatoNaoSuportadoError": 1}
    assert {x.status for x in rollup.by_status(records(spark, [])).collect()} == set(STATUS)


def test_fallback_of_a_lot(spark):
    r = records(spark, TEN)
    c = rollup.counts(r).first()
    assert (c.fallback_documentos, c.fallback_paginas, c.fallback_resgatados, c.fallback_assinaturas) == (2, 5, 1, 1)
    x = rollup.rates(r).first()
    assert (x.taxa_assinado, x.taxa_sem_fallback, x.alertas) == (4 / 9, 3 / 9, 3)


def test_times(spark):
    t = rollup.times(records(spark, [{"arquivo": str(k), "tempo_ms": float(v)} for k, v in enumerate([0, 4, 1, 3, 2])])).first()
    assert (t.medio_ms, t.mediana_ms, t.p95_ms, t.maximo_ms) == (2.5, 2.5, 4, 4) and t.total_segundos == 0.01
    odd = rollup.times(records(spark, [{"arquivo": str(v), "tempo_ms": float(v)} for v in (5, 1, 9)])).first()
    assert odd.mediana_ms == 5
    none = rollup.times(records(spark, [])).first()
    assert none.mediana_ms == none.p95_ms == none.total_segundos == 0


def test_observation(spark):
    rows = [{"arquivo": "a"}, {"arquivo": "b", "erro": "x|y", "tentativas": 3, "paginas_ladrilhadas": 2}]
    got = {r.arquivo: r.observacao for r in rollup.observations(records(spark, rows)).collect()}
    assert got == {"a": "—", "b": "x\\|y; fallback 3×3 em 2 pág — assinatura resgatada; 3 tentativas"}


def test_strata(spark):
    neg = {"status": "sem_assinatura", "nivel0_total": 0}
    cases = [
        ({**neg, "paginas_limitadas": True}, "neg_paginas_limitadas"), ({**neg, "paginas_analisadas_nivel1": 0}, "neg_sem_pagina_analisada"), ({**neg, "tipo": "ooxml"}, "neg_ooxml"),
        ({**neg, "tipo": "imagem"}, "neg_imagem"), ({**neg, "paginas": 1}, "neg_pdf_1pag"), ({**neg, "paginas": 2}, "neg_pdf_2pag"), ({**neg, "paginas": 9}, "neg_pdf_3pag_ou_mais"),
        ({}, "pos_nivel0"), ({"nivel0_total": 0, "paginas_ladrilhadas": 1, "nivel1_total": 1}, "pos_resgatado_fallback"), ({"nivel0_total": 0, "nivel1_total": 1}, "pos_nivel1_uma_deteccao"),
        ({"nivel0_total": 0, "nivel1_total": 2}, "pos_nivel1_varias"), ({"status": "erro"}, ""), ({"status": "container"}, ""),
    ]
    rows = records(spark, [{"arquivo": f"{k:02}", **c} for k, (c, _) in enumerate(cases)])
    assert [r.e for r in rows.orderBy("arquivo").select(stratum().alias("e")).collect()] == [want for _, want in cases]


def _lot(spark, neg, pos, extra=0):
    rows = [{"arquivo": f"neg/{k:04}.pdf", "status": "sem_assinatura", "nivel0_total": 0, "paginas": 1} for k in range(neg)]
    rows += [{"arquivo": f"pos/{k:04}.pdf"} for k in range(pos)] + [{"arquivo": f"risk/{k:04}.pdf", "status": "sem_assinatura", "nivel0_total": 0, "paginas_limitadas": True} for k in range(extra)]
    r = records(spark, rows).cache()
    return r, r.select("arquivo", F.sha2("arquivo", 256).alias("sha256"))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(1, 60), st.integers(0, 60), st.integers(0, 5))
def test_samples_nest(spark, small, more, seed):
    r, h = _lot(spark, 120, 120)
    one = {x.arquivo for x in sampling.draw(r, h, small, small, seed, 5).collect()}
    two = {x.arquivo for x in sampling.draw(r, h, small + more, small + more, seed, 5).collect()}
    assert one <= two and one == {x.arquivo for x in sampling.draw(r, h, small, small, seed, 5).collect()}


def test_floor_and_seed(spark):
    r, h = _lot(spark, 1000, 0, 30)
    n = {x.estrato: x.n for x in sampling.draw(r, h, 100, 100).groupBy("estrato").agg(F.count("*").alias("n")).collect()}
    assert n["neg_paginas_limitadas"] == 20 and n["neg_pdf_1pag"] >= 90
    a, b = ({x.arquivo for x in sampling.draw(r, h, 100, 100, s).collect()} for s in (1, 2))
    assert a != b
    assert sampling.draw(r.limit(0), h, 10, 10).count() == 0


def test_ids_must_not_collide(spark, tmp_path):
    rows = [("a" * 12, "a" * 64, "x", "s", "assinado", 1), ("a" * 12, "a" * 12 + "b" * 52, "y", "s", "assinado", 1)]
    with pytest.raises(ValueError):
        sampling.write_index(spark.createDataFrame(rows, schemas.SAMPLE), str(tmp_path / "i"))


def _index(spark, rows):
    return spark.createDataFrame([(s[:12], s, a, e, st, 1) for s, a, e, st in rows], schemas.SAMPLE)


def test_reweighting(spark):
    r, h = _lot(spark, 1000, 0, 100)
    good = [(f"g{k:063}", f"neg/{k:04}.pdf", "neg_pdf_1pag", "sem_assinatura") for k in range(10)]
    bad = [(f"r{k:063}", f"risk/{k:04}.pdf", "neg_paginas_limitadas", "sem_assinatura") for k in range(40)]
    labels = spark.createDataFrame([(s, False) for s, *_ in good] + [(s, k < 20) for k, (s, *_) in enumerate(bad)], schemas.LABEL)
    strata = audit.by_stratum(r, _index(spark, good + bad), labels)
    m = audit.matrices(strata).first()
    assert (m.est_fn, m.fn) == (50, 20) and {x.estrato: x.fator for x in strata.collect()} == {"neg_pdf_1pag": 100, "neg_paginas_limitadas": 2.5}
    rates = {x.indicador: x for x in audit.rates(audit.matrices(strata)).collect()}
    assert abs(rates["acuracia"].valor - 1050 / 1100) < 1e-12 and rates["precisao"].valor is None and rates["f1"].valor is None


def test_rates_of_a_matrix(spark):
    m = spark.createDataFrame([(90.0, 10.0, 80.0, 20.0, 90, 10, 80, 20)], "est_vp double, est_fp double, est_vn double, est_fn double, vp long, fp long, vn long, fn long")
    got = {x.indicador: x.valor for x in audit.rates(m).collect()}
    assert got["precisao"] == 0.9 and abs(got["recall"] - 90 / 110) < 1e-12 and abs(got["especificidade"] - 80 / 90) < 1e-12 and got["vpn"] == 0.8 and got["acuracia"] == 0.85


def test_doubt_pending_and_cards(spark):
    r, h = _lot(spark, 4, 0)
    rows = [(c * 64, f"neg/000{k}.pdf", "neg_pdf_1pag", "sem_assinatura") for k, c in enumerate("abcd")] + [("a" * 64, "gone.pdf", "neg_pdf_1pag", "sem_assinatura")]
    index = _index(spark, rows)
    labels = spark.createDataFrame([("a" * 64, True), ("b" * 64, False), ("c" * 64, None)], schemas.LABEL)
    x = audit.sample_header(index, labels).first()
    assert (x.sorteados, x.conteudos_distintos, x.rotulados, x.duvidas, x.pendentes, x.fracao_duvida) == (5, 4, 3, 1, 1, 0.25)
    got = {c.sha256[0]: (c.classe, c.copias, c.arquivo, c.rank) for c in triage.cards(r, index, labels).collect()}
    assert got == {"a": ("fn", 2, "neg/0000.pdf", 1), "b": ("vn", 1, "neg/0001.pdf", 5), "c": ("duvida", 1, "neg/0002.pdf", 3)}
    d = triage.details(r, triage.cards(r, index, labels)).filter("arquivo = 'neg/0000.pdf'").first().detalhes
    assert len(d) == 12 and "2 cópia(s)" in d[1].valor


def test_one_label_covers_copies(spark):
    r, _ = _lot(spark, 7, 0)
    h = r.select("arquivo", F.lit("s").alias("sha256"))
    assert tuple(audit.coverage(r, h, spark.createDataFrame([("s", True)], schemas.LABEL)).first()) == (7, 7)


def test_folders_win_and_doubt_is_a_value(spark):
    persisted = spark.createDataFrame([("a", True, 1), ("b", True, 2), ("b", False, 3), ("z", True, 4)], "sha256 string, tem_assinatura boolean, seq long")
    files = spark.createDataFrame([("ia", "duvida"), ("ic", "com_assinatura"), ("ix", "com_assinatura"), ("ic", "sem_assinatura"), ("ib", "pendentes")], "id string, pasta string")
    known = spark.createDataFrame([("ia", "a"), ("ib", "b"), ("ic", "c")], "id string, sha256 string")
    got = {r.sha256: r.tem_assinatura for r in audit.resolve_labels(persisted, audit.folder_labels(files, known).withColumn("seq", F.col("seq").cast("long"))).collect()}
    assert got == {"a": None, "b": False, "c": False, "z": True}


def test_form_sample_and_projection(spark):
    form = {"fontes": ["pdf_embedded"]}
    r = records(spark, [{"arquivo": f"c{k}", **form} for k in range(5)] + [{"arquivo": "o", **form}, {"arquivo": "w", "fontes": ["pdf_embedded", "visual"]}])
    h = spark.createDataFrame([(f"c{k}", "same") for k in range(5)], schemas.HASH)
    assert sampling.draw_forms(r, h, 10).groupBy("grupo").count().orderBy("grupo").collect() == [("com_outra_evidencia", 1), ("so_acroform", 2)]
    by = spark.createDataFrame([("so_acroform", 2000, 2, 1, 1, 0, 0, 0)], "grupo string, populacao long, auditados long, assinado long, campo_vazio long, incompleto long, sem_campo long, erro long")
    assert forms.projection(by).first().projetados == 1000
