"""Reports: small aggregates become JSON documents and Markdown pages; long listings stream row by row.

Presentation rounds like Python does (half to even on the exact value).
"""

from __future__ import annotations

import json
import os
import urllib.parse
from collections.abc import Iterable, Iterator
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocabulary as V
from ..functions.classify import stratum_order
from ..operators import audit, documents, forms, rollup, triage
from ..sources.records import ordered

MARKS = {"assinado": "✅", "sem_assinatura": "❌"}


def _table(header: Iterable[str], rows: Iterable[Iterable[Any]]) -> list[str]:
    header = list(header)
    cell = lambda x: str("" if x is None else x).replace("|", "\\|").replace("\n", " ")
    return ["| " + " | ".join(header) + " |", "|" + "---|" * len(header), *("| " + " | ".join(map(cell, r)) + " |" for r in rows), ""]


def _percent(x: float | None) -> str:
    return "—" if x is None else f"{100 * x:.1f} %"


def summary(records: DataFrame) -> dict[str, Any]:
    """The batch summary as one document."""
    c, t = rollup.counts(records).first(), rollup.times(records).first()
    status = {r.status: r.n_docs for r in rollup.by_status(records).collect()}
    formats = {r.formato: r.asDict() for r in rollup.by_format(records).collect()}
    return {
        "documentos": c.documentos,
        "documentos_avaliaveis": c.documentos_avaliaveis,
        "status": {s: status[s] for s in V.STATUSES},
        "assinaturas": {"total": c.assinaturas_total, "nivel0": c.assinaturas_nivel0, "nivel1": c.assinaturas_nivel1},
        "documentos_por_metodo": {"somente_nivel0": c.somente_nivel0, "somente_nivel1": c.somente_nivel1, "ambos": c.ambos},
        "fallback": {"documentos": c.fallback_documentos, "paginas": c.fallback_paginas, "documentos_resgatados": c.fallback_resgatados, "assinaturas": c.fallback_assinaturas},
        "paginas": {"total": c.paginas_total, "em_branco": c.paginas_em_branco, "analisadas_nivel1": c.paginas_analisadas, "documentos_com_limite_de_paginas": c.documentos_limitados},
        "tempo": {
            "total_segundos": round(t.total_segundos, 1), "medio_ms_por_documento": round(t.medio_ms, 1), "mediana_ms_por_documento": round(t.mediana_ms, 1), "p95_ms_por_documento": round(t.p95_ms, 1),
            "maximo_ms_por_documento": round(t.maximo_ms, 1), "medio_ms_por_pagina": round(t.ms_por_pagina, 1), "inferencia_segundos": round(t.inferencia_segundos, 1), "percentual_em_inferencia": round(t.percentual_inferencia, 1),
        },
        "bytes_processados": c.bytes_processados,
        "documentos_com_retry": c.documentos_com_retry,
        "documentos_completos": c.documentos_completos,
        "por_formato": {k: {n: v for n, v in formats[k].items() if n != "formato"} for k in sorted(formats)},
        "erros_por_tipo": {r.erro_tipo: r.n_docs for r in rollup.by_error(records).orderBy(F.desc("n_docs"), "erro_tipo").collect()},
    }


def summary_page(records: DataFrame, found: dict[str, Any]) -> list[str]:
    n = max(found["documentos_avaliaveis"], 1)
    status, fall = found["status"], found["fallback"]
    page = ["# Resumo do lote", "", f"{found['documentos']} registros, {found['documentos_avaliaveis']} documentos.", ""]
    page += _table(("Status", "", "Documentos", "Parcela"), ((s, MARKS.get(s, "⚠️"), k, _percent(k / n)) for s, k in status.items()))
    without = (status["assinado"] - fall["documentos_resgatados"]) / n
    page += ["## Fallback", "", f"{fall['documentos']} documentos, {fall['paginas']} páginas; {fall['documentos_resgatados']} resgatados. Assinados sem ele: {_percent(without)}.", ""]
    page += ["## Tempo", "", *_table(("Medida", "Valor"), found["tempo"].items())]
    page += ["## Formatos", "", *_table(("Formato", "Documentos", "Assinados", "Sem assinatura", "Alerta"), ((k, *v.values()) for k, v in found["por_formato"].items()))]
    page += ["## Mais lentos", "", *_table(("Arquivo", "ms", "Páginas", "Status"), map(tuple, rollup.slowest(records).collect()))]
    page += ["## Erros", "", *_table(("Tipo", "Documentos"), found["erros_por_tipo"].items())]
    page += _table(("Arquivo", "Tipo", "Erro", "Tentativas"), map(tuple, rollup.first_errors(records).collect()))
    return page


def listing(records: DataFrame) -> Iterator[str]:
    """The full listing, a line per record in path order; rows come partition by partition, never all at once."""
    rows = ordered(records.withColumn("nota", rollup.remark()))
    header = ("Nº", "", "Arquivo", "Formato", "Assinaturas", "Nível 0", "Nível 1", "Páginas", "ms", "Nota")
    yield from _table(header, [])[:2]
    for k, r in enumerate(rows.toLocalIterator(), 1):
        yield _table(header, [(k, MARKS.get(r.status, "⚠️"), r.arquivo, r.formato, r.assinaturas_total, r.nivel0_total, r.nivel1_total, r.paginas, r.tempo_ms, r.nota)])[2]


def validation(records: DataFrame, hashes: DataFrame, index: DataFrame, labels: DataFrame) -> dict[str, Any]:
    """The audit as one document."""
    strata = audit.by_stratum(records, index, labels)
    head, cover, part = audit.sample_header(index, labels).first(), audit.coverage(records, hashes, labels).first(), audit.represented(strata, records).first()
    m = audit.matrices(strata).first()
    names = {"vp": "verdadeiro_positivo", "fp": "falso_positivo", "vn": "verdadeiro_negativo", "fn": "falso_negativo"}
    cells = lambda r, p="": {names[c]: round(float(r[p + c]), 1) for c in audit.CELLS}
    rows = strata.withColumn("ordem", stratum_order("estrato")).orderBy("ordem", "estrato").collect()
    rates = {r.indicador: {"valor": r.valor, "ic": None if r.baixo is None else [r.baixo, r.alto], "n": r.n} for r in audit.rates(audit.matrices(strata)).collect()}
    return {
        "amostra": {**{k: head[k] for k in ("sorteados", "conteudos_distintos", "rotulados", "duvidas", "pendentes")}, "fracao_duvida": round(head.fracao_duvida, 4)},
        "lote": {
            "documentos_avaliaveis": cover.documentos_avaliaveis, "documentos": records.count(), "documentos_com_rotulo_direto": cover.com_rotulo_direto,
            "conteudos_distintos_rotulados": labels.filter("tem_assinatura is not null").select("sha256").distinct().count(),
            "populacao_representada": part.populacao_representada, "fracao_representada": round(part.fracao_representada, 4),
        },
        "matriz_estimada": cells(m, "est_"),
        "matriz_amostra": cells(m),
        "taxas": rates,
        "por_estrato": {
            r.estrato: {
                "populacao": r.populacao, "sorteados": r.sorteados, "rotulados": r.rotulados, "duvidas": r.duvidas, "fator": None if r.fator is None else round(r.fator, 2),
                "erros_na_amostra": r.fp + r.fn, "erros_estimados": round(r.erros_estimados, 1), "matriz": cells(r),
            }
            for r in rows
        },
    }


def validation_page(found: dict[str, Any]) -> list[str]:
    sample, lot = found["amostra"], found["lote"]
    page = ["# Validação", "", f"{sample['rotulados']} de {sample['sorteados']} documentos sorteados têm rótulo; faltam {sample['pendentes']} conteúdos.", ""]
    if not sample["rotulados"]:
        return [*page, "Ainda não há rótulos."]
    if sample["fracao_duvida"] > V.MAX_DOUBT:
        page += [f"> Dúvida em {_percent(sample['fracao_duvida'])} dos rótulos: as taxas não são confiáveis.", ""]
    if lot["fracao_representada"] < 1:
        page += [f"> As taxas descrevem {_percent(lot['fracao_representada'])} do lote; há estratos sem rótulo.", ""]
    page += _table(("Taxa", "Valor", "IC 95 %", "n"), ((k, _percent(r["valor"]), "—" if not r["ic"] else f"{_percent(r['ic'][0])} a {_percent(r['ic'][1])}", r["n"]) for k, r in found["taxas"].items()))
    total = sum(s["erros_estimados"] for s in found["por_estrato"].values()) or 1.0
    page += _table(("Estrato", "População", "Sorteados", "Rotulados", "Fator", "Erros estimados", "Parcela"), ((k, s["populacao"], s["sorteados"], s["rotulados"], s["fator"], s["erros_estimados"], _percent(s["erros_estimados"] / total)) for k, s in found["por_estrato"].items()))
    return page


def form_page(rows: DataFrame, records: DataFrame) -> list[str]:
    by = forms.verdicts_by_group(rows, records)
    f = forms.field_counts(rows).first()
    page = ["# Campos de assinatura", "", *_table(("Grupo", "No lote", "Auditados", *V.FORM_VERDICTS), (tuple(r) for r in by.orderBy(F.desc("grupo")).collect()))]
    if p := forms.projection(by).first():
        page += [f"{p.falsos} de {p.auditados} documentos sem outra evidência não têm assinatura; no lote são cerca de {p.projetados}.", ""]
    return [*page, f"{f.assinados} de {f.campos} campos estão assinados, {f.sem_nome} deles sem nome declarado; {f.com_nome_recuperado} nomes vieram do certificado."]


def card_documents(records: DataFrame, index: DataFrame, labels: DataFrame) -> list[dict[str, Any]]:
    """Cards with their evidence, errors first: at most one per content of the sample."""
    cards = triage.cards(records, index, labels)
    rows = cards.join(triage.details(records, cards), "arquivo", "left").orderBy("rank", "estrato", "id")
    return [{"id": r.id, "classe": r.classe, "estrato": r.estrato, "arquivo": r.arquivo, "copias": r.copias, "detalhes": [list(p) for p in r.detalhes or []]} for r in rows.collect()]


def write(folder: str, name: str, page: Iterable[str], document: Any = None) -> None:
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name + ".md"), "w", encoding="utf-8") as f:
        f.writelines(line + "\n" for line in page)
    if document is not None:
        with open(os.path.join(folder, name + ".json"), "w", encoding="utf-8") as f:
            json.dump(document, f, ensure_ascii=False, indent=2)


def relative_link(target: str, base: str) -> str:
    """A link from a page in ``base`` to ``target``, escaped; an absolute path where they share no root."""
    try:
        return urllib.parse.quote(os.path.relpath(target, base).replace(os.sep, "/"))
    except ValueError:
        return urllib.parse.quote(target.replace(os.sep, "/"))


def cards_page(cards: list[dict[str, Any]], root: str, folder: str) -> list[str]:
    """A static page of the cards: a filter by class, a cause to choose per card, and an export of the choices.

    The cards come as JSON inside the page and are shown as text, so nothing in them is markup.
    """
    rows = [c | {"link": relative_link(os.path.join(root, c["arquivo"]), folder)} for c in cards]
    data = json.dumps(rows, ensure_ascii=False).replace("<", "\\u003c")
    return f"""<!doctype html>
<html lang="pt-BR"><meta charset="utf-8"><title>Erros da amostra</title>
<h1>Erros da amostra</h1>
<p><select id="classe"><option value="">todas as classes</option></select> <button id="exportar">Exportar triagem</button></p>
<main></main>
<script type="application/json" id="dados">{data}</script>
<script>
const dados = JSON.parse(document.getElementById("dados").textContent), causas = {{}};
const filtro = document.getElementById("classe"), area = document.querySelector("main");
const nova = (nome, texto) => Object.assign(document.createElement(nome), {{textContent: texto ?? ""}});
for (const c of new Set(dados.map(d => d.classe))) filtro.append(nova("option", c));
function mostrar() {{
  area.replaceChildren(...dados.filter(d => !filtro.value || d.classe === filtro.value).map(d => {{
    const caixa = nova("section"), lista = nova("dl"), causa = nova("select"), titulo = nova("h2", `${{d.classe}} · ${{d.estrato}}`);
    const elo = Object.assign(nova("a", d.arquivo), {{href: d.link}});
    for (const [nome, valor] of d.detalhes) lista.append(nova("dt", nome), nova("dd", valor));
    for (const c of ["", "modelo", "rotulagem", "documento", "rever"]) causa.append(nova("option", c));
    causa.value = causas[d.id] ?? "";
    causa.onchange = () => causas[d.id] = causa.value;
    caixa.append(titulo, elo, lista, causa);
    return caixa;
  }}));
}}
filtro.onchange = mostrar;
document.getElementById("exportar").onclick = () => {{
  const linhas = dados.filter(d => causas[d.id]).map(d => ({{id: d.id, classe: d.classe, estrato: d.estrato, causa: causas[d.id]}}));
  const elo = Object.assign(nova("a"), {{href: URL.createObjectURL(new Blob([JSON.stringify(linhas, null, 2)])), download: "triagem.json"}});
  elo.click();
}};
mostrar();
</script></html>""".splitlines()


def run_report(rows: DataFrame) -> tuple[list[str], dict[str, Any]]:
    """A test run's page and document: verdict per document and the summary with the priced comparison."""
    total = {k: (str(v) if k.startswith("custo") else v) for k, v in documents.run_summary(rows).first().asDict().items()}
    lines = rows.select("arquivo", documents.run_verdict().alias("veredito"), "nivel0_total", "nivel1_total", "paginas", "tempo_ms").orderBy(F.lower("arquivo"), "arquivo").collect()
    page = ["# Resultados", "", *_table(("Arquivo", "Veredito", "Nível 0", "Nível 1", "Páginas", "ms"), map(tuple, lines)), "## Resumo", "", *_table(("Medida", "Valor"), total.items())]
    return page, {"resumo": total, "documentos": [r.asDict() for r in lines]}
