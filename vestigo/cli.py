"""Command line: run a lot, sum it up, sample, label, audit, form audit, error cards."""

from __future__ import annotations

import argparse
import importlib
import json
import os
from dataclasses import replace

from pyspark.sql import SparkSession

from . import schemas
from . import vocabulary as V
from .operators import batch, jobs, sampling
from .operators.detect import BATCH
from .plans import report
from .sources import files as S
from .sources import records as R

COMMANDS = ("processar", "resumo", "pendentes", "hashes", "amostrar", "rotular", "avaliar", "erros", "acroform")


def _named(place: str | None):
    """A function given as ``module:name``."""
    return getattr(importlib.import_module(place.partition(":")[0]), place.partition(":")[2]) if place else None


def _arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="vestigo", description=__doc__)
    p.add_argument("command", choices=COMMANDS)
    for name, text in (("registros", "checkpoint lines"), ("hashes", "content hash lines"), ("indice", "sample index lines"), ("rotulos", "label lines"), ("pastas", "folder of label folders"), ("raiz", "document folder")):
        p.add_argument(f"--{name}", help=text)
    p.add_argument("--saida", default=".")
    p.add_argument("--negativos", type=int, default=200)
    p.add_argument("--positivos", type=int, default=200)
    p.add_argument("--n", type=int, default=25, help="documents per form group")
    p.add_argument("--semente", type=int, default=42)
    p.add_argument("--conf", type=float, default=BATCH.confidence)
    p.add_argument("--iou", type=float, default=BATCH.iou)
    p.add_argument("--densidade-minima", type=float, default=BATCH.min_ink)
    p.add_argument("--max-paginas", type=int, default=30, help="0 for no limit")
    p.add_argument("--tentativas", type=int, default=2)
    p.add_argument("--fatias", type=int, default=1, help="parts of the lot that are appended one by one")
    for flag in ("escalonar", "sem-nivel1", "sem-fallback", "reprocessar"):
        p.add_argument(f"--{flag}", action="store_true")
    p.add_argument("--detector", help="module:function, the page detector")
    p.add_argument("--desenho", help="module:function, bytes and extension to gray pages")
    p.add_argument("--sha256", help="content to label")
    p.add_argument("--rotulo", choices=tuple(V.LABEL_WORDS))
    return p


def _labels(spark: SparkSession, a: argparse.Namespace, index):
    """Persisted labels, replaced by those of the folders where these are given."""
    from .operators.audit import folder_labels, resolve_labels

    labels = R.read_labels(spark, a.rotulos)
    if not a.pastas:
        return labels
    return resolve_labels(labels, folder_labels(S.label_files(spark, a.pastas), index.select("id", "sha256")))


def main(argv: list[str] | None = None) -> int:
    a = _arguments().parse_args(argv)
    spark = SparkSession.builder.appName("vestigo").getOrCreate()
    os.makedirs(a.saida, exist_ok=True)
    if a.command == "processar":
        options = replace(BATCH, level1=not a.sem_nivel1, cascade=a.escalonar, tiles=not a.sem_fallback, max_pages=a.max_paginas or None, confidence=a.conf, iou=a.iou, min_ink=a.densidade_minima)
        backends = batch.Backends(_named(a.desenho), _named(a.detector))
        with jobs.run_lock(os.path.join(a.saida, ".lock")):
            found = batch.run_batch(spark, a.raiz, a.registros, backends, options, a.tentativas, a.reprocessar, a.fatias)
        with open(os.path.join(a.saida, "execucao.json"), "w", encoding="utf-8") as f:
            json.dump(found, f, ensure_ascii=False, indent=2)
        return 0
    if a.command == "rotular":
        R.append_label(spark, a.rotulos, a.sha256, V.LABEL_WORDS[a.rotulo])
        return 0
    records = R.read_records(spark, a.registros)
    if a.command == "resumo":
        found = report.summary(records)
        report.write(a.saida, "RESUMO", report.summary_page(records, found), found)
        report.write(a.saida, "COMPLETO", report.listing(records))
    elif a.command == "amostrar":
        index = sampling.draw(records, R.read_hashes(spark, a.hashes), a.negativos, a.positivos, a.semente)
        sampling.write_index(index, os.path.join(a.saida, "indice"))
    elif a.command == "hashes":
        files = S.list_documents(spark, a.raiz).join(sampling.evaluable(records).select("arquivo"), "arquivo", "left_semi")
        known = R.read_hashes(spark, a.hashes) if batch._exists(spark, a.hashes) else spark.createDataFrame([], schemas.HASH)
        S.append_hashes(S.content_hashes(S.read_contents(spark, a.raiz, S.unhashed(files, known))), a.hashes)
    elif a.command == "pendentes":
        lines = R.parse(R.numbered_lines(spark, a.registros), schemas.RECORD, "arquivo")
        R.pending(S.list_documents(spark, a.raiz), R.completed(lines)).select("arquivo").write.mode("overwrite").json(os.path.join(a.saida, "pendentes"))
    elif a.command == "acroform":
        hashes = R.read_hashes(spark, a.hashes) if a.hashes else spark.createDataFrame([], schemas.HASH)
        rows = batch.materialise(batch.audit_forms(spark, a.raiz, records, hashes, a.n, a.semente), "acroform")
        report.write(a.saida, "ACROFORM", report.form_page(rows, records))
        rows.write.option("ignoreNullFields", "false").mode("overwrite").json(os.path.join(a.saida, "ACROFORM.jsonl"))
    else:
        index = R.read_index(spark, a.indice)
        labels = _labels(spark, a, index)
        if a.command == "avaliar":
            found = report.validation(records, R.read_hashes(spark, a.hashes), index, labels)
            report.write(a.saida, "VALIDACAO", report.validation_page(found), found)
        else:
            cards = report.card_documents(records, index, labels)
            with open(os.path.join(a.saida, "ERROS.json"), "w", encoding="utf-8") as f:
                json.dump(cards, f, ensure_ascii=False, indent=2)
            with open(os.path.join(a.saida, "ERROS.html"), "w", encoding="utf-8") as f:
                f.writelines(line + "\n" for line in report.cards_page(cards, a.raiz or "", a.saida))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
