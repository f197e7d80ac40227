"""Schemas of the persisted relations and the defaults of fields that older files lack."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RECORD = """arquivo string, formato string, tipo string, tamanho_bytes bigint, status string,
assinaturas_total int, nivel0_total int, nivel1_total int, fontes array<string>, signatarios array<string>,
paginas int, paginas_em_branco int, paginas_analisadas_nivel1 int, paginas_ladrilhadas int, paginas_limitadas boolean,
tempo_ms double, tempo_inferencia_ms double, nivel1_erro string, observacao string, erro string, erro_tipo string,
retentavel boolean, tentativas int, processado_em string"""
HASH = "arquivo string, sha256 string"
SAMPLE = "id string, sha256 string, arquivo string, estrato string, status string, paginas int"
LABEL = "sha256 string, tem_assinatura boolean"
FORM_FIELD = """struct<pagina: int, nome: string, tem_valor: boolean, tem_byterange: boolean, bytes_pkcs7: int, subfilter: string,
nome_declarado: string, data: string, motivo: string, nomes_no_certificado: array<string>>"""
TRIAGE = "id string, classe string, estrato string, causa string"

_ZERO = ("assinaturas_total", "nivel0_total", "nivel1_total", "paginas", "paginas_em_branco", "paginas_analisadas_nivel1", "paginas_ladrilhadas", "tamanho_bytes", "tempo_ms", "tempo_inferencia_ms")


def with_defaults(records: DataFrame) -> DataFrame:
    """Fields newer than a file get the value that their absence means."""
    new = {c: F.coalesce(c, F.lit(0)) for c in _ZERO if c in records.columns}
    new |= {"tentativas": F.coalesce("tentativas", F.lit(1)), "paginas_limitadas": F.coalesce("paginas_limitadas", F.lit(False)), "retentavel": F.coalesce("retentavel", F.lit(True))}
    new |= {c: F.coalesce(c, F.array().cast("array<string>")) for c in ("fontes", "signatarios") if c in records.columns}
    return records.withColumns({k: v for k, v in new.items() if k in records.columns})
