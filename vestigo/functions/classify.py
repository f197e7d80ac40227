"""Decision lists over record fields, as single CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocabulary as V


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def suffix(name: Column | str) -> Column:
    """Lower-cased last extension of a path's file name; a leading dot alone is no extension."""
    file = F.regexp_extract(F.lower(_c(name)), r"([^/\\]*)$", 1)
    return F.regexp_extract(file, r"[^.].*?(\.[^.]+)$", 1)


def file_type(extension: Column | str) -> Column:
    e = F.lower(_c(extension))
    return F.when(e.isin(*V.PDF), "pdf").when(e.isin(*V.IMAGES), "imagem").when(e.isin(*V.OOXML), "ooxml").when(e.isin(*V.ZIP), "zip").otherwise("nao_suportado")


def detection_status(total: Column | str, level1_error: Column | str) -> Column:
    """A failed level 1 leaves an unsigned document undecided; a disabled one doesn't."""
    failed = F.coalesce(_c(level1_error), F.lit("")) != ""
    return F.when(_c(total) > 0, "assinado").when(failed, "indeterminado").otherwise("sem_assinatura")


def stratum() -> Column:
    """Risk stratum of a record; an empty string where it isn't auditable."""
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    negative = (
        F.when(F.coalesce("paginas_limitadas", F.lit(False)), "neg_paginas_limitadas")
        .when(z("paginas_analisadas_nivel1") == 0, "neg_sem_pagina_analisada")
        .when(F.col("tipo") == "ooxml", "neg_ooxml")
        .when(F.col("tipo") == "imagem", "neg_imagem")
        .when(z("paginas") <= 1, "neg_pdf_1pag")
        .when(z("paginas") == 2, "neg_pdf_2pag")
        .otherwise("neg_pdf_3pag_ou_mais")
    )
    positive = (
        F.when(z("nivel0_total") > 0, "pos_nivel0")
        .when(z("paginas_ladrilhadas") > 0, "pos_resgatado_fallback")
        .when(z("nivel1_total") == 1, "pos_nivel1_uma_deteccao")
        .otherwise("pos_nivel1_varias")
    )
    return F.when(F.col("status") == "sem_assinatura", negative).when(F.col("status") == "assinado", positive).otherwise("")


def stratum_order(name: Column | str) -> Column:
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, V.STRATA)), _c(name)), F.lit(0)), F.lit(len(V.STRATA) + 1))


def form_group(sources: Column | str = "fontes") -> Column:
    s = _c(sources)
    return F.when(F.array_contains(s, "pdf_embedded"), F.when(F.size(F.array_distinct(s)) == 1, V.FORM_GROUPS[0]).otherwise(V.FORM_GROUPS[1]))


def field_signed(f: Column) -> Column:
    return f["tem_valor"] & f["tem_byterange"] & (f["bytes_pkcs7"] >= V.MIN_PKCS7_BYTES)


def form_verdict(fields: Column | str) -> Column:
    f = _c(fields)
    return (
        F.when(F.coalesce(F.size(f), F.lit(0)) <= 0, "sem_campo")
        .when(F.exists(f, field_signed), "assinado")
        .when(F.exists(f, lambda x: x["tem_valor"]), "incompleto")
        .otherwise("campo_vazio")
    )


def live_signature(has_value: Column | str, has_range: Column | str, contents_bytes: Column | str) -> Column:
    """Level 0 counts a widget with a value, a byte range and any contents; the signer's name never matters."""
    return _c(has_value) & _c(has_range) & (_c(contents_bytes) > 0)


def confusion_class(verdict: Column, label: Column) -> Column:
    return F.when(label.isNull(), "duvida").when(verdict, F.when(label, "vp").otherwise("fp")).otherwise(F.when(label, "fn").otherwise("vn"))


def back_in_scope() -> Column:
    """A record of an unsupported format that is supported by now."""
    return (F.col("status") == "nao_suportado") & F.lower(F.col("formato")).isin(*V.PDF, *V.IMAGES, *V.OOXML, *V.ZIP)
