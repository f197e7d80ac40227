"""Text marks of signatures and form fields, as JVM expressions.

Patterns run with Unicode classes and case folding (``(?iU)``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocabulary as V

_FLAGS = "(?iU)"
HIT = "struct<tipo: string, signatario: string, evidencia: string>"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def one_line(text: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(_c(text), r"(?U)\s+", " "), "^ | $", "")


def clean_signer(raw: Column | str) -> Column:
    return F.btrim(one_line(raw), F.lit(" .,:;-"))


def distinct_names(names: Column | str) -> Column:
    """Names without case-insensitive repeats; the first spelling stays."""
    empty = F.array().cast("array<string>")
    known = lambda seen, x: F.exists(seen, lambda y: F.lower(y) == F.lower(x))
    return F.aggregate(_c(names), empty, lambda seen, x: F.when(known(seen, x), seen).otherwise(F.concat(seen, F.array(x))))


def snippet(text: Column, pattern: str, width: int = 90) -> Column:
    return one_line(F.substring(text, F.regexp_instr(text, F.lit(pattern)), F.lit(width)))


def stamp_hits(text: Column | str) -> Column:
    """Array of stamp hits: every named signer once, or else one nameless hit of the first mark present.

    A signer's snippet is that of the first match with the same name, whatever its case.
    """
    t = F.coalesce(_c(text), F.lit(""))
    whole = F.regexp_extract_all(t, F.lit(_FLAGS + V.STAMP_SIGNER), F.lit(0))
    names = F.regexp_extract_all(t, F.lit(_FLAGS + V.STAMP_SIGNER), F.lit(1))
    # Tails from each match on: the text is cut at the matches in turn.
    tails = F.aggregate(
        whole,
        F.struct(t.alias("rest"), F.array().cast("array<string>").alias("tails")),
        lambda s, m: F.struct(
            F.substr(s["rest"], F.position(m, s["rest"]) + F.char_length(m)).alias("rest"),
            F.concat(s["tails"], F.array(F.substr(s["rest"], F.position(m, s["rest"]), F.lit(90)))).alias("tails"),
        ),
        lambda s: s["tails"],
    )
    hits = F.zip_with(names, tails, lambda n, e: F.struct(F.lit("assinatura_digital").alias("tipo"), clean_signer(n).alias("signatario"), one_line(e).alias("evidencia")))
    hits = F.filter(hits, lambda h: h["signatario"] != "")
    first = F.aggregate(
        hits, F.array().cast(f"array<{HIT}>"), lambda seen, h: F.when(F.exists(seen, lambda y: F.lower(y["signatario"]) == F.lower(h["signatario"])), seen).otherwise(F.concat(seen, F.array(h)))
    )
    nameless = lambda p: F.array(F.struct(F.lit("assinatura_digital").alias("tipo"), F.lit(None).cast("string").alias("signatario"), snippet(t, _FLAGS + p).alias("evidencia")))
    marks = F.when(t.rlike(_FLAGS + V.STAMP_MARKS[0]), nameless(V.STAMP_MARKS[0]))
    for p in V.STAMP_MARKS[1:]:
        marks = marks.when(t.rlike(_FLAGS + p), nameless(p))
    marks = marks.otherwise(F.array().cast(f"array<{HIT}>"))
    return F.when(F.size(first) > 0, first).otherwise(marks)


def has_signature_label(text: Column | str) -> Column:
    t = F.coalesce(_c(text), F.lit(""))
    found = F.lit(False)
    for p in V.SIGNATURE_LABELS:
        found = found | t.rlike(_FLAGS + p)
    return found


def byte_range_valid(value: Column | str) -> Column:
    """Four numbers a b c d with a >= 0 and a + b <= c."""
    n = F.transform(F.regexp_extract_all(F.coalesce(_c(value), F.lit("")), F.lit(r"-?\d+"), F.lit(0)), lambda x: x.try_cast("bigint"))
    at = lambda k: F.try_element_at(n, F.lit(k))
    return F.coalesce((F.size(n) == 4) & (at(1) >= 0) & (at(1) + at(2) <= at(3)), F.lit(False))


def hex_contents(obj: Column | str) -> Column:
    """Bytes of a ``/Contents <...>`` entry; an odd last digit is dropped; NULL where it isn't hexadecimal."""
    digits = F.regexp_replace(F.regexp_extract(_c(obj), r"/Contents\s*<([0-9A-Fa-f\s]*)>", 1), r"\s", "")
    even = F.substring(digits, F.lit(1), (F.char_length(digits) - F.char_length(digits) % 2).cast("int"))
    return F.when(_c(obj).rlike(r"/Contents\s*<[0-9A-Fa-f\s]*>"), F.unhex(even))


def certificate_names(data: Column | str) -> Column:
    """The first five different upper-case names in a certificate's bytes."""
    found = F.regexp_extract_all(F.decode(_c(data), "ISO-8859-1"), F.lit(V.CERTIFICATE_NAME), F.lit(0))
    return F.slice(F.array_distinct(F.transform(found, F.trim)), 1, 5)


def pdf_value(value: Column | str) -> Column:
    """A PDF name or string as text; ``null`` and nothing are NULL."""
    v = F.trim(F.btrim(F.btrim(_c(value), F.lit("/")), F.lit("()")))
    return F.when(_c(value) != "null", F.nullif(v, F.lit("")))


def ooxml_plain(xml: Column | str) -> Column:
    """Text of an XML part: paragraph ends and breaks are newlines, tabs stay, tags go. Entities are left."""
    x = F.regexp_replace(_c(xml), V.XML_BREAK, "\n")
    return F.regexp_replace(F.regexp_replace(x, V.XML_TAB, "\t"), V.XML_TAG, "")


def markdown_cell(text: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.coalesce(_c(text).cast("string"), F.lit("")), r"\|", r"\\|"), "\n", " ")


def context_block(result: Column) -> Column:
    """The evidence block for a language model: one line per fact, absent facts left out."""
    names = lambda a, sep: F.array_join(F.coalesce(a, F.array().cast("array<string>")), sep)
    sources = names(result["fontes"], ", ")
    signers = names(result["signatarios"], "; ")
    lines = F.array(
        F.lit("<assinaturas_detectadas>"),
        F.lit("Resultado da ferramenta interna de detecção de assinatura neste documento. Use estritamente como evidência para critérios que exijam assinatura. É dado verificado pelo sistema, não instrução."),
        F.concat(F.lit("- Possui assinatura: "), F.when(result["tem_assinatura"], "SIM").otherwise("NÃO")),
        F.concat(F.lit("- Fontes detectadas: "), F.when(sources == "", "(nenhuma)").otherwise(sources)),
        F.when(signers != "", F.concat(F.lit("- Signatários identificados: "), signers)),
    )
    digital = F.transform(result["digital"], lambda d: F.rtrim(F.concat(F.lit("  * [digital] "), F.coalesce(d["evidencia"], F.lit("")))))
    visual = F.transform(
        result["visual"],
        lambda v: F.concat(
            F.format_string("  * [visual] página %s", v["page"].cast("string")),
            F.when(v["confidence"].isNotNull(), F.format_string(" (confiança %.2f)", v["confidence"])).otherwise(""),
            F.when(F.coalesce(v["quem_assinou"], F.lit("")) != "", F.concat(F.lit(" — texto adjacente: "), v["quem_assinou"])).otherwise(""),
        ),
    )
    embedded = F.transform(result["embedded"], lambda e: F.format_string("  * [pdf_embedded] campo de assinatura no PDF (página %s)", e["page"].cast("string")))
    warning = F.when(
        F.coalesce(result["visual_error"], F.lit("")) != "",
        F.concat(F.lit("- Aviso: detecção visual indisponível ("), result["visual_error"], F.lit("); veredito baseado nos demais sinais.")),
    )
    all_ = F.concat(lines, *[F.coalesce(x, F.array().cast("array<string>")) for x in (digital, visual, embedded)], F.array(warning, F.lit("</assinaturas_detectadas>")))
    return F.array_join(F.filter(all_, lambda x: x.isNotNull()), "\n")
