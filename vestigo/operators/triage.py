"""Error cards: one per labelled content of the sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocabulary as V
from ..functions.classify import confusion_class


def cards(records: DataFrame, index: DataFrame, labels: DataFrame) -> DataFrame:
    """id, sha256, classe, estrato, arquivo, copias, rank: errors first.

    The first item in path order whose record is still there stands for its content, else the first item.
    """
    here = records.select("arquivo", F.lit(True).alias("here"))
    items = index.join(here, "arquivo", "left")
    key = F.struct(F.coalesce(~F.col("here"), F.lit(True)).alias("gone"), "estrato", "arquivo")
    one = items.groupBy("sha256").agg(F.min_by(F.struct("id", "estrato", "arquivo", "status"), key).alias("item"), F.count("*").alias("copias"))
    rows = one.join(labels.select("sha256", "tem_assinatura"), "sha256")
    kind = confusion_class(F.col("item.status") == "assinado", F.col("tem_assinatura"))
    rows = rows.select("item.id", "sha256", kind.alias("classe"), "item.estrato", "item.arquivo", "copias")
    return rows.withColumn("rank", F.array_position(F.array(*map(F.lit, V.CARD_ORDER)), F.col("classe")).cast("int"))


def details(records: DataFrame, cards_: DataFrame) -> DataFrame:
    """arquivo and twelve (label, value) pairs of evidence for its card."""
    yes = lambda c: F.when(c, "sim").otherwise("não")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("0"))
    dash = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("—"))
    rows = cards_.select("arquivo", "copias").join(records, "arquivo", "left")
    has = lambda s: F.coalesce(F.array_contains("fontes", s), F.lit(False))
    names = F.array_join(F.coalesce("signatarios", F.array().cast("array<string>")), "; ")
    pairs = {
        "Arquivo": F.col("arquivo"),
        "Formato": F.concat(dash("formato"), F.lit(" ("), dash("tipo"), F.lit(") · "), F.col("copias").cast("string"), F.lit(" cópia(s) desse conteúdo no lote")),
        "Assinaturas contadas": text("assinaturas_total"),
        "Nível 0 — AcroForm `/Sig`": F.concat(yes(has("pdf_embedded")), F.lit(" · "), text("nivel0_total"), F.lit(" sinal(is) no Nível 0 (AcroForm + carimbo)")),
        "Nível 0 — carimbo digital no texto": yes(has("digital")),
        "Nível 1 — detecções visuais": text("nivel1_total"),
        "Signatários lidos": F.when(names == "", "—").otherwise(names),
        "Páginas": F.concat(text("paginas"), F.lit(" no documento · "), text("paginas_analisadas_nivel1"), F.lit(" analisadas no Nível 1 · "), text("paginas_em_branco"), F.lit(" em branco (não vão ao Nível 1)")),
        "Fallback 3×3": F.concat(text("paginas_ladrilhadas"), F.lit(" página(s) ladrilhada(s) — 9 inferências por página")),
        "Truncado em `--max-paginas`": yes(F.coalesce("paginas_limitadas", F.lit(False))),
        "Erro do Nível 1": dash("nivel1_erro"),
        "Observação": dash("observacao"),
    }
    return rows.select("arquivo", F.array(*[F.struct(F.lit(k).alias("rotulo"), v.alias("valor")) for k, v in pairs.items()]).alias("detalhes"))


def review_ids(triage: DataFrame) -> DataFrame:
    return triage.filter(F.col("causa").isin(*V.REVIEW_CAUSES) & (F.col("id") != "")).select("id")
