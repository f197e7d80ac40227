"""Form-field audit: verdict by evidence group and what it means for the lot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocabulary as V
from ..functions.classify import field_signed, form_group, form_verdict


def audited(sample: DataFrame, fields: DataFrame) -> DataFrame:
    """Sampled documents with ``campos`` and ``veredito``; a document that couldn't be read has a NULL ``campos`` and ``erro``."""
    rows = sample.join(fields, "arquivo", "left")
    return rows.withColumn("veredito", F.when(F.col("erro").isNotNull(), "erro").otherwise(form_verdict("campos")))


def verdicts_by_group(rows: DataFrame, records: DataFrame) -> DataFrame:
    """grupo, populacao, auditados and one column per verdict."""
    counts = rows.groupBy("grupo").agg(F.count("*").alias("auditados"), *[F.count_if(F.col("veredito") == v).alias(v) for v in V.FORM_VERDICTS])
    sizes = records.withColumn("grupo", form_group()).filter("grupo is not null").groupBy("grupo").agg(F.count("*").alias("populacao"))
    return counts.join(sizes, "grupo", "left").select("grupo", F.coalesce("populacao", F.lit(0)).alias("populacao"), "auditados", *V.FORM_VERDICTS)


def projection(by_group: DataFrame) -> DataFrame:
    """One row: false positives among documents whose only evidence is a form field, carried to the lot."""
    one = by_group.filter(F.col("grupo") == V.FORM_GROUPS[0])
    false = F.col("campo_vazio") + F.col("sem_campo")
    return one.select("populacao", "auditados", false.alias("falsos"), F.bround(F.col("populacao") * false / F.col("auditados"), 0).cast("bigint").alias("projetados"))


def field_counts(rows: DataFrame) -> DataFrame:
    """One row: fields read, signed ones, signed ones without a declared name, names found in certificates."""
    f = rows.select(F.explode("campos").alias("f")).withColumn("signed", field_signed(F.col("f")))
    nameless = F.coalesce(F.col("f.nome_declarado"), F.lit("")) == ""
    return f.agg(
        F.count("*").alias("campos"),
        F.count_if("signed").alias("assinados"),
        F.count_if(F.col("signed") & nameless).alias("sem_nome"),
        F.count_if(F.col("signed") & (F.size("f.nomes_no_certificado") > 0)).alias("com_nome_recuperado"),
    )


def only_signed(hits: DataFrame, live: DataFrame) -> DataFrame:
    """Form-field hits on (doc, page, campo) with a live field; unnamed fields of a page match one another."""
    same = (hits["doc"] == live["doc"]) & (hits["page"] == live["page"]) & hits["campo"].eqNullSafe(live["campo"])
    return hits.join(live, same, "left_semi")
