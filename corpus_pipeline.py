"""From raw documents to token ids: quality rules, line dedup, near dedup, decontamination, encoding.

Every stage takes (spark, docs, sf_dir), works on all that the one before kept,
and returns a DataFrame; all but the last return the columns of ``documents``, in
their order and with any further column untouched, whatever its name.

Defined results of every stage: a null text counts as an empty one; a null doc_id
is an id like others where documents are compared (the smallest); a row that
stands twice is judged twice alike; texts may be of any length; an empty table
stays empty. Where a stage departs from that, its docstring says so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vestigo.llm import bpe, decontaminate, line_dedup, near_dedup, quality
from vestigo.llm.shared import free_names, materialise

VOCABULARY = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that any rule rejects go; rules run in the order that a sample suggests.

    A null or empty text has too few words and goes.
    """
    rules = quality.plan_order(docs, quality.BASE_RULES + quality.RULES)
    (verdict,) = free_names(docs, "kept")
    return quality.cascade(docs, rules, kept=verdict).filter(verdict).drop(verdict)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in three documents or more stay in the last of them only.

    All rows stay; a row that loses no line keeps its text as it was, null included. ``n_chars``
    follows the text. Rows of one doc_id are one document, so its copies don't take lines from each other.
    """
    return line_dedup.without_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8, the smallest id stays.

    Rows of one doc_id stay or go together; rows without one stand for the smallest id and stay. A text
    without words is linked with nothing and stays.
    """
    return near_dedup.one_per_group(docs, size=5, percent=80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 80 % of a benchmark item's five-word shingles go.

    Items and documents of fewer than five words match nothing.
    """
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and the ids of each text; a null or empty text has none."""
    import public_tokenizers

    rows = bpe.encode(docs, public_tokenizers.path(VOCABULARY), ("n_tokens", "ids"))
    return rows.select("doc_id", "lang", "source", "n_tokens", "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", repeated_lines),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("bpe_encoding", token_ids),
]

#: The near-duplicate and encoding stages are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
