"""Exact length histogram of encoded documents and the answers it gives.

Documents are encoded where they lie; each Arrow batch leaves as a small
histogram (length, documents), so the only shuffle carries one row per distinct
length and task. Suffix sums over the histogram, taken in two levels so that no
single task holds all lengths, then answer totals, quantiles and truncated
totals for every context limit without touching a document again.

Defined results: a null or empty text has length 0; a text may be of any length
and hold runs of white space of any length; null ids and repeated rows
count like any other row; other columns are ignored; an empty table gives an
empty histogram, for which totals are 0 and quantiles null.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import map_arrow, materialise

#: A text is encoded in pieces of about this many characters, cut only where a token must begin.
PIECE_CHARS = 1 << 18
#: A run of white space from this length on is a piece of its own: the pattern's engine would overflow on millions.
RUN_CHARS = 1 << 14
#: White space as the pattern's engine knows it.
_BLANK = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_RUN = re.compile(f"{_BLANK}{{{RUN_CHARS},}}")
_CUT = re.compile(r"(?<=\S) (?=\S)")
_encodings: dict[tuple[str, str], object] = {}


def _encoding(path: str, pattern: str):
    if (path, pattern) not in _encodings:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[path, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path, pattern]


def pieces(text: str, size: int = PIECE_CHARS, run: re.Pattern = _RUN) -> Iterator[str]:
    """The text in parts whose tokens together are the text's tokens.

    A space between two characters that aren't white space always opens a token,
    whatever precedes it, so a cut before it changes nothing. A run of white space
    that more text follows is one split of the pattern up to its last character,
    which opens the next split; a run at the text's end is one split. So a long run
    is a part of its own, without its last character where text follows.
    """
    at = 0
    for found in run.finditer(text) if len(text) >= RUN_CHARS or run is not _RUN else ():
        yield from _between(text[at : found.start()], size)
        at = found.end() - (found.end() < len(text))
        yield text[found.start() : at]
    yield from _between(text[at:] if at else text, size)


def _between(text: str, size: int) -> Iterator[str]:
    at = 0
    while len(text) - at > size and (cut := _CUT.search(text, at + size)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def count_tokens(text: str, encoding) -> int:
    """Tokens of a whole text; a long run of white space is one split and goes to the merges directly."""
    return sum(len(encoding._encode_single_piece(p.encode()) if len(p) >= RUN_CHARS - 1 and _RUN.fullmatch(p + " ") else encoding.encode_ordinary(p)) for p in pieces(text))


def length_histogram(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(n_tokens, n_docs): how many documents have each encoded length.

    The histogram is written before it is used, so that every answer from it leaves the documents alone.
    """

    def count(batches):
        encoding = _encoding(vocabulary, pattern)
        for batch in batches:
            seen: dict[int, int] = {}
            for text in batch.column(0):
                n = count_tokens(text.as_py() or "", encoding)
                seen[n] = seen.get(n, 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], ["n_tokens", "n_docs"])

    part = map_arrow(docs.select(F.col("text").cast("string").alias("text")), count, "n_tokens long, n_docs long")
    return materialise(part.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs")), "histogram")


def with_suffix_sums(hist: DataFrame, run: int = 512) -> DataFrame:
    """For every length: documents and tokens at or above it, and the corpus total when cut at it.

    Lengths are summed inside runs of ``run`` lengths; one row per run is then summed across runs.
    """
    hist = hist.withColumn("run", F.expr(f"n_tokens div {run}"))
    sums = hist.groupBy("run").agg(F.sum("n_docs").alias("run_docs"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("run_tokens"))
    above = Window.orderBy(F.desc("run")).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "run",
        F.coalesce(F.sum("run_docs").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("run_tokens").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("run_docs").over(Window.orderBy(F.desc("run")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("all_docs"),
        F.sum("run_tokens").over(Window.orderBy(F.desc("run")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("all_tokens"),
    )
    inside = Window.partitionBy("run").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at_least = hist.select(
        "run", "n_tokens", "n_docs", F.sum("n_docs").over(inside).alias("docs_in"), F.sum(F.col("n_docs") * F.col("n_tokens")).over(inside).alias("tokens_in")
    ).join(sums, "run")
    docs, tokens = F.col("docs_in") + F.col("docs_above"), F.col("tokens_in") + F.col("tokens_above")
    return at_least.select(
        "n_tokens",
        "n_docs",
        docs.alias("docs_at_least"),
        tokens.alias("tokens_at_least"),
        (F.col("all_docs") - docs + F.col("n_docs")).alias("docs_at_most"),
        (F.col("all_tokens") - tokens + F.col("n_tokens") * docs).alias("truncated_total"),
        F.col("all_docs").alias("total_docs"),
        F.col("all_tokens").alias("total_tokens"),
    )


def totals_at(sums: DataFrame, limits: list[int]) -> DataFrame:
    """Per context limit: documents that fit, documents cut, and tokens left after the cut."""
    fits, cut = F.col("n_tokens") <= F.col("context"), F.col("n_tokens") > F.col("context")
    at = F.explode(F.array(*[F.lit(x).cast("long") for x in limits])).alias("context")
    zero: Column = F.lit(0).cast("long")
    return (
        sums.select("n_tokens", "n_docs", at)
        .groupBy("context")
        .agg(
            F.coalesce(F.sum(F.when(fits, F.col("n_docs"))), zero).alias("docs_within"),
            F.coalesce(F.sum(F.when(cut, F.col("n_docs"))), zero).alias("docs_cut"),
            F.sum(F.least("n_tokens", "context") * F.col("n_docs")).alias("tokens_kept"),
        )
    )


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """The smallest length that at least the given share of documents doesn't exceed."""
    at = F.explode(F.array(*[F.lit(float(x)) for x in shares])).alias("share")
    hit = F.when(F.col("docs_at_most") >= F.col("share") * F.col("total_docs"), F.col("n_tokens"))
    return sums.select("n_tokens", "docs_at_most", "total_docs", at).groupBy("share").agg(F.min(hit).alias("n_tokens"))
