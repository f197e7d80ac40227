"""Line deduplication by range-partitioned hashes and per-document keep bitmaps.

Every whole text is split at newlines. A line's key is the line stripped of
space and 0x09-0x0D at both ends with A-Z lower-cased. Keys of ``min_chars``
code points or more that occur in ``min_docs`` documents or more lose all their
lines except in the largest doc_id that holds them.

The plan is DataFrame expressions only:

1. Lines become (128-bit hash, document, position); the text stays behind.
2. Rows go to equal ranges of the hash space. A hash is uniform, so the bounds
   need no sort sample. Keys that a bounded sample of documents shows to hold a
   large share of all lines are dealt over several ranges by document; the
   sample decides the layout only, never the result. Their counts come from one
   pre-aggregated pass.
3. Each range is sorted by hash, document (descending) and position and streamed:
   the first document met keeps its lines, later ones lose theirs.
4. Dropped positions return to their document as a bitmap of 64-line words; words
   with nothing dropped are not stored.

Defined results: a null or empty text is one empty line; a null doc_id counts as
the smallest id; a repeated row counts as the same document and gets its own
output row; further columns of the input are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import free_names, id_in, id_out, shuffle_width

_SPACE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TAGS = ["row_tag1", "row_tag2"]
#: Documents in the sample that finds keys to be dealt over several ranges.
LAYOUT_SAMPLE_DOCS = 20_000


def line_key(line: Column) -> Column:
    stripped = F.btrim(line, F.lit(_SPACE))
    # A string of ASCII only has as many bytes as characters; lower() is then exact and fast.
    ascii_only = F.octet_length(stripped) == F.char_length(stripped)
    return F.when(ascii_only, F.lower(stripped)).otherwise(F.translate(stripped, _UPPER, _UPPER.lower()))


def _tags(text: Column) -> tuple[Column, Column]:
    """128 bits that tell rows of one doc_id apart."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    tags = dict(zip(_TAGS, _tags(F.col("text")), strict=True))
    return docs.select(id_in().alias("doc_id"), text.alias("text")).withColumns(tags)


def line_hashes(rows: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc_id, row_tag1, row_tag2, pos) of every line whose key is long enough."""
    lines = rows.select("doc_id", *_TAGS, F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    lines = lines.filter(F.char_length("line") >= min_chars).select("doc_id", *_TAGS, "pos", line_key(F.col("line")).alias("key"))
    lines = lines.filter(F.char_length("key") >= min_chars)
    return lines.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", *_TAGS, "pos")


def _wide_keys(rows: DataFrame, min_chars: int, ranges: int) -> list[tuple[int, int, int]]:
    """Keys that fill more than a quarter of a range in the sample: at most 4 * ranges of them."""
    total = rows.count()
    step = max(1, total // LAYOUT_SAMPLE_DOCS)
    sample = line_hashes(rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(step)) == 0), min_chars)
    counts = sample.groupBy("h1", "h2").agg(F.count("*").alias("n"))
    lines = counts.agg(F.sum("n").alias("lines")).first()["lines"] or 0
    least = max(lines / (4 * ranges), 32)
    return [(r.h1, r.h2, min(ranges, 1 + int(4 * ranges * r.n / lines))) for r in counts.filter(F.col("n") > least).collect()]


def dropped_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc_id, row_tag1, row_tag2, pos) of every line that goes."""
    spark = docs.sparkSession
    ranges = shuffle_width(spark)
    rows = _rows(docs)
    hashes = line_hashes(rows, min_chars)
    at = F.shiftright(F.shiftrightunsigned("h1", 32) * F.lit(ranges), 32)
    wide = _wide_keys(rows, min_chars, ranges)
    if wide:
        spread = F.broadcast(spark.createDataFrame(wide, "h1 long, h2 long, fan int"))
        seen = hashes.join(spread, ["h1", "h2"]).groupBy("h1", "h2", "doc_id").agg(F.first("fan").alias("fan"))
        known = seen.groupBy("h1", "h2").agg(F.first("fan").alias("fan"), F.count("*").alias("all_docs"), F.max("doc_id").alias("last_doc"))
        hashes = hashes.join(F.broadcast(known), ["h1", "h2"], "left")
        at = F.when(F.col("fan").isNull(), at).otherwise(F.pmod(at + F.pmod(F.xxhash64("doc_id"), F.col("fan")), F.lit(ranges)))
    dealt = hashes.withColumn("range", at.cast("int")).repartitionById(ranges, "range")
    group = Window.partitionBy("range", "h1", "h2").orderBy(F.desc("doc_id"), "pos")
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = dealt.withColumn("nth_doc", F.dense_rank().over(Window.partitionBy("range", "h1", "h2").orderBy(F.desc("doc_id"))))
    later, enough = F.col("nth_doc") > 1, F.max("nth_doc").over(whole) >= min_docs
    if wide:
        later = F.coalesce(F.col("doc_id") != F.col("last_doc"), later)
        enough = F.coalesce(F.col("all_docs") >= min_docs, enough)
    return ranked.withColumn("goes", later & enough).filter("goes").select("doc_id", *_TAGS, "pos")


def keep_bitmaps(dropped: DataFrame) -> DataFrame:
    """One row per document that loses lines: ``drops`` maps a 64-line word to its dropped bits."""
    bit = F.expr("shiftleft(1L, pos % 64)")
    # Combined where the lines lie: the copies of one row have a line in one range, so they leave one row a task.
    words = dropped.groupBy("doc_id", *_TAGS, F.expr("pos div 64").cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    return words.groupBy("doc_id", *_TAGS).agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("drops"))


_KEEP = "filter(split(text, '\\n', -1), (line, i) -> (coalesce(try_element_at({0}, cast(i div 64 as int)), 0L) & shiftleft(1L, i % 64)) = 0)"


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text and drops (the bitmap, null where nothing goes)."""
    maps = keep_bitmaps(dropped_lines(docs, min_chars, min_docs)).hint("shuffle_hash")
    dropped = F.expr("aggregate(map_values(drops), 0L, (n, bits) -> n + bit_count(bits))")
    return _rows(docs).join(maps, ["doc_id", *_TAGS], "left").select(
        id_out().alias("doc_id"),
        F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
        F.when(F.col("drops").isNull(), F.lit(0)).otherwise(dropped).cast("long").alias("n_dropped"),
        F.when(F.col("drops").isNull(), F.col("text")).otherwise(F.array_join(F.expr(_KEEP.format("drops")), "\n")).alias("kept_text"),
        "drops",
    )


def without_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs``, all columns, with repeated lines gone from ``text`` and ``n_chars``, if there, brought up to date."""
    keys = free_names(docs, "line_id", "line_tag1", "line_tag2")
    (drops,) = free_names(docs, "line_drops")
    maps = keep_bitmaps(dropped_lines(docs, min_chars, min_docs)).toDF(*keys, drops)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = docs.withColumns(dict(zip(keys, (id_in(), *_tags(text)), strict=True)))
    rows = marked.join(maps.hint("shuffle_hash"), keys, "left")
    new = {"text": F.when(F.col(drops).isNull(), F.col("text")).otherwise(F.array_join(F.expr(_KEEP.format(drops)), "\n"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col(drops).isNull(), F.col("n_chars")).otherwise(F.char_length(new["text"]).cast("long"))
    return rows.withColumns(new).select(*docs.columns)
