"""The detection cascade, staged so that the expensive part sees as few rows as possible.

Level 0 is expressions over text, form fields and page ink. Level 1 is a
pluggable page detector (``Detector``) run by an Arrow UDF on useful pages only,
and on tiles only for documents in which neither level found anything.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf, pandas_udf
from pyspark.sql.window import Window

from .. import vocabulary as V
from ..functions import geometry as G
from ..functions import text as X
from ..functions.classify import detection_status, live_signature

#: A detector takes one gray page and a tile (left, top, right, bottom) or None; it returns rows (cx, cy, w, h, score) in 640-pixel space.
Detector = Callable[[bytes, tuple[float, float, float, float] | None], np.ndarray]


@dataclass(frozen=True)
class Options:
    """Run parameters. ``TOOL`` stops at the first level that finds something, ``BATCH`` runs both."""

    level1: bool = True
    cascade: bool = False
    max_pages: int | None = None
    confidence: float = 0.15
    iou: float = 0.5
    tiles: bool = True
    min_ink: float = V.MIN_INK


TOOL = Options(cascade=True)
BATCH = Options(cascade=False)


@pandas_udf(T.DoubleType())
def ink_density(pixels: pd.Series) -> pd.Series:
    """Share of 8-bit gray values under the dark limit; 0 without pixels."""
    return pixels.map(lambda b: float((np.frombuffer(b, np.uint8) < V.DARK_PIXEL).mean()) if b else 0.0)


def triage_pages(pages: DataFrame, min_ink: float = V.MIN_INK) -> DataFrame:
    """pages (doc, numero, gray, texto) with densidade_tinta, em_branco and tem_rotulo_assinatura.

    A page without pixels (NULL) hasn't been seen, so it isn't blank; one of no pixels is.
    """
    rows = pages.withColumn("densidade_tinta", ink_density("gray"))
    return rows.withColumns({"em_branco": F.col("gray").isNotNull() & (F.col("densidade_tinta") < min_ink), "tem_rotulo_assinatura": X.has_signature_label("texto")})


def level0(docs: DataFrame, widgets: DataFrame) -> DataFrame:
    """docs (doc, texto, texto_extraido) with digital and embedded hits and ``nivel0_total``.

    Text given from outside replaces the document's own unless it is NULL.
    """
    live = widgets.filter(live_signature("tem_valor", "tem_byterange", "bytes_contents"))
    embedded = live.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct(F.col("page"), F.col("campo")))).alias("embedded"))
    rows = docs.withColumn("digital", X.stamp_hits(F.coalesce("texto_extraido", "texto"))).join(embedded, "doc", "left")
    none = F.array().cast("array<struct<page: int, campo: string>>")
    rows = rows.withColumn("embedded", F.coalesce("embedded", none))
    return rows.withColumn("nivel0_total", F.size("digital") + F.size("embedded"))


def _hits(rows: DataFrame, detect: Detector) -> DataFrame:
    """Adds ``predictions`` and ``ms``, or ``failure``; one call per page or tile."""

    @pandas_udf("struct<predictions: array<array<double>>, ms: double, failure: string>")
    def run(gray: pd.Series, tile: pd.DataFrame) -> pd.DataFrame:
        out = []
        for g, t in zip(gray, tile.itertuples(index=False), strict=True):
            began = time.perf_counter()
            try:
                found = detect(g, None if pd.isna(t[0]) else tuple(t))
                out.append(([list(map(float, r)) for r in found], (time.perf_counter() - began) * 1000, None))
            except Exception as e:  # any failure of a backend becomes a column
                out.append(([], 0.0, f"{type(e).__name__}: {e}"))
        return pd.DataFrame(out, columns=["predictions", "ms", "failure"])

    return rows.withColumn("r", run("gray", "tile")).select(*rows.columns, "r.*")


def _by_place(hits: Column) -> Column:
    """Hits by page, then by their top edge; equal ones stay in order of score."""
    key = lambda h: (h["page"], h["bounding_box"]["top"])

    def order(x, y):
        (a, s), (b, t) = key(x), key(y)
        return F.when(a < b, -1).when(a > b, 1).when(s < t, -1).when(s > t, 1).otherwise(0)

    return F.array_sort(hits, order)


def level1(pages: DataFrame, detect: Detector, options: Options = BATCH, tiled: DataFrame | None = None) -> DataFrame:
    """Hits per document of useful pages: (doc, visual, paginas_analisadas, paginas_ladrilhadas, tempo_inferencia_ms, nivel1_erro).

    ``tiled`` has the documents (doc) for which an empty first pass is repeated on tiles. A failure on any page
    or tile drops level 1 as a whole for its document: no hits, no pages, only the error.
    """
    no_tile = F.lit(None).cast("struct<left: double, top: double, right: double, bottom: double>")
    whole = _hits(pages.withColumn("tile", no_tile), detect)
    found = whole.withColumn("hits", G.decode_head(F.col("predictions"), options.confidence, options.iou))
    hit = lambda h: F.struct(F.col("numero").alias("page"), h["confidence"].alias("confidence"), h["bounding_box"].alias("bounding_box"))
    found = found.withColumn("visual", F.transform("hits", hit))
    first = found.groupBy("doc").agg(
        F.flatten(F.collect_list("visual")).alias("visual"), F.count("*").alias("paginas_analisadas"), F.sum("ms").alias("ms"), F.max("failure").alias("nivel1_erro")
    )
    if not options.tiles or tiled is None:
        return _all_or_nothing(first.select("doc", "visual", "paginas_analisadas", F.lit(0).cast("bigint").alias("paginas_ladrilhadas"), F.col("ms").alias("tempo_inferencia_ms"), "nivel1_erro"))
    empty = first.filter("size(visual) = 0 and nivel1_erro is null").select("doc").join(tiled, "doc", "left_semi")
    again = pages.join(empty, "doc", "left_semi").withColumn("tile", F.explode(G.tile_rects()))
    again = _hits(again, detect).withColumn("hits", G.decode_head(F.col("predictions"), options.confidence, options.iou))
    on_page = again.withColumn("h", F.explode_outer("hits")).withColumn("box", F.when(F.col("h").isNotNull(), G.tile_to_page(F.col("h.bounding_box"), F.col("tile"))))
    box = F.struct(
        F.col("box.left").alias("left"), F.col("box.top").alias("top"), (F.col("box.left") + F.col("box.width")).alias("right"), (F.col("box.top") + F.col("box.height")).alias("bottom"),
        F.col("h.confidence").alias("score"), F.lit(0).alias("index"),
    )
    merged = on_page.groupBy("doc", "numero").agg(F.collect_list(F.when(F.col("box").isNotNull(), box)).alias("boxes"), F.sum("ms").alias("ms"), F.max("failure").alias("failure"))
    indexed = F.transform(F.sort_array("boxes"), lambda b, i: b.withField("index", i.cast("int"))).cast(f"array<{G.BOX}>")
    kept = merged.withColumn("kept", G.nms(indexed, options.iou))
    rect = lambda b: F.struct(b["left"].alias("left"), b["top"].alias("top"), F.bround(b["right"] - b["left"], 4).alias("width"), F.bround(b["bottom"] - b["top"], 4).alias("height"))
    kept = kept.withColumn("visual", F.transform("kept", lambda b: F.struct(F.col("numero").alias("page"), b["score"].alias("confidence"), rect(b).alias("bounding_box"))))
    second = kept.groupBy("doc").agg(F.flatten(F.collect_list("visual")).alias("visual2"), F.count("*").alias("tiled"), F.sum("ms").alias("ms2"), F.max("failure").alias("failure2"))
    both = first.join(second, "doc", "left")
    return _all_or_nothing(
        both.select(
            "doc",
            F.coalesce("visual2", "visual").alias("visual"),
            "paginas_analisadas",
            F.coalesce("tiled", F.lit(0)).alias("paginas_ladrilhadas"),
            (F.col("ms") + F.coalesce("ms2", F.lit(0.0))).alias("tempo_inferencia_ms"),
            F.coalesce("nivel1_erro", "failure2").alias("nivel1_erro"),
        )
    )


def _all_or_nothing(found: DataFrame) -> DataFrame:
    failed = F.col("nivel1_erro").isNotNull()
    nothing = {c: F.when(~failed, F.col(c)).otherwise(F.lit(0)) for c in ("paginas_analisadas", "paginas_ladrilhadas", "tempo_inferencia_ms")}
    return found.withColumns({**nothing, "visual": F.when(~failed, _by_place(F.col("visual"))).otherwise(F.slice("visual", 1, 0))})


def detect_documents(docs: DataFrame, pages: DataFrame, widgets: DataFrame, detect: Detector | None, options: Options = BATCH) -> DataFrame:
    """The whole cascade: one result row per document, with status.

    Level 1 is skipped where it is off, or where the cascade stops at a level 0 hit.
    """
    base = level0(docs, widgets)
    triaged = triage_pages(pages, options.min_ink)
    sizes = triaged.groupBy("doc").agg(F.count("*").alias("paginas"), F.count_if("em_branco").alias("paginas_em_branco"))
    base = base.join(sizes, "doc", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("paginas", "paginas_em_branco")})
    goes = F.lit(detect is not None and options.level1) & (F.lit(not options.cascade) | (F.col("nivel0_total") == 0))
    if detect is None or not options.level1:
        none = "cast(array() as array<struct<page: int, confidence: double, bounding_box: struct<left: double, top: double, width: double, height: double>>>)"
        rows = base.withColumns({"visual": F.expr(none), "paginas_analisadas": F.lit(0).cast("bigint"), "paginas_ladrilhadas": F.lit(0).cast("bigint"), "tempo_inferencia_ms": F.lit(0.0), "nivel1_erro": F.lit(None).cast("string")})
    else:
        useful = triaged.filter(~F.col("em_branco")).withColumn("nth", F.row_number().over(Window.partitionBy("doc").orderBy("numero")))
        if options.max_pages:
            useful = useful.filter(F.col("nth") <= options.max_pages)
        useful = useful.join(base.filter(goes).select("doc"), "doc", "left_semi")
        found = level1(useful.select("doc", "numero", "gray"), detect, options, base.filter("nivel0_total = 0").select("doc"))
        rows = base.join(found, "doc", "left")
        rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("paginas_analisadas", "paginas_ladrilhadas")}).withColumn("tempo_inferencia_ms", F.coalesce("tempo_inferencia_ms", F.lit(0.0)))
    rows = rows.withColumn("nivel1_total", F.greatest(F.coalesce(F.size("visual"), F.lit(0)), F.lit(0)))
    rows = rows.withColumn("assinaturas_total", F.col("nivel0_total") + F.col("nivel1_total"))
    limited = F.lit(False) if not options.max_pages else (F.col("paginas") - F.col("paginas_em_branco") > options.max_pages)
    sources = F.array_compact(F.array(F.when(F.size("digital") > 0, "digital"), F.when(F.size("embedded") > 0, "pdf_embedded"), F.when(F.col("nivel1_total") > 0, "visual")))
    return rows.withColumns(
        {
            "status": detection_status("assinaturas_total", "nivel1_erro"),
            "paginas_limitadas": limited,
            "fontes": sources,
            "signatarios": X.distinct_names(F.filter(F.transform("digital", lambda d: d["signatario"]), lambda s: s.isNotNull())),
        }
    )


#: What matters in a literal string: an escape or a parenthesis.
_LITERAL = re.compile(r"\\(?:[0-7]{1,3}|[\s\S]?)|[()]")
_ESCAPED = {"n": "\n", "r": "\r", "t": "\t", "b": "\b", "f": "\f"}


#: Bytes of text that are decoded at a time; a longer one goes alone.
_BLOCK = 1 << 20


def _blocks(texts: pa.Array) -> Iterator[list[str | None]]:
    """A batch's texts in their order, block by block."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _BLOCK, "right")))
        yield texts.slice(at, stop - at).to_pylist()
        at = stop


def _contents(s: str | None) -> bytes:
    at = (s or "").find("/Contents")
    if at < 0:
        return b""
    tail = s[at + len("/Contents") :]
    if m := re.match(r"\s*<([0-9A-Fa-f\s]*)>", tail):
        digits = re.sub(r"\s", "", m[1])
        return bytes.fromhex(digits[: len(digits) & ~1])
    start = tail.find("(")
    out, depth, at = [], 0, start
    for m in _LITERAL.finditer(tail, start) if start >= 0 else ():
        out.append(tail[at : m.start()])
        at, c = m.end(), m[0]
        if c[0] == "\\":
            out.append(chr(int(c[1:], 8) & 0xFF) if c[1:2].isdigit() else _ESCAPED.get(c[1:], c[1:]))
            continue
        depth += 1 if c == "(" else -1
        if not depth:
            return "".join(out).encode("latin-1", "replace")
        if m.start() > start:
            out.append(c)
    return b""


@arrow_udf(T.BinaryType())
def pdf_contents(obj: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Bytes of a ``/Contents`` entry, hexadecimal or literal with balanced parentheses and escapes."""
    for texts in obj:
        for block in _blocks(texts):
            yield pa.array(map(_contents, block), pa.binary(), size=len(block))
