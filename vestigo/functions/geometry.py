"""Boxes, tiles and greedy suppression as column expressions.

A box is a struct with left, top, right, bottom and score; ``index`` breaks ties of score.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOX = "struct<left: double, top: double, right: double, bottom: double, score: double, index: int>"


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 where the union has no area."""
    w = F.greatest(F.least(a["right"], b["right"]) - F.greatest(a["left"], b["left"]), F.lit(0.0))
    h = F.greatest(F.least(a["bottom"], b["bottom"]) - F.greatest(a["top"], b["top"]), F.lit(0.0))
    inter = w * h
    area = lambda x: (x["right"] - x["left"]) * (x["bottom"] - x["top"])
    union = area(a) + area(b) - inter
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0))


def by_score(boxes: Column) -> Column:
    """Descending score, then ascending index."""
    order = lambda x, y: F.when(x["score"] > y["score"], -1).when(x["score"] < y["score"], 1).when(x["index"] < y["index"], -1).when(x["index"] > y["index"], 1).otherwise(0)
    return F.array_sort(boxes, order)


def nms(boxes: Column, most: float = 0.5) -> Column:
    """Greedy non-maximum suppression: a box stays if it overlaps no stronger kept box by more than ``most``."""
    return F.aggregate(
        by_score(boxes), F.array().cast(f"array<{BOX}>"), lambda kept, b: F.when(F.exists(kept, lambda k: iou(k, b) > most), kept).otherwise(F.concat(kept, F.array(b)))
    )


def decode_head(predictions: Column, least: float = 0.15, most: float = 0.5, side: float = 640.0) -> Column:
    """Visual hits from rows (cx, cy, w, h, score...) of a detector of ``side`` pixels.

    The score is the best class; suppression precedes clipping and rounding.
    """
    raw = F.transform(
        predictions,
        lambda p, i: F.struct(
            ((p[0] - p[2] / 2) / side).alias("left"), ((p[1] - p[3] / 2) / side).alias("top"),
            ((p[0] + p[2] / 2) / side).alias("right"), ((p[1] + p[3] / 2) / side).alias("bottom"),
            F.array_max(F.slice(p, F.lit(5), F.size(p) - 4)).alias("score"), i.cast("int").alias("index"),
        ),
    )
    kept = nms(F.filter(raw, lambda b: b["score"] >= least).cast(f"array<{BOX}>"), most)
    clip = lambda x: F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))
    return F.transform(
        kept,
        lambda b: F.struct(
            F.bround(b["score"], 4).alias("confidence"),
            F.struct(
                F.bround(clip(b["left"]), 4).alias("left"), F.bround(clip(b["top"]), 4).alias("top"),
                F.bround(clip(b["right"]) - clip(b["left"]), 4).alias("width"), F.bround(clip(b["bottom"]) - clip(b["top"]), 4).alias("height"),
            ).alias("bounding_box"),
        ),
    )


def tile_rects(side: int = 3, overlap: float = 0.15) -> Column:
    """Array of side * side overlapping tiles of the unit page, row by row."""
    step = 1.0 / side
    margin = step * overlap
    return F.transform(
        F.sequence(F.lit(0), F.lit(side * side - 1)),
        lambda k: F.struct(
            F.greatest((k % side) * step - margin, F.lit(0.0)).alias("left"), F.greatest(F.floor(k / side) * step - margin, F.lit(0.0)).alias("top"),
            F.least((k % side + 1) * step + margin, F.lit(1.0)).alias("right"), F.least((F.floor(k / side) + 1) * step + margin, F.lit(1.0)).alias("bottom"),
        ),
    )


def tile_to_page(box: Column, tile: Column) -> Column:
    """A box relative to a tile, relative to the page."""
    w, h = tile["right"] - tile["left"], tile["bottom"] - tile["top"]
    return F.struct(
        F.bround(tile["left"] + box["left"] * w, 4).alias("left"), F.bround(tile["top"] + box["top"] * h, 4).alias("top"),
        F.bround(box["width"] * w, 4).alias("width"), F.bround(box["height"] * h, 4).alias("height"),
    )


def ink_density(pixels: Column, limit: int = 200) -> Column:
    """Share of gray values under ``limit``; 0 without pixels."""
    n = F.coalesce(F.size(pixels), F.lit(0))
    return F.when(n > 0, F.size(F.filter(pixels, lambda p: p < limit)) / n).otherwise(F.lit(0.0))
