"""Benchmark passages inside documents: size-partitioned MinHash containment search.

An item with n distinct five-word shingles is contained in a document when at
least ``percent`` per cent of them occur there. Banded signatures of whole
documents can't find a 30-shingle item in a text of 20,000 shingles (their
Jaccard similarity is 0.0015), so the signature is on the item's side: items are
partitioned by size, a partition for each power of two, and an item's signature
is its m smallest MinHash values. With at most ``miss`` shingles absent from a
document that contains the item, at least m - miss of any m values are there; m
is 2 * miss + 1 for the largest item of the partition, or all of a smaller item.
A document looks up its shingles in each partition's signatures, items that reach
their count are candidates, none is missed, and exact containment on full sets
decides.

Documents are read once where they lie and nothing is shuffled. Items come in
blocks of bounded size (``BLOCK_BYTES`` of text), which the driver hands to the
tasks; a larger benchmark takes more blocks, each a pass over the documents.

Defined results: words are compared after A-Z is lower-cased; an item or a
document of fewer than five words has no shingle, so it neither matches nor is
matched; null texts are empty; null ids are returned as null; repeated rows
give repeated results; other columns of documents pass through ``clean`` as
they are; an empty table on either side gives no pairs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import map_arrow
from .words import Words, blocks, mix

SHINGLE = 5
BLOCK_BYTES = 8 << 20
_BITS = 20


@dataclass(frozen=True)
class _Partition:
    """Signatures of the items of one size class."""

    probes: np.ndarray  # sorted distinct signature values
    at: np.ndarray  # items of probe i: owner[at[i]:at[i + 1]]
    owner: np.ndarray
    need: np.ndarray  # by item: values of its signature that a document must have


@dataclass(frozen=True)
class _Items:
    """Shingle sets of a block of items and their partitions by size."""

    ids: list
    sets: list[np.ndarray]
    partitions: list[_Partition]
    seen: np.ndarray  # by the low bits of a value: whether any signature has them


def _sketch(ids: list, texts: list[str | None], percent: int) -> _Items:
    h, at = Words(pa.array(texts, pa.string())).shingles(SHINGLE, whole_if_short=False)
    sets = [h[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    size = np.diff(at)
    miss = size - -(-percent * size // 100)
    seen, partitions = np.zeros(1 << _BITS, bool), []
    for power in np.unique(np.log2(size[size > 0]).astype(int)).tolist():
        own = np.flatnonzero((size >= 1 << power) & (size < 2 << power))
        m = 2 * int(miss[own].max()) + 1
        signature = [np.sort(mix(sets[i]))[:m] for i in own.tolist()]
        probe, owner = np.concatenate(signature), np.repeat(own, [len(x) for x in signature])
        order = np.argsort(probe, kind="stable")
        values, first = np.unique(probe[order], return_index=True)
        need = np.zeros(len(sets), np.int64)
        need[own] = np.minimum(size[own], m) - miss[own]
        seen[values & np.uint64((1 << _BITS) - 1)] = True
        partitions.append(_Partition(values, np.append(first, len(probe)), owner[order], need))
    return _Items(ids, sets, partitions, seen)


def _candidates(text: np.ndarray, value: np.ndarray, part: _Partition, items: int) -> np.ndarray:
    """(text, item) of items of which a text has enough signature values, as text * items + item."""
    place = np.minimum(np.searchsorted(part.probes, value), len(part.probes) - 1)
    hit = part.probes[place] == value
    once = np.unique(text[hit] * len(part.probes) + place[hit])  # a shingle that a text repeats counts once
    text, place = once // len(part.probes), once % len(part.probes)
    fan = part.at[place + 1] - part.at[place]
    at = np.repeat(part.at[place], fan) + np.arange(int(fan.sum())) - np.repeat(np.cumsum(fan) - fan, fan)
    pair, count = np.unique(np.repeat(text, fan) * items + part.owner[at], return_counts=True)
    return pair[count >= part.need[pair % items]]


def _item_blocks(items: DataFrame, percent: int):
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = -(-total // BLOCK_BYTES)
    for p in range(parts):
        block = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == p).collect() if parts > 1 else rows.collect()
        yield _sketch([r.item_id for r in block], [r.text for r in block], percent)


def _search(column: pa.Array, items: _Items, percent: int) -> list[tuple[int, int, int]]:
    """(text, item, shared shingles) of every contained item."""
    w = Words(column)
    h, valid = w.windows(SHINGLE)
    value = mix(h)
    at = np.flatnonzero(items.seen[value & np.uint64((1 << _BITS) - 1)] & valid)
    if not len(at) or not items.partitions:
        return []
    text = np.searchsorted(w.bound, at, "right") - 1
    n = len(items.sets)
    pairs = np.sort(np.concatenate([_candidates(text, value[at], p, n) for p in items.partitions]))
    found, last, own = [], -1, None
    for i, c in zip((pairs // n).tolist(), (pairs % n).tolist(), strict=True):
        if i != last:
            last, own = i, np.unique(h[w.bound[i] : w.bound[i + 1]][valid[w.bound[i] : w.bound[i + 1]]])
        shared = int(np.isin(items.sets[c], own, assume_unique=True).sum())
        if 100 * shared >= percent * len(items.sets[c]):
            found.append((i, c, shared))
    return found


def contained_items(docs: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment) of every item that a document contains."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ddl = "doc_id long, item_id long, n_shingles long, n_shared long, containment double"
    out = texts.sparkSession.createDataFrame([], ddl)
    for k, block in enumerate(_item_blocks(items, percent)):

        def search(batches, block=block):
            for batch in batches:
                for part in blocks(batch):
                    found = _search(part.column(1), block, percent)
                    n = [len(block.sets[c]) for _, c, _ in found]
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0).take(pa.array([i for i, _, _ in found], pa.int64())),
                            pa.array([block.ids[c] for _, c, _ in found], pa.int64()),
                            pa.array(n, pa.int64()),
                            pa.array([s for _, _, s in found], pa.int64()),
                            pa.array([s / x for (_, _, s), x in zip(found, n, strict=True)], pa.float64()),
                        ],
                        ["doc_id", "item_id", "n_shingles", "n_shared", "containment"],
                    )

        pairs = map_arrow(texts, search, ddl)
        out = out.unionAll(pairs) if k else pairs
    return out


def clean(docs: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that contain an item; columns are left as they are."""
    column = docs.columns.index("text")
    for block in _item_blocks(items, percent):

        def keep(batches, block=block):
            for batch in batches:
                for part in blocks(batch):
                    left = np.ones(part.num_rows, bool)
                    left[[i for i, _, _ in _search(part.column(column), block, percent)]] = False
                    yield part.filter(pa.array(left))

        docs = map_arrow(docs, keep, docs.schema)
    return docs
