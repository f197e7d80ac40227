"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard checks.

Circulant MinHash takes two permutations of the hash space. The first, sigma,
scatters a document's shingles once; the second, pi, is used circularly shifted
by k for coordinate k: ``min pi(sigma(x) + k mod 2**32)``. Both are bijective
mixers of 32 bits, so no permutation is stored.

Steps, none of which gathers an unbounded group in one task or on the driver:

1. One pass over the texts writes signatures: band hashes, a one-byte sketch of
   each coordinate, and a 128-bit fingerprint of the shingle set. Of equal sets in
   a block only one row carries bands and sketch.
2. Different sets are the nodes of the link graph, numbered when they are written;
   rows with equal sets belong to one node. Sets that hold a large share of all
   rows, at most four per shuffle partition, meet their rows by broadcast.
3. Band hashes meet in a pre-aggregation; each bucket's smallest node leads it.
   Every member is checked against its leaders on full shingle sets.
4. Components of these links, and of links between the nodes of one doc_id, settle
   all pairs inside a component. Buckets that still hold several components are
   dealt as a grid of bounded cells, where the pairs between components that no
   leader settled are checked: members of the largest component meet the others,
   which meet each other. Pairs meet in the first band they share and are passed
   over where their sketches agree in so few coordinates that the threshold is out
   of reach (``floor_for``). Full sets come only to the members of a cell that have
   a pair left, and decide it.
5. Links found there join components to the final ones.

A pair at the threshold shares no band with a probability under 1e-8 for the
band shapes that ``bands_for`` gives, and its sketches agree in too few
coordinates with one under 1e-8, coordinates taken as independent.

Defined results: a null or empty text, or one without words, has an empty set
and is linked with nothing; a text with fewer words than a shingle has its whole
sequence as one; rows that share a doc_id are one document with all their sets,
and so are the rows without one, whose id counts as the smallest: they stay in
``one_per_group``; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import id_in, id_out, map_arrow, materialise, shuffle_width
from .words import BLOCK_BYTES, Words, blocks, mix

COORDINATES = 160
#: Members of a bucket that meet in one cell from either side, and bytes of their sets.
CELL, CELL_BYTES = 4096, 32 << 20
#: Members that are checked against one copy of their leader's set.
FOLLOWERS = 4096
#: Bound of the chance that a pair at the threshold shares no band, and of that its sketches agree in too few coordinates.
MISS = 1e-8
_STRIDE = 1 << 15


def bands_for(percent: int) -> tuple[int, int]:
    """(bands, rows) whose chance to miss a pair at the threshold is under MISS."""
    for rows in range(8, 0, -1):
        bands = COORDINATES // rows
        if (1 - (percent / 100) ** rows) ** bands < MISS:
            return bands, rows
    return COORDINATES, 1


def floor_for(percent: int) -> int:
    """Coordinates in which sketches must agree: a pair at the threshold agrees in fewer with a chance under MISS."""
    p, below = percent / 100, 0.0
    for k in range(COORDINATES + 1):
        below += math.comb(COORDINATES, k) * p**k * (1 - p) ** (COORDINATES - k)
        if below >= MISS:
            return k
    return COORDINATES


def _sigma(h: np.ndarray) -> np.ndarray:
    """A 64-bit shingle hash, scattered and folded to the 32-bit universe."""
    return (mix(h) >> np.uint64(32)).astype(np.uint32)


def signatures(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of COORDINATES minima per set; all sets must be non-empty."""
    sets = len(at) - 1
    out = np.empty((sets, COORDINATES), np.uint32)
    scattered = _sigma(h)
    a = 0
    while a < sets:  # a stretch of sets that stays in cache
        b = max(a + 1, int(np.searchsorted(at, at[a] + _STRIDE, "right")) - 1)
        x = scattered[at[a] : at[b]]
        y, z = np.empty_like(x), np.empty_like(x)
        starts = at[a:b] - at[a]
        for k in range(COORDINATES):
            np.add(x, np.uint32(k), out=y)  # circular shift by k
            y *= np.uint32(0x9E3779B1)
            np.right_shift(y, np.uint32(15), out=z)
            y ^= z
            y *= np.uint32(0x85EBCA77)
            out[a:b, k] = np.minimum.reduceat(y, starts)
        a = b
    return out


def _marks(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit fingerprints of each set; 0 for an empty one."""
    full = np.diff(at) > 0
    out = []
    for salt in (np.uint64(0), np.uint64(0xA5A5A5A5A5A5A5A5)):
        mark = np.zeros(len(full), np.uint64)
        if full.any():
            mark[full] = np.add.reduceat(mix(h ^ salt), at[:-1][full])
        out.append(mark)
    return out[0], out[1]


def _first_of_equals(n: np.ndarray, one: np.ndarray, two: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether a row is the one of the smallest id among rows of equal, non-empty sets."""
    order = np.lexsort((doc, two, one, n))
    new = np.ones(len(n), bool)
    new[1:] = (n[order][1:] != n[order][:-1]) | (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    out = np.zeros(len(n), bool)
    out[order[new]] = True
    return out & (n > 0)


def _sign(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    def sign(batches):
        for batch in batches:
            for part in blocks(batch):
                h, at = Words(part.column(2)).shingles(size)
                n = np.diff(at)
                one, two = _marks(h, at)
                owns = np.flatnonzero(_first_of_equals(n, one, two, part.column(0).to_numpy()))
                picked = [h[at[i] : at[i + 1]] for i in owns.tolist()]
                sig = signatures(np.concatenate(picked) if picked else h[:0], np.concatenate([[0], np.cumsum(n[owns])]))
                keys = np.empty((len(sig), bands), np.uint64)
                for b in range(bands):
                    key = np.full(len(sig), np.uint64(b))
                    for r in range(rows):
                        key = mix(key ^ sig[:, b * rows + r].astype(np.uint64))
                    keys[:, b] = key
                sketch, band = [None] * len(n), [None] * len(n)
                low = (sig & np.uint32(0xFF)).astype(np.uint8)  # the last multiplication leaves low bits even enough
                for k, i in enumerate(owns.tolist()):
                    sketch[i], band[i] = low[k].tobytes(), keys[k].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(band, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                    ["doc_id", "tag", "n_shingles", "mark1", "mark2", "bands", "sketch"],
                )

    return map_arrow(docs, sign, "doc_id long, tag long, n_shingles long, mark1 long, mark2 long, bands array<long>, sketch binary")


def _full_sets(texts: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of texts given as (node, mark1, text), each node once a task; a text of another mark isn't the node's."""

    def sets(batches):
        seen: set[int] = set()
        for batch in batches:
            for part in blocks(batch):
                h, at = Words(part.column(2)).shingles(size)
                mine = _marks(h, at)[0].view(np.int64) == part.column(1).to_numpy()
                nodes = part.column(0).to_pylist()
                new = [i for i in np.flatnonzero(mine).tolist() if nodes[i] not in seen and not seen.add(nodes[i])]
                data = [h[at[i] : at[i + 1]].tobytes() for i in new]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(new, pa.int64())), pa.array(data, pa.binary())], ["node", "shingles"])

    return map_arrow(texts, sets, "node long, shingles binary")


def _join_hot(rows: DataFrame, table: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """Inner join of ``rows`` with ``table``, one row per key; keys in ``hot``, a short list, come by broadcast."""
    few = F.broadcast(materialise(table.join(F.broadcast(hot.select(*keys)), keys, "left_semi"), "hot"))
    return rows.join(few, keys).unionByName(rows.join(few.select(*keys), keys, "left_anti").join(table, keys))


def _near(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    least, most = sorted((len(a), len(b)))
    if 100 * least < percent * most:
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _check_leaders(crowd: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of members with their buckets' leaders: members come sorted behind a copy of their leader's set."""
    pairs = crowd.filter("node <> leader").groupBy("leader", "node").agg(F.max("size").alias("size"))
    cell = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / FOLLOWERS)).cast("int")
    members = pairs.select("leader", cell.alias("cell"), "node")
    leaders = members.select("leader", "cell").distinct().select("leader", "cell", F.col("leader").alias("node"))
    rows = members.unionByName(leaders).join(sets, "node").withColumn("role", (F.col("node") != F.col("leader")).cast("int"))
    rows = rows.repartition("leader", "cell").sortWithinPartitions("leader", "cell", "role")

    def check(batches):
        leader, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            a, b = [], []
            for lead, node, data in zip(*(batch.column(i) for i in range(3)), strict=True):
                lead, node, s = lead.as_py(), node.as_py(), np.frombuffer(data.as_buffer(), np.uint64)
                if node == lead:
                    leader, own = lead, s.copy()
                elif lead == leader and _near(own, s, percent):
                    a.append(node)
                    b.append(lead)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return map_arrow(rows.select("leader", "node", "shingles"), check, "a long, b long")


def _cell_pairs(rows: dict, percent: int, done=lambda i, j: False):
    """Pairs of one cell that sketches leave open and that first meet here; ``done`` tells pairs that need no look."""
    comp, chunk, (left, right), band, keys, sketch = (rows[k] for k in ("comp", "chunk", "cell", "band", "bands", "sketch"))
    one, two = np.flatnonzero(chunk == left), np.flatnonzero(chunk == right)
    floor = floor_for(percent)
    sides = [(i, left == right) for i in one.tolist()] + [(i, True) for i in two.tolist() if left == _FIRST]
    for i, same_side in sides:
        others = two[two > i] if same_side else two
        others = others[comp[others] != comp[i]]
        if not len(others):
            continue
        others = others[(sketch[others] == sketch[i]).sum(axis=1) >= floor]
        if not len(others):
            continue
        first = (keys[others] == keys[i]).argmax(axis=1)
        for j in others[first == band].tolist():
            if not done(i, j):
                yield i, j


def _cell_links(rows: dict, percent: int, bands: int) -> list[tuple[int, int]]:
    """Links between components in one cell; ``rows`` has equal-length columns."""
    doc, comp, sets, parent = rows["doc"], rows["comp"], rows["sets"], {}

    def root(x):
        while x in parent:
            x = parent[x]
        return x

    links = []
    for i, j in _cell_pairs(rows, percent, lambda i, j: root(int(comp[i])) == root(int(comp[j]))):
        if _near(sets[i], sets[j], percent):
            a, b = root(int(comp[i])), root(int(comp[j]))
            links.append((int(doc[i]), int(doc[j])))
            parent[max(a, b)] = min(a, b)
    return links


_CELL = ["bucket", "left", "right"]
#: The first chunk of a bucket's largest component; its others count down from there.
_FIRST = -1


def _by_cell(rows: DataFrame, look, schema: str) -> DataFrame:
    """``look``, of a cell's rows as columns, over the cells (bucket, left, right) of ``rows``; it gives rows as tuples."""
    names = schema.replace(" long", "").split(", ")

    def run(batches):
        held: dict[str, list] = {}
        at = None

        def flush():
            if not held or len(held["node"]) < 2:
                return []
            rows = {"doc": np.array(held["node"]), "comp": np.array(held["comp"]), "chunk": np.array(held["chunk"]), "cell": at[1:3], "band": at[3], "bucket": at[0]}
            rows |= {"bands": np.array(held["bands"]), "sketch": np.array([np.frombuffer(x, np.uint8) for x in held["sketch"]])}
            if "shingles" in held:
                rows["sets"] = [np.frombuffer(x, np.uint64) for x in held["shingles"]]
            return look(rows)

        for batch in batches:
            found = []
            for r in batch.to_pylist():
                key = (r["bucket"], r["left"], r["right"], r["band"])
                if key != at:
                    found += flush()
                    held, at = {k: [] for k in r}, key
                for k, x in r.items():
                    held[k].append(x)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(len(names))], names)
        found = flush()
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(len(names))], names)

    return map_arrow(rows.repartition(*_CELL).sortWithinPartitions(*_CELL), run, schema)


def _check_cells(crowd: DataFrame, comps: DataFrame, reps: DataFrame, sets: DataFrame, percent: int, bands: int) -> DataFrame:
    """Links that no leader shows, in buckets that hold several components."""
    known = crowd.filter("size > 2 and node <> leader").join(comps, "node", "left")
    known = known.select("bucket", "band", "node", "n_shingles", F.coalesce("component", "node").alias("comp"))
    parts = known.groupBy("bucket", "comp").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size"))
    open_ = parts.groupBy("bucket").agg(F.max(F.struct("n", "size", "comp")).alias("main"), F.sum("n").alias("n"), F.sum("size").alias("size")).filter("n > main.n")
    chunks = lambda n, size: F.greatest(F.ceil(n / CELL), F.ceil(8 * size / CELL_BYTES)).cast("int")
    wide = {"fan": chunks(F.col("main.n"), F.col("main.size")), "rest": chunks(F.col("n") - F.col("main.n"), F.col("size") - F.col("main.size"))}
    # Written first: where its size is small, the join then leaves the members of a hot bucket where they lie.
    open_ = materialise(open_.withColumns(wide).select("bucket", F.col("main.comp").alias("main"), "fan", "rest"), "open")
    # The largest component's members meet the others, which meet each other; of a grid of chunks each cell holds two.
    mine = F.col("comp") == F.col("main")
    chunk = F.when(mine, _FIRST - F.pmod(F.xxhash64("node"), F.col("fan"))).otherwise(F.pmod(F.xxhash64("node"), F.col("rest"))).cast("int")
    rows = known.join(open_, "bucket").withColumn("chunk", chunk)
    numbers = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    own = F.transform(numbers("rest"), lambda j: F.struct(F.col("chunk").alias("left"), j.alias("right")))
    across = F.transform(numbers("fan"), lambda i: F.struct((_FIRST - i).alias("left"), F.col("chunk").alias("right")))
    among = F.transform(F.filter(numbers("rest"), lambda j: j != F.col("chunk")), lambda j: F.struct(F.least("chunk", j).alias("left"), F.greatest("chunk", j).alias("right")))
    rows = rows.withColumn("cell", F.explode(F.when(mine, own).otherwise(F.concat(across, among))))
    rows = rows.select("bucket", "cell.left", "cell.right", "band", "node", "comp", "chunk")
    rows = materialise(rows.join(reps.select("node", "bands", "sketch"), "node"), "cells")

    def candidates(cell):
        left, right = cell["cell"]
        some = {x for pair in _cell_pairs(cell, percent) for x in pair}
        return [(cell["bucket"], left, right, int(cell["doc"][i])) for i in some]

    # Only members with an open pair get their sets.
    live = materialise(_by_cell(rows, candidates, "bucket long, left long, right long, node long"), "live")
    with_sets = rows.join(live.distinct(), [*_CELL, "node"], "left_semi").join(sets, "node")
    return _by_cell(with_sets, lambda cell: _cell_links(cell, percent, bands), "a long, b long")


def near_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per input row: doc_id, n_shingles, component_id and kept (it is its component's smallest id).

    Documents are linked when 100 * |intersection| >= percent * |union| of their ``size``-word shingle sets.
    """
    bands, rows = bands_for(percent)
    width = shuffle_width(docs.sparkSession)
    text = F.col("text").cast("string")
    texts = docs.select(id_in().alias("doc_id"), F.xxhash64(text).alias("tag"), text.alias("text"))
    sig = materialise(_sign(texts, size, bands, rows), "signatures")
    marks = ["n_shingles", "mark1", "mark2"]
    classes = sig.filter("n_shingles > 0").groupBy(*marks).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    classes = materialise(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    least = (classes.agg(F.sum("copies").alias("n")).first()["n"] or 0) // (4 * width)  # so at most 4 * width sets are hot
    hot = classes.filter((F.col("copies") > least) & (F.col("copies") > 1)).select(*marks, "node")
    full = _join_hot(sig.filter("n_shingles > 0").select("doc_id", *marks), classes.select(*marks, "node"), marks, hot).select("doc_id", "n_shingles", "node")
    empty = sig.filter("n_shingles = 0").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("node"))
    member = materialise(full.unionByName(empty), "members")

    own = [F.col("rep").alias("doc_id"), *marks, "node"]
    reps = sig.filter("bands is not null").join(classes.select(*own).hint("shuffle_hash"), ["doc_id", *marks]).dropDuplicates(["doc_id", *marks])
    reps = materialise(reps.select("node", "doc_id", "tag", "n_shingles", "mark1", "bands", "sketch"), "representatives")
    keyed = reps.select("node", "n_shingles", F.posexplode("bands").alias("band", "bucket"))
    shared = materialise(keyed.groupBy("bucket").agg(F.min("node").alias("leader"), F.count("*").alias("size")).filter("size > 1"), "buckets")
    crowded = (shared.agg(F.sum("size").alias("n")).first()["n"] or 0) // (4 * width)
    crowd = materialise(_join_hot(keyed, shared, ["bucket"], shared.filter(F.col("size") > crowded)), "crowd")

    needed = reps.select("node", "doc_id", "tag", "mark1").join(crowd.select("node").distinct(), "node", "left_semi")
    sets = materialise(_full_sets(texts.join(needed.hint("shuffle_hash"), ["doc_id", "tag"]).select("node", "mark1", "text"), size), "sets")
    ids = member.filter("node is not null").groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("last")).filter("b <> last").select("doc_id", "b")
    same_id = member.join(ids, "doc_id").filter("node <> b").select(F.col("node").alias("a"), "b").distinct()
    comps = materialise(components(_check_leaders(crowd, sets, percent).unionByName(same_id)), "components")

    more = _check_cells(crowd, comps, reps, sets, percent, bands)
    to = comps.toDF("from", "to")
    lifted = more.join(to.toDF("a", "ca"), "a", "left").join(to.toDF("b", "cb"), "b", "left")
    joined = components(lifted.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))).toDF("component", "last")
    linked = comps.unionByName(joined.select(F.col("component").alias("node"), "component")).distinct()
    linked = linked.join(joined, "component", "left").select("node", F.coalesce("last", "component").alias("root"))
    linked = linked.unionByName(linked.select(F.col("root").alias("node"), "root")).distinct()
    label = linked.join(classes.select("node", "rep"), "node").groupBy("root").agg(F.min("rep").alias("label"))
    moved = classes.join(linked.join(label, "root").select("node", "label"), "node", "left").withColumn("label", F.coalesce("label", "rep"))
    moved = materialise(moved.filter("copies > 1 or label <> rep").select("node", "label"), "labels")
    others = _join_hot(member.filter("node is not null").select("doc_id", "node"), moved, ["node"], hot)
    others = others.filter("doc_id <> label").select("doc_id", "label").distinct()
    final = member.join(others, "doc_id", "left").withColumn("component", F.coalesce("label", "doc_id"))
    return final.select(id_out().alias("doc_id"), "n_shingles", id_out("component").alias("component_id"), (F.col("doc_id") == F.col("component")).alias("kept"))


def one_per_group(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that a smaller id of their component stands for; columns are left as they are."""
    gone = near_components(docs, size, percent).filter("not kept and doc_id is not null").select("doc_id").distinct()
    return docs.join(gone.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)
