"""Repeated byte strings by prefix-free parsing.

Removes every byte that lies in a ``LENGTH``-byte string which also starts
earlier in the corpus (at a smaller doc_id, or earlier in the same document).

*Parse.* A rolling hash of GRAM bytes picks triggers: in each window of LENGTH
bytes the leftmost gram with the smallest hash. The choice depends on the
window's bytes alone, so equal windows have equal triggers. The windows that
share a trigger form a phrase, the string from the first such window's start to
the last one's end. Phrases overlap by LENGTH - 1 bytes, so each window lies in
exactly one phrase at a fixed offset, and no phrase is a proper prefix of
another one with the same trigger place.

*Dictionary and parse combined.* Phrases are sorted by trigger gram, phrase and
corpus position. A phrase that occurred before repeats all its windows. Only
grams with several different phrases can hide a repeated window inside phrases
that differ. Their dictionary, the first occurrence of each phrase, is dealt by
gram, so equal windows meet, and blocks of whole grams get a suffix array: the
order of all suffixes to LENGTH bytes, by doubling from 8 bytes on. Suffixes that
are equal so far stand side by side; the parse's places, document and start, tell
which of them comes first in the corpus, and the others' bytes go. Deeper order
isn't needed, and as phrases overlap by LENGTH - 1 bytes no window runs on into
the next phrase, so the parse needs no suffix array of its own.

A gram with over GROUP different phrases is too much for one task. Its phrases are
cut into pieces of up to PIECE windows by their distance from the trigger. All
windows of a piece share a core; a core that occurs once rules out every repeat,
equal pieces under one core repeat whole, and only pieces that differ under one
core come down to the windows themselves, sorted by hash and place over the
cluster. A repetitive text leaves few phrases. The dictionary is written with its
bytes, and pieces and windows are cut from there: whole texts are moved twice, once
for the dictionary and once for the cut, whether there are such grams or not.

Texts go through in blocks. Repeats inside a block are settled there, and a task
keeps the first places of MET strings in mind, so a phrase that a third of all
documents hold leaves a row only where its place precedes all that the task met
before: some five rows per task in a random order, not one per document.

Phrases are compared by 128 bits of hash (gram and phrase), suffixes by their
bytes, windows of large grams by 128 bits of hash.

Defined results: a null text is empty; matches never cross rows; a null doc_id
counts as the smallest; rows that share a doc_id are told apart by their text,
and copies of one row tie, so neither makes the other go; a text shorter than
LENGTH loses nothing; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import id_in, id_out, map_arrow, materialise
from .words import _BASE, _BYTE, blocks, mix, raw_texts

LENGTH = 100
GRAM = 40
#: Windows of a piece.
PIECE = 8
#: Different phrases of a gram that get a suffix array in one task, and bytes of phrases that share one.
GROUP, ARRAY_BYTES = 4096, 1 << 19
#: Bytes of a text that are parsed at once; longer texts continue with an overlap.
SEGMENT = 4 << 20
#: Strings whose first place a task keeps in mind.
MET = 1 << 18
_U = np.uint64
_POSITION = _U(0xFFFFFF)  # low bits of a sliding-minimum key hold the place, so SEGMENT < 2**24


def _pow(n: int) -> np.uint64:
    return _U(pow(_BASE, n, 2**64))


class _Hashes:
    """Rolling hashes of a byte array by doubling; entries past the end are of no use and unused."""

    def __init__(self, data: np.ndarray):
        with np.errstate(over="ignore"):
            h = _BYTE[data]
            self.by = {1: h}
            size = 1
            while size < 64:
                nxt = h * _pow(size)
                nxt[: max(0, len(h) - size)] += h[size:]
                h, size = nxt, 2 * size
                if size in (4, 8, 16, 32, 64):
                    self.by[size] = h

    def gram(self) -> np.ndarray:
        out = self.by[32] * _pow(8)
        out[: max(0, len(out) - 32)] += self.by[8][32:]
        return mix(out)

    def window(self, at: np.ndarray) -> np.ndarray:
        return mix(self.by[64][at] * _pow(36) + self.by[32][at + 64] * _pow(4) + self.by[4][at + 96])

    def core(self, at: np.ndarray) -> np.ndarray:
        """Hash of the LENGTH - PIECE + 1 = 64 + 16 + 8 + 4 + 1 bytes from each place on."""
        h = self.by[64][at] * _pow(29) + self.by[16][at + 64] * _pow(13) + self.by[8][at + 80] * _pow(5) + self.by[4][at + 88] * _U(_BASE) + self.by[1][at + 92]
        return mix(h)


def _triggers(gram: np.ndarray) -> np.ndarray:
    """For each window start the place of its trigger: the leftmost smallest gram hash."""
    key = (gram & ~_POSITION) | np.arange(len(gram), dtype=np.uint64)
    span, size = LENGTH - GRAM + 1, 1
    while 2 * size <= span:
        key[: max(0, len(key) - size)] = np.minimum(key[: max(0, len(key) - size)], key[size:])
        size *= 2
    rest = span - size
    if rest and len(key) > rest:
        key[: len(key) - rest] = np.minimum(key[: len(key) - rest], key[rest:])
    return (key & _POSITION).astype(np.int64)


def _segments(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, window starts, owner text of each, offset of the bytes in that text)."""
    size = np.diff(bounds)
    if len(size) == 1 and size[0] > SEGMENT:
        for s in range(0, int(size[0]) - LENGTH + 1, SEGMENT):
            part = data[s : s + SEGMENT + LENGTH - 1]
            starts = np.arange(len(part) - LENGTH + 1)
            yield part, starts, np.zeros(len(starts), np.int64), np.full(1, -s)
        return
    owner = np.repeat(np.arange(len(size)), np.maximum(size - LENGTH + 1, 0))
    if len(owner):
        skip = np.where(size >= LENGTH, LENGTH - 1, size)
        starts = np.arange(len(owner)) + np.concatenate([[0], np.cumsum(skip)])[:-1][owner]
        yield data, starts, owner, bounds[:-1]


def _spans(owner: np.ndarray, start: np.ndarray, end: np.ndarray, texts: int) -> list[bytes | None]:
    """Per text the byte spans [start, end) as packed int64 pairs, or None."""
    out: list[bytes | None] = [None] * texts
    order = np.lexsort((start, owner))
    pairs = np.stack([start, end], axis=1)[order].astype(np.int64)
    at = np.searchsorted(owner[order], np.arange(texts + 1))
    for i in np.flatnonzero(np.diff(at)).tolist():
        out[i] = pairs[at[i] : at[i + 1]].tobytes()
    return out


def _first_of(key: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows at their key's first place in the corpus, and rows at a later one."""
    order = np.lexsort((start, doc, key))
    k, d, s = key[order], doc[order], start[order]
    opens = np.ones(len(k), bool)
    opens[1:] = k[1:] != k[:-1]
    group = np.cumsum(opens) - 1
    head = np.flatnonzero(opens)
    later = (d != d[head][group]) | (s != s[head][group])
    return order[~later], order[later]


#: A row of the corpus: its id and 128 bits of its text.
_KEY = ["doc_id", "tag1", "tag2"]
_ROW = pa.schema([("gram", pa.int64()), ("string", pa.int64()), *((k, pa.int64()) for k in _KEY), ("place", pa.int64()), ("spans", pa.binary())])
_DDL = "gram long, string long, doc_id long, tag1 long, tag2 long, place long, spans binary"


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _emit(batch: pa.RecordBatch, gram, string, owner, place, spans) -> Iterator[pa.RecordBatch]:
    """Rows that go on to be sorted, then one row per text with what this block has settled."""
    keys = [batch.column(k) for k in range(len(_KEY))]
    if len(owner):
        at = pa.array(owner)
        yield pa.RecordBatch.from_arrays([_signed(gram), _signed(string), *(k.take(at) for k in keys), pa.array(place, pa.int64()), pa.nulls(len(owner), pa.binary())], schema=_ROW)
    if rows := [i for i, s in enumerate(spans) if s]:
        at = pa.array(rows)
        # Nothing is compared with these rows; the text's own bits deal them evenly.
        yield pa.RecordBatch.from_arrays([keys[1].take(at), pa.nulls(len(rows), pa.int64()), *(k.take(at) for k in keys), pa.nulls(len(rows), pa.int64()), pa.array([spans[i] for i in rows], pa.binary())], schema=_ROW)


def _pack(start: np.ndarray, before: np.ndarray, more: np.ndarray) -> np.ndarray:
    """A run of windows: start of the first, its distance to the trigger, and how many follow."""
    return start << 16 | before << 8 | more


def _unite(hashes: _Hashes, lo: np.ndarray, hi: np.ndarray, before: np.ndarray, under: np.ndarray) -> np.ndarray:
    """Hash of the string from window ``lo`` to window ``hi``, at its distance from the trigger, under a key."""
    return mix(hashes.window(lo) ^ mix(hashes.window(hi) + under)) ^ mix(before.astype(np.uint64) << _U(8) | (hi - lo).astype(np.uint64))


class _Copies:
    """Leaves out rows that are copies of one before; it keeps a bounded number of keys in mind, so some may pass."""

    def __init__(self, slots: int = MET):
        self._mask, self._keys = slots - 1, np.zeros((3, slots), np.int64)
        self._used = np.zeros(slots, bool)

    def drop(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = np.stack([batch.column(k).to_numpy() for k in range(3)]) if batch.num_rows else self._keys[:, :0]
        slot = keys[1] & self._mask
        keep = ~(self._used[slot] & (self._keys[:, slot] == keys).all(axis=0))
        order = np.lexsort(keys)
        same = np.zeros(len(order), bool)
        same[1:] = (keys[:, order[1:]] == keys[:, order[:-1]]).all(axis=0)
        keep[order[same]] = False
        self._keys[:, slot], self._used[slot] = keys, True
        return batch if keep.all() else batch.filter(pa.array(keep))


class _Met:
    """First occurrences of strings that this task met lately: a table of bounded size, one place per slot."""

    def __init__(self, slots: int = MET):
        self._mask = _U(slots - 1)
        self._string, self._doc, self._start = np.zeros(slots, np.uint64), np.zeros(slots, np.int64), np.zeros(slots, np.int64)
        self._used = np.zeros(slots, bool)

    def behind(self, string: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Whether each string was met at an earlier place of the corpus; the others are remembered."""
        slot = (string & self._mask).astype(np.int64)
        met = self._used[slot] & (self._string[slot] == string)
        late = met & ((self._doc[slot] < doc) | ((self._doc[slot] == doc) & (self._start[slot] < start)))
        new = slot[~late]
        self._string[new], self._doc[new], self._start[new], self._used[new] = string[~late], doc[~late], start[~late], True
        return late


def _parse(batches):
    """Phrases of each block under their trigger's gram."""
    seen = _Met()
    copies = _Copies()
    for batch in batches:
        for part in blocks(copies.drop(batch)):
            data, bounds = raw_texts(part.column(3))
            docs = part.column(0).to_numpy()
            for piece, starts, owner, base in _segments(data, bounds):
                hashes = _Hashes(piece)
                gram = hashes.gram()
                trigger = _triggers(gram)[starts]
                new = np.ones(len(starts), bool)
                new[1:] = (trigger[1:] != trigger[:-1]) | (owner[1:] != owner[:-1])
                head = np.flatnonzero(new)
                last = np.append(head[1:], len(starts)) - 1
                own, lo, hi, at = owner[head], starts[head], starts[last], trigger[head]
                g = gram[at]
                phrase = _unite(hashes, lo, hi, at - lo, g)
                start = lo - base[own]
                first, later = _first_of(phrase, docs[own], start)
                late = seen.behind(phrase[first], docs[own[first]], start[first])
                first, later = first[~late], np.concatenate([later, first[late]])
                spans = _spans(own[later], start[later], (start + hi - lo)[later] + LENGTH, part.num_rows)
                yield from _emit(part, g[first], phrase[first], own[first], _pack(start, at - lo, hi - lo)[first], spans)


def _unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start of a run's first window, its distance to the trigger, and the number of windows."""
    return place >> 16, place >> 8 & 255, (place & 255) + 1


def _wanted(part: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Of the runs that a text is asked for: owner text, start, distance to the trigger, windows, key."""
    wanted = part.column("wanted")
    counts = np.diff(np.frombuffer(wanted.buffers()[1], np.int32)[wanted.offset : wanted.offset + len(wanted) + 1])
    place = wanted.flatten().field(0).to_numpy()
    key = wanted.flatten().field(1).to_numpy().view(np.uint64)
    return np.repeat(np.arange(part.num_rows), counts), *_unpack(place), key


def _stretches(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, _Hashes, int]]:
    """Indexes of ``at`` in each stretch of the bytes with the stretch's hashes and start."""
    order, size = np.argsort(at, kind="stable"), SEGMENT
    ordered = at[order]
    for s in range(0, len(data), size):
        a, b = np.searchsorted(ordered, [s, s + size])
        if a < b:
            yield order[a:b], _Hashes(data[s : s + size + 2 * LENGTH + PIECE]), s


def _phrases(batches):
    """(gram, doc_id, tag1, tag2, place, big, phrase) of the wanted phrases."""
    copies = _Copies()
    for batch in batches:
        for part in blocks(copies.drop(batch)):
            data, bounds = raw_texts(part.column(3))
            own, start, before, n, key = _wanted(part)
            big = part.column("wanted").flatten().field(2)
            raw, low = memoryview(data), bounds[own] + start
            text = [bytes(raw[a:b]) for a, b in zip(low.tolist(), (low + n + LENGTH - 1).tolist(), strict=True)]
            at = pa.array(own)
            yield pa.RecordBatch.from_arrays([_signed(key), *(part.column(k).take(at) for k in range(3)), pa.array(_pack(start, before, n - 1), pa.int64()), big, pa.array(text, pa.binary())], ["gram", *_KEY, "place", "big", "phrase"])


def _dense(key: np.ndarray) -> np.ndarray:
    """The rank of each value among the distinct ones."""
    order = np.argsort(key, kind="stable")
    new = np.zeros(len(key), np.int64)
    ordered = key[order]
    new[1:] = ordered[1:] != ordered[:-1]
    out = np.empty(len(key), np.int64)
    out[order] = np.cumsum(new)
    return out


def suffix_ranks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ranks of the LENGTH bytes from each start on, in byte order: equal strings have equal ranks."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    rank = _dense(np.ndarray(len(data), ">u8", padded, strides=(1,)).astype(np.uint64))
    size, most = 8, len(data) + 1
    while 2 * size <= LENGTH:
        later = np.concatenate([rank[size:], np.zeros(min(size, len(rank)), np.int64)])[: len(rank)]
        rank, size = _dense(rank * most + later), 2 * size
    return _dense(rank[starts] * most + rank[starts + LENGTH - size])


def _later_windows(table: pa.Table) -> pa.RecordBatch | None:
    """Places of the phrases' windows that stand earlier in the corpus, run by run."""
    data, bounds = raw_texts(table.column("phrase").combine_chunks())
    doc, start = (table.column(k).to_numpy() for k in ("doc_id", "start"))
    n = np.diff(bounds) - LENGTH + 1
    row = np.repeat(np.arange(len(n)), n)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    rank = suffix_ranks(data, bounds[:-1][row] + inside)
    twice = np.flatnonzero(np.bincount(rank)[rank] > 1)
    if not len(twice):
        return None
    _, later = _first_of(rank[twice], doc[row[twice]], start[row[twice]] + inside[twice])
    gone = np.sort(twice[later])
    head = np.ones(len(gone), bool)
    head[1:] = (gone[1:] != gone[:-1] + 1) | (row[gone[1:]] != row[gone[:-1]])
    at = np.flatnonzero(head)
    more = np.diff(np.append(at, len(gone))) - 1
    first = gone[at]
    place = _pack(start[row[first]] + inside[first], np.zeros(len(at), np.int64), more)
    keys = table.select(_KEY).take(pa.array(row[first])).combine_chunks()
    return pa.RecordBatch.from_arrays([*(keys.column(k).combine_chunks() for k in _KEY), pa.array(place, pa.int64())], [*_KEY, "place"])


def _suffix_arrays(batches):
    """Later windows of phrases that come gram by gram; a suffix array holds whole grams."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        gram = batch.column(0).to_numpy()
        cuts = np.flatnonzero(np.diff(gram)) + 1
        if held and len(gram) and held[-1].column(0)[-1].as_py() != gram[0]:
            cuts = np.concatenate([[0], cuts])
        at = 0
        _, bounds = raw_texts(batch.column(5))
        for c in cuts.tolist():
            if size + bounds[c] - bounds[at] >= ARRAY_BYTES:
                held.append(batch.slice(at, c - at))
                if found := _later_windows(pa.Table.from_batches(held)):
                    yield found
                held, size, at = [], 0, c
        if at < batch.num_rows:
            held.append(batch.slice(at))
            size += int(bounds[-1] - bounds[at])
    if held and (found := _later_windows(pa.Table.from_batches(held))):
        yield found


def _split(batches):
    """Pieces of phrases under the hash of their core."""
    for batch in batches:
        for part in blocks(batch, "phrase"):
            data, bounds = raw_texts(part.column(3))
            docs = part.column(0).to_numpy()
            begin, before, n = _unpack(part.column(4).to_numpy())
            run = np.repeat(np.arange(len(n)), n)
            inside = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
            distance = before[run] - inside
            new = np.ones(len(run), bool)
            new[1:] = (run[1:] != run[:-1]) | (distance[1:] // PIECE != distance[:-1] // PIECE)
            head = np.flatnonzero(new)
            last = np.append(head[1:], len(run)) - 1
            owner, more, away = run[head], last - head, distance[head]
            start, whole = begin[owner] + inside[head], bounds[owner] + inside[head]
            core, string = np.empty(len(head), np.uint64), np.empty(len(head), np.uint64)
            for i, hashes, s in _stretches(data, whole):
                at = whole[i] - s
                core[i] = hashes.core(at + away[i] % PIECE) ^ mix((away[i] // PIECE).astype(np.uint64))
                string[i] = _unite(hashes, at, at + more[i], away[i], core[i])
            first, later = _first_of(string, docs[owner], start)
            spans = _spans(owner[later], start[later], (start + more)[later] + LENGTH, part.num_rows)
            yield from _emit(part, core[first], string[first], owner[first], _pack(start, away, more)[first], spans)


def _windows(batches):
    """Every window of the wanted pieces of phrases under the piece's core."""
    for batch in batches:
        for part in blocks(batch, "phrase"):
            data, bounds = raw_texts(part.column(3))
            docs = part.column(0).to_numpy()
            begin = _unpack(part.column(4).to_numpy())[0]
            own, lo, _, n, key = _wanted(part)
            owner, core = np.repeat(own, n), np.repeat(key, n)
            start = np.repeat(lo, n) + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            whole = bounds[owner] + start - begin[owner]
            string = np.empty(len(owner), np.uint64)
            for i, hashes, s in _stretches(data, whole):
                string[i] = hashes.window(whole[i] - s)
            first, later = _first_of(string ^ mix(core), docs[owner], start)
            spans = _spans(owner[later], start[later], start[later] + LENGTH, part.num_rows)
            zero = np.zeros(len(owner), np.int64)
            yield from _emit(part, core[first], string[first], owner[first], _pack(start, zero, zero)[first], spans)


def _ranked(rows: DataFrame) -> DataFrame:
    """Adds ``later`` (the string occurs before), ``mixed`` (its gram has other strings) and ``big`` (the gram has very many)."""
    same = Window.partitionBy("gram", "string").orderBy("doc_id", "place")
    gram = Window.partitionBy("gram")
    opening = F.first(F.struct("doc_id", "place")).over(same.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    own = F.col("string").isNotNull()
    rows = rows.withColumn("later", own & (F.struct("doc_id", "place") != opening))
    rows = rows.withColumn("mixed", own & (F.min("string").over(gram) != F.max("string").over(gram)))
    return rows.withColumn("big", F.count_if(own & ~F.col("later")).over(gram) > GROUP)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, tag1, tag2, span, spans): what goes, as one span or as packed pairs."""
    columns = [*_KEY, "gram", "place", "later", "spans"]
    asked = lambda rows, by, *what: rows.filter("place is not null and not later").groupBy(*by).agg(F.collect_set(F.struct("place", "gram", *what)).alias("wanted"))
    kept = "later or mixed or string is null"
    parsed = materialise(_ranked(map_arrow(docs, _parse, _DDL)).filter(kept).select(*columns, "big"), "phrases")
    looked = docs.join(asked(parsed, _KEY, "big").hint("shuffle_hash"), _KEY).select(*_KEY, "text", "wanted")
    dictionary = materialise(map_arrow(looked, _phrases, "gram long, doc_id long, tag1 long, tag2 long, place long, big boolean, phrase binary"), "dictionary")
    ordered = dictionary.filter("not big").select("gram", *_KEY, F.shiftright("place", 16).alias("start"), "phrase").repartition("gram").sortWithinPartitions("gram")
    arrays = map_arrow(ordered, _suffix_arrays, "doc_id long, tag1 long, tag2 long, place long")
    found = materialise(arrays.select(*_KEY, F.lit(None).cast("long").alias("gram"), "place", F.lit(True).alias("later"), F.lit(None).cast("binary").alias("spans")), "suffixes")
    settled = parsed.select(*columns).unionByName(found)
    large = dictionary.filter("big").select(*_KEY, "phrase", "place")
    if not large.isEmpty():
        pieces = materialise(_ranked(map_arrow(large, _split, _DDL)).filter(kept).select(*columns), "pieces")
        settled = settled.unionByName(pieces)
        if not pieces.filter("place is not null and not later").isEmpty():
            # A document has one phrase per trigger place, and a piece has its phrase's.
            trigger = F.expr("shiftright(place, 16) + (shiftright(place, 8) & 255)")
            by = [*_KEY, "trigger"]
            runs = asked(pieces.withColumn("trigger", trigger), by)
            looked = large.withColumn("trigger", trigger).join(runs.hint("shuffle_hash"), by).select(*_KEY, "phrase", "place", "wanted")
            settled = settled.unionByName(materialise(_ranked(map_arrow(looked, _windows, _DDL)).filter("later or string is null").select(*columns), "windows"))
    settled = settled.filter("later or place is null")
    span = F.expr(f"named_struct('start', shiftright(place, 16), 'end', shiftright(place, 16) + (place & 255) + {LENGTH})")
    return settled.select(*_KEY, F.when(F.col("place").isNotNull(), span).alias("span"), "spans")


def _cut(batches):
    for batch in batches:
        for part in blocks(batch):
            data, bounds = raw_texts(part.column(1))
            out: dict[str, list] = {k: [] for k in ("n_removed", "n_spans", "kept")}
            for i, (a, b, one, many) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), part.column(2), part.column(3), strict=True)):
                text = data[a:b]
                pairs = [np.frombuffer(x, np.int64) for x in many.as_py() or []]
                if one.is_valid and len(one.values):
                    values = one.values
                    pairs.append(np.stack([values.field(0).to_numpy(), values.field(1).to_numpy()], axis=1).ravel())
                if not pairs:
                    out["n_removed"].append(0), out["n_spans"].append(0), out["kept"].append(text.tobytes())
                    continue
                pairs = np.concatenate(pairs).reshape(-1, 2)
                edge = np.zeros(len(text) + 1, np.int32)
                np.add.at(edge, pairs[:, 0], 1)
                np.add.at(edge, pairs[:, 1], -1)
                gone = np.cumsum(edge[:-1]) > 0
                out["n_removed"].append(int(gone.sum()))
                out["n_spans"].append(int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1)))
                out["kept"].append(text[~gone].tobytes())
            kept = pa.array(out["kept"], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(bounds), pa.int64()), pa.array(out["n_removed"], pa.int64()), pa.array(out["n_spans"], pa.int64()), kept, pa.array([hashlib.sha256(x).hexdigest() for x in out["kept"]])],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
            )


def drop_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes) and kept_sha256."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(id_in().alias("doc_id"), F.xxhash64(text).alias("tag1"), F.xxhash64(F.lit(1), text).alias("tag2"), text.alias("text"))
    spans = repeated_spans(texts).groupBy(*_KEY).agg(F.collect_set("span").alias("one"), F.collect_set("spans").alias("many"))
    rows = texts.join(spans.hint("shuffle_hash"), _KEY, "left").select("doc_id", "text", "one", "many")
    cut = map_arrow(rows, _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
    return cut.withColumn("doc_id", id_out())
