"""BPE encoding and decoding with exact concatenation of separately encoded parts.

A cut at space or 0x09-0x0D is always exact for a tokenizer that drops white
space and looks at no more than a word's own characters: a text's ids are those
of its words, end to end. What lies between such cuts is an unsplit stretch.

*Tree.* Every unsplit stretch over LEAF_BYTES bytes is encoded as a tree: its
halves are encoded apart (the leaves in one parallel batch), then at each join a
window that grows on both sides is encoded anew until it agrees with both halves
on a run of RUN tokens, places included; the tokens between the runs replace
what the cut had spoiled. Where no run agrees, the window becomes the whole
stretch. One agreed token would do for merges alone: a sequence of BPE tokens is
the encoding of its text if and only if each neighbouring pair is the encoding
of the pair's text, and behind an agreed token every pair comes from one of the
two encodings. The pattern that splits text before the merges reads left to
right with no look behind, and what it matches depends on at most three
characters beyond a match ('re, 've, 'll), so it falls into step inside a run of
four tokens. The tests hold the result to the library's on texts of up to 1 MB.

*Table.* Words repeat, so each worker keeps the ids of those it met: words of up
to LEAF_BYTES bytes under their own bytes as two integers, in an open hash table
that is searched for a whole block of texts at once, longer ones in a dictionary.
A block's ids are taken from the table by index, and its decoded texts, where
they are asked for, from the vocabulary by id. The table is emptied when its
entries or its bytes pass a bound, so a worker's memory follows the block at hand
and not the partition.

Defined results: a null text is empty and gives no ids and an empty decoded
text; null ids and repeated rows are treated like others; other columns stay,
and one that bears an output's name gives way to it; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .shared import map_arrow
from .words import Words, blocks, mix

#: Bytes of an unsplit stretch that are encoded in one piece; a table key holds as many.
LEAF_BYTES = 16
#: Tokens in a row on which both encodings must agree.
RUN = 4
#: The table is emptied when it holds more entries or more bytes than this.
TABLE_ENTRIES, TABLE_BYTES = 400_000, 32 << 20
#: A leaf of a stretch beyond this is as long as this, so a blob of megabytes takes a tree of some thousand leaves.
LONG_LEAF = 2048
_SLOTS = 1 << 20
_U = np.uint64
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_codecs: dict[str, Codec] = {}


class _Table:
    """The ids of stretches met, and where to find those of a short word."""

    def __init__(self) -> None:
        self.slot = np.full(_SLOTS, -1, np.int32)
        self.low, self.high, self.size = (np.zeros(_SLOTS >> 4, t) for t in (np.uint64, np.uint64, np.int64))
        self.long: dict[bytes, int] = {}
        self.long_bytes = 0
        self._ids, self._at = np.zeros(_SLOTS >> 2, np.int32), np.zeros(_SLOTS >> 4, np.int64)
        self._entries = 0

    def __len__(self) -> int:
        return self._entries

    @property
    def bytes(self) -> int:
        return 4 * int(self._at[self._entries]) + self.long_bytes

    def add(self, ids: list[list[int]]) -> np.ndarray:
        """New entries with these ids."""
        n = self._entries
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        at = self._at[n] + np.cumsum(size)
        self._at = _room(self._at, n + 1 + len(ids))
        self._at[n + 1 : n + 1 + len(ids)] = at
        if len(at):
            self._ids = _room(self._ids, int(at[-1]))
            self._ids[self._at[n] : at[-1]] = np.fromiter(chain.from_iterable(ids), np.int32, int(size.sum()))
        self._entries += len(ids)
        return np.arange(n, self._entries)

    def take(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these entries end to end, and the bounds of each entry's."""
        n = self._entries
        values = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(4 * self._at[: n + 1]), pa.py_buffer(self._ids)])
        return _taken(values, entry, np.int32, 4)

    def find(self, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Entry of each short word, or -1."""
        out = np.full(len(low), -1, np.int64)
        rest = np.arange(len(low))
        mask = len(self.slot) - 1
        at = (mix(low ^ mix(high + size.astype(np.uint64))) & _U(mask)).astype(np.int64)
        while len(rest):
            entry = self.slot[at[rest]]
            used = entry >= 0
            rest, entry = rest[used], entry[used]
            same = (self.low[entry] == low[rest]) & (self.high[entry] == high[rest]) & (self.size[entry] == size[rest])
            out[rest[same]] = entry[same]
            rest = rest[~same]
            at[rest] = (at[rest] + 1) & mask
        return out

    def put(self, entries: np.ndarray, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> None:
        """Make these entries found under these keys."""
        self.low, self.high, self.size = (_room(x, self._entries) for x in (self.low, self.high, self.size))
        self.low[entries], self.high[entries], self.size[entries] = low, high, size
        if 2 * self._entries > len(self.slot):
            self.slot = np.full(4 * len(self.slot), -1, np.int32)
            entries = np.flatnonzero(self.size[: self._entries])
            low, high, size = self.low[entries], self.high[entries], self.size[entries]
        mask, slot = len(self.slot) - 1, self.slot
        at = (mix(low ^ mix(high + size.astype(np.uint64))) & _U(mask)).tolist()
        for e, s in zip(entries.tolist(), at, strict=True):
            while slot[s] >= 0:
                s = (s + 1) & mask
            slot[s] = e


def _room(x: np.ndarray, n: int) -> np.ndarray:
    return x if n <= len(x) else np.concatenate([x, np.zeros(n + n // 2 - len(x), x.dtype)])


def _taken(values: pa.Array, index: np.ndarray, kind: type, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Binary values by index, end to end as numbers of ``kind``, and the bounds of each."""
    if not len(index):
        return np.zeros(0, kind), np.zeros(1, np.int64)
    out = values.take(pa.array(index))
    at = np.frombuffer(out.buffers()[1], np.int64)[: len(index) + 1] // width
    return np.frombuffer(out.buffers()[2] or b"", kind)[: at[-1]], at


class Codec:
    """Ids and decoded text of whole texts for one tokenizer file."""

    def __init__(self, path: str, leaf: int = LEAF_BYTES, cache_words: int = TABLE_ENTRIES, cache_bytes: int = TABLE_BYTES):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_padding()
        self._tokenizer.no_truncation()
        if leaf > LEAF_BYTES:
            raise ValueError("a leaf must fit a table key")
        self._leaf, self._entries, self._bytes = leaf, cache_words, cache_bytes
        # decode() of a tokenizer without a decoder joins the tokens' strings by a space
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        token = [b" "] * (max(vocabulary.values(), default=-1) + 1)
        for name, i in vocabulary.items():
            token[i] = b" " + name.encode()
        self._tokens = pa.array(token, pa.large_binary())
        if self._tokenizer.decoder is not None:
            raise ValueError("a decoder that works across words is not supported")
        self._table = _Table()
        #: Stretches that went through the tree; the tests read it.
        self.trees = 0

    def _spans(self, text: str, shift: int = 0) -> list[tuple[int, int, int]]:
        e = self._tokenizer.encode(text, add_special_tokens=False)
        return [(i, a + shift, b + shift) for i, (a, b) in zip(e.ids, e.offsets, strict=True)]

    def _join(self, text: str, left: list, right: list, lo: int, mid: int, hi: int) -> list:
        """Tokens of text[lo:hi] from those of text[lo:mid] and text[mid:hi]."""
        size = 8
        while True:
            whole = size >= len(left) and size >= len(right)
            a = lo if size >= len(left) else left[-size][1]
            b = hi if size >= len(right) else right[size - 1][2]
            window = self._spans(text[a:b], a)
            if whole:
                return window
            start = (0, 0) if a == lo else None
            if start is None:
                at = {t: k for k, t in enumerate(left[-size:], len(left) - size)}
                for i in range(len(window) - RUN + 1):
                    if window[i + RUN - 1][2] > mid:
                        break
                    k = at.get(window[i], -1)
                    if k >= 0 and left[k : k + RUN] == window[i : i + RUN]:
                        start = (k, i)
                        break
            stop = (len(right), len(window)) if b == hi else None
            if stop is None:
                at = {t: k for k, t in enumerate(right[:size])}
                for i in range(len(window) - RUN, -1, -1):
                    if window[i][1] < mid:
                        break
                    k = at.get(window[i], -1)
                    if k >= 0 and right[k : k + RUN] == window[i : i + RUN]:
                        stop = (k, i)
                        break
            if start and stop:
                return left[: start[0]] + window[start[1] : stop[1]] + right[stop[0] :]
            size *= 2

    def encode_unsplit(self, text: str) -> list[int]:
        """Ids of a stretch by tree concatenation."""
        self.trees += 1
        step = self._leaf if len(text) <= LONG_LEAF else LONG_LEAF
        cuts = list(range(0, len(text), step)) + [len(text)]
        found = self._tokenizer.encode_batch([text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], add_special_tokens=False)
        parts = [([(i, x + a, y + a) for i, (x, y) in zip(e.ids, e.offsets, strict=True)], a, b) for e, a, b in zip(found, cuts, cuts[1:], strict=False)]
        while len(parts) > 1:
            pairs = [parts[i : i + 2] for i in range(0, len(parts), 2)]
            parts = [p[0] if len(p) == 1 else (self._join(text, p[0][0], p[1][0], p[0][1], p[0][2], p[1][2]), p[0][1], p[1][2]) for p in pairs]
        return [i for i, _, _ in parts[0][0]] if parts else []

    def _short(self, buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Entries of words of up to LEAF_BYTES bytes."""
        eight = np.ndarray(len(buf) - 7, "<u8", buf, strides=(1,))
        low = eight[start] & _LOW_BYTES[np.minimum(size, 8)]
        high = eight[start + 8] & _LOW_BYTES[np.clip(size - 8, 0, 8)]
        out = self._table.find(low, high, size)
        new = np.flatnonzero(out < 0)
        if len(new):
            order = new[np.lexsort((size[new], high[new], low[new]))]
            head = np.ones(len(order), bool)
            head[1:] = (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1]) | (size[order][1:] != size[order][:-1])
            one = order[head]
            words = [buf[a : a + n].tobytes().decode() for a, n in zip(start[one].tolist(), size[one].tolist(), strict=True)]
            made = self._table.add([e.ids for e in self._tokenizer.encode_batch_fast(words, add_special_tokens=False)])
            self._table.put(made, low[one], high[one], size[one])
            out[order] = made[np.cumsum(head) - 1]
        return out

    def _long(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Entries of stretches that take a tree."""
        table = self._table
        out = np.empty(len(start), np.int64)
        for k, (a, b) in enumerate(zip(start.tolist(), end.tolist(), strict=True)):
            word = buf[a:b].tobytes()
            entry = table.long.get(word)
            if entry is None:
                entry = table.long[word] = int(table.add([self.encode_unsplit(word.decode())])[0])
                table.long_bytes += len(word)
            out[k] = entry
        return out

    def encode_block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a block of texts end to end, and the bounds of each text's."""
        w = Words(texts, lower=False)
        buf = np.concatenate([w.raw, np.zeros(24, np.uint8)])
        size = w.end - w.start
        entry = np.empty(len(size), np.int64)
        short = size <= self._leaf
        entry[short] = self._short(buf, w.start[short], size[short])
        entry[~short] = self._long(buf, w.start[~short], w.end[~short])
        ids, at = self._table.take(entry)
        if len(self._table) > self._entries or self._table.bytes > self._bytes:
            self._table = _Table()
        return ids, at[w.bound]

    def decode(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts of a block of ids, as UTF-8 bytes with one byte before each token, and the bounds of each text's."""
        data, ends = _taken(self._tokens, ids, np.uint8, 1)
        return data, ends[at]

    def encode(self, text: str | None) -> tuple[bytes, str]:
        """(ids as little-endian unsigned 32-bit integers, decoded text) of one whole text."""
        ids, at = self.encode_block(pa.array([text], pa.string()))
        return ids.tobytes(), str(next(_parts(*self.decode(ids, at), 1)), "utf-8")


def _codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _parts(data: np.ndarray, at: np.ndarray, skip: int = 0) -> Iterator[memoryview]:
    """Each part's bytes; ``skip`` bytes at the head of a part that isn't empty don't count."""
    view = memoryview(data).cast("B") if len(data) else memoryview(b"")
    for a, b in zip((data.itemsize * at[:-1]).tolist(), (data.itemsize * at[1:]).tolist(), strict=True):
        yield view[min(a + skip, b) : b]


_KINDS = {"ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType(), "n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}


def _columns(codec: Codec, texts: pa.Array, outputs: Iterable[str]) -> Iterator[pa.Array]:
    ids, at = codec.encode_block(texts)
    decoded = codec.decode(ids, at) if any(n.startswith("decoded") for n in outputs) else None
    for name in outputs:
        if name == "ids":
            yield pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids))
        elif name == "n_tokens":
            yield pa.array(np.diff(at), pa.int64())
        elif name == "ids_sha256":
            yield pa.array([hashlib.sha256(x).hexdigest() for x in _parts(ids, at)], pa.string())
        elif name == "decoded_sha256":
            yield pa.array([hashlib.sha256(x).hexdigest() for x in _parts(*decoded, 1)], pa.string())
        else:
            yield pa.array([str(x, "utf-8") for x in _parts(*decoded, 1)], pa.string())


def encode(docs: DataFrame, path: str, outputs: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """``docs`` with any of: ids (array<int>), decoded, n_tokens, ids_sha256, decoded_sha256."""
    docs = docs.drop(*outputs)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, _KINDS[n]) for n in outputs]])
    at = docs.columns.index("text")

    def run(batches):
        codec = _codec(path)
        for batch in batches:
            for part in blocks(batch):
                made = _columns(codec, part.column(at), outputs)
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, *outputs])

    return map_arrow(docs, run, schema)
