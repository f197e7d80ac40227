"""Quality rules as a short-circuit cascade.

Each rule rejects documents by integer tests on statistics of the whole text,
most of them on one that no other rule needs. A bounded sample of documents tells
what a rule costs beside the words, which all share, and which documents it
rejects; the order is then built rule by rule: next comes the rule with the most
rejections per second among the sampled documents that the rules so far left.
In the cascade each rule sees only the documents that the ones before it left,
and its statistics are computed for those alone. A document's verdict is that no
rule rejects it, so the order, and with it the sample, changes the cost alone.

Words are runs of characters outside space and 0x09-0x0D. Statistics: n_words,
word_chars (code points in words), n_symbols (characters of ``#*$%&|<>``),
n_lines, n_dup_lines (lines with a word that equal an earlier line),
n_repeat_words (words inside 8-word windows that the text has twice or more),
n_upper_words (words with A-Z and without a-z), n_exclamations, n_alpha_words
(words with a letter or any character beyond ASCII), n_word_lines (lines with a
word), n_bullet_lines (their first word begins with -, * or a bullet),
n_ellipsis_lines (their last word ends with ... or an ellipsis), n_top_bigram
(occurrences of the most frequent pair of neighbouring words) and
n_function_words (words among FUNCTION_WORDS once A-Z is lower-cased).

Defined results: a null text is an empty one, has no words and fails; null ids
and repeated rows are judged like others; other columns stay as they are, and
one that bears the name of an output gives way to it; an empty table stays empty.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import map_arrow
from .words import _BYTE, _LOWER, Words, _power, blocks, mix

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER, _SMALL = ((np.arange(256) >= a) & (np.arange(256) < a + 26) for a in (65, 97))
WINDOW = 8
#: Common function words of English, German, French and Spanish.
FUNCTION_WORDS = (
    "the", "of", "and", "to", "a", "in", "that", "is", "der", "die", "und", "den", "das", "ist", "zu",
    "la", "de", "et", "le", "les", "un", "une", "des", "que", "el", "los", "en", "y",
)
#: Documents on which costs and selectivities are estimated.
SAMPLE_DOCS = 2_000


def _word_key(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Words of up to seven bytes as integers, bytes and length; longer ones as 0."""
    eight = np.ndarray(len(buf) - 7, "<u8", buf, strides=(1,))
    short = np.minimum(size, 7)
    low = np.array([(1 << 8 * k) - 1 for k in range(8)], np.uint64)[short]
    return np.where(size <= 7, eight[start] & low | size.astype(np.uint64) << np.uint64(56), np.uint64(0))


_FUNCTION_KEYS = np.array([int.from_bytes(w.encode(), "little") | len(w.encode()) << 56 for w in FUNCTION_WORDS], np.uint64)


class TextStats:
    """Statistics of a block of texts, each computed when a rule first asks for it."""

    def __init__(self, column: pa.Array | Words):
        self._words = column if isinstance(column, Words) else Words(column, lower=False)

    def fresh(self) -> TextStats:
        """The same texts with nothing computed but their words."""
        return TextStats(self._words)

    def take(self, rows: np.ndarray) -> TextStats:
        """Some of the texts; what is computed comes along."""
        out = TextStats(self._words.take(rows))
        out.__dict__.update({k: v[rows] for k, v in self.__dict__.items() if not k.startswith("_")})
        return out

    def _per_text(self, flags: np.ndarray) -> np.ndarray:
        w = self._words
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[np.append(w.first[1:] - 1, len(w.raw))] - sums[w.first] if w.texts else np.zeros(0, np.int64)

    def _per_word(self, flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[self._words.bound[1:]] - sums[self._words.bound[:-1]]

    def _has_byte(self, of: np.ndarray) -> np.ndarray:
        """Whether each word has a byte of these."""
        w = self._words
        sums = np.concatenate([[0], np.cumsum(of[w.raw], dtype=np.int64)])
        return sums[w.end] > sums[w.start]

    @cached_property
    def _lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the lines with a word: start and end in the buffer, first word and word behind the last."""
        w = self._words
        ends = np.flatnonzero(w.raw == 10)
        start, end = ends[:-1] + 1, ends[1:]
        first, behind = np.searchsorted(w.start, start), np.searchsorted(w.start, end)
        some = behind > first
        return start[some], end[some], first[some], behind[some]

    def _per_line(self, flags: np.ndarray) -> np.ndarray:
        w = self._words
        return np.bincount(np.searchsorted(w.first, self._lines[0][flags], "right") - 1, minlength=w.texts).astype(np.int64)

    @cached_property
    def n_words(self) -> np.ndarray:
        return self._words.count.astype(np.int64)

    @cached_property
    def word_chars(self) -> np.ndarray:
        raw = self._words.raw
        return self._per_text((raw & 0xC0 != 0x80) & (raw != 32) & ((raw < 9) | (raw > 13)))

    @cached_property
    def n_symbols(self) -> np.ndarray:
        return self._per_text(_SYMBOL[self._words.raw])

    @cached_property
    def n_lines(self) -> np.ndarray:
        w = self._words  # the separator after the text counts for the last line
        return self._per_text(w.raw == 10) + 1 - (np.arange(w.texts) == w.texts - 1)

    @cached_property
    def n_dup_lines(self) -> np.ndarray:
        w, raw = self._words, self._words.raw
        start, end, _, _ = self._lines
        if not len(start):
            return np.zeros(w.texts, np.int64)
        power, inverse = _power(len(raw))
        sums = np.cumsum(_BYTE[raw] * power[: len(raw)], dtype=np.uint64)
        line = mix((sums[end - 1] - sums[start - 1]) * inverse[start] ^ (end - start).astype(np.uint64))
        owner = np.searchsorted(w.first, start, "right") - 1
        order = np.lexsort((line, owner))
        same = (line[order][1:] == line[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        return np.bincount(owner[order][1:][same], minlength=w.texts).astype(np.int64)

    @cached_property
    def n_upper_words(self) -> np.ndarray:
        return self._per_word(self._has_byte(_UPPER) & ~self._has_byte(_SMALL))

    @cached_property
    def n_exclamations(self) -> np.ndarray:
        return self._per_text(self._words.raw == 33)

    @cached_property
    def n_alpha_words(self) -> np.ndarray:
        return self._per_word(self._has_byte(_UPPER | _SMALL | (np.arange(256) >= 128)))

    @cached_property
    def n_word_lines(self) -> np.ndarray:
        return self._per_line(np.ones(len(self._lines[0]), bool))

    @cached_property
    def n_bullet_lines(self) -> np.ndarray:
        w, first = self._words, self._lines[2]
        at = w.start[first]
        head, second, third = (w.raw[np.minimum(at + k, len(w.raw) - 1)] for k in range(3))
        return self._per_line((head == 45) | (head == 42) | ((head == 0xE2) & (second == 0x80) & (third == 0xA2)))

    @cached_property
    def n_ellipsis_lines(self) -> np.ndarray:
        w, last = self._words, self._lines[3] - 1
        end, size = w.end[last], (w.end - w.start)[last]
        tail = [w.raw[end - k] for k in (3, 2, 1)] if len(end) else [np.zeros(0, np.uint8)] * 3
        dots = (tail[0] == 46) & (tail[1] == 46) & (tail[2] == 46)
        return self._per_line((size >= 3) & (dots | ((tail[0] == 0xE2) & (tail[1] == 0x80) & (tail[2] == 0xA6))))

    @cached_property
    def n_function_words(self) -> np.ndarray:
        w = self._words
        keys = _word_key(np.concatenate([_LOWER[w.raw], np.zeros(8, np.uint8)]), w.start, w.end - w.start)
        return self._per_word(np.isin(keys, _FUNCTION_KEYS))

    @cached_property
    def n_top_bigram(self) -> np.ndarray:
        w = self._words
        out = np.zeros(w.texts, np.int64)
        hashes, valid = w.windows(2)
        size = np.maximum(w.count - 1, 0)
        h = hashes[valid]
        at = np.concatenate([[0], np.cumsum(size)])
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            h[a:b].sort()
        if len(h):
            new = np.ones(len(h), bool)
            new[1:] = h[1:] != h[:-1]
            new[at[:-1][size > 0]] = True
            head = np.flatnonzero(new)
            run = np.diff(np.append(head, len(h)))
            out[size > 0] = np.maximum.reduceat(run, np.searchsorted(head, at[:-1][size > 0]))
        return out

    @cached_property
    def n_repeat_words(self) -> np.ndarray:
        w = self._words
        out = np.zeros(w.texts, np.int64)
        hashes, valid = w.windows(WINDOW)
        for i in np.flatnonzero(w.count > WINDOW).tolist():
            a, b = w.bound[i], w.bound[i + 1]
            h = hashes[a : b - WINDOW + 1]
            s = np.sort(h)
            twice = s[1:][s[1:] == s[:-1]]
            if len(twice):
                at = np.flatnonzero(np.isin(h, twice))
                cover = np.zeros(b - a + 1, np.int64)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + WINDOW, -1)
                out[i] = np.count_nonzero(np.cumsum(cover)[:-1])
        return out


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps statistics to a boolean per text; it may touch only what it needs."""

    name: str
    rejects: Callable[[TextStats], np.ndarray]


BASE_RULES = (
    Rule("too_few_words", lambda s: s.n_words < 20),
    Rule("repeated_words", lambda s: 100 * s.n_repeat_words > 30 * s.n_words),
)
RULES = (
    Rule("symbols", lambda s: 10 * s.n_symbols > s.n_words),
    Rule("word_length", lambda s: (s.word_chars < 3 * s.n_words) | (s.word_chars > 12 * s.n_words)),
    Rule("repeated_lines", lambda s: 2 * s.n_dup_lines > s.n_lines),
    Rule("shouting", lambda s: 2 * s.n_upper_words > s.n_words),
    Rule("exclamations", lambda s: 5 * s.n_exclamations > s.n_words),
    Rule("no_letters", lambda s: 10 * s.n_alpha_words < 8 * s.n_words),
    Rule("bullet_lines", lambda s: 10 * s.n_bullet_lines > 9 * s.n_word_lines),
    Rule("ellipsis_lines", lambda s: 10 * s.n_ellipsis_lines > 3 * s.n_word_lines),
    Rule("top_bigram", lambda s: (s.n_top_bigram >= 5) & (10 * s.n_top_bigram > s.n_words)),
    Rule("no_function_words", lambda s: (s.n_words >= 50) & (s.n_function_words == 0)),
)
STATS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def best_order(rejected: dict[int, int], seconds: list[float]) -> list[int]:
    """Rules by conditional rejections per second.

    ``rejected`` counts documents by the set of rules that reject them, as bits; ``seconds`` has
    each rule's time over all of them. Where no rule rejects any more, the cheapest come first.
    """
    order, left = [], dict(rejected)
    rest = list(range(len(seconds)))
    while rest:
        hits = {k: sum(n for mask, n in left.items() if mask >> k & 1) for k in rest}
        k = min(rest, key=lambda k: (-hits[k] / max(seconds[k], 1e-9), seconds[k], k))
        order.append(k)
        rest.remove(k)
        left = {mask: n for mask, n in left.items() if not mask >> k & 1}
    return order


def plan_order(docs: DataFrame, rules: Iterable[Rule] = BASE_RULES + RULES, sample_docs: int = SAMPLE_DOCS) -> list[Rule]:
    """The rules in the order that a sample of about ``sample_docs`` documents suggests."""
    rules = list(rules)
    total = docs.count()
    sample = docs.select(F.col("text").cast("string").alias("text"))
    sample = sample.sample(min(1.0, sample_docs / total), seed=11) if total else sample

    def measure(batches):
        for batch in batches:
            for part in blocks(batch):
                whole, mask, rows = TextStats(part.column(0)), np.zeros(part.num_rows, np.int64), []
                for k, rule in enumerate(rules):
                    stats, began = whole.fresh(), time.perf_counter()
                    bad = rule.rejects(stats)
                    rows.append((k, time.perf_counter() - began, None, 0))
                    mask |= bad.astype(np.int64) << k
                rows += [(None, 0.0, m, n) for m, n in zip(*(x.tolist() for x in np.unique(mask, return_counts=True)), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.float64(), pa.int64(), pa.int64()))], ["rule", "seconds", "mask", "n"])

    seen = map_arrow(sample, measure, "rule int, seconds double, mask long, n long").groupBy("rule", "mask").agg(F.sum("seconds").alias("seconds"), F.sum("n").alias("n")).collect()
    seconds = {r.rule: r.seconds for r in seen if r.rule is not None}
    order = best_order({r.mask: r.n for r in seen if r.rule is None}, [seconds.get(k, 0.0) for k in range(len(rules))])
    return [rules[k] for k in order]


def cascade(docs: DataFrame, rules: Iterable[Rule], stats: Iterable[str] = (), base: Iterable[Rule] = (), runs: str | None = None, kept: str = "kept") -> DataFrame:
    """``docs`` with the verdict, named ``kept``, and the statistics asked for.

    The statistics asked for are computed for all documents, and so are those of ``base`` rules, whose
    verdict is ``base_failed``; each of ``rules`` runs on what the ones before it, ``base`` included,
    left. ``runs`` names a column for the number of rules that a document went through.
    """
    rules, stats, base = list(rules), list(stats), list(base)
    names = [*stats, *(["base_failed"] if base else []), *([runs] if runs else []), kept]
    docs = docs.drop(*names)
    kinds = [T.StructField(n, T.BooleanType() if n in (kept, "base_failed") else T.LongType()) for n in names]
    schema = T.StructType([*docs.schema.fields, *kinds])
    at = docs.columns.index("text")

    def judge(batches):
        for batch in batches:
            for part in blocks(batch):
                left = TextStats(part.column(at))
                out = [pa.array(getattr(left, n)) for n in stats]
                failed = np.zeros(part.num_rows, bool)
                for rule in base:
                    failed |= rule.rejects(left)
                if base:
                    out.append(pa.array(failed))
                where, ran = np.arange(part.num_rows), np.zeros(part.num_rows, np.int64)
                bad = failed
                for rule in rules:
                    if bad.any():
                        fine = np.flatnonzero(~bad)
                        where, left = where[fine], left.take(fine)
                    if not len(where):
                        break
                    bad = rule.rejects(left)
                    ran[where] += 1
                alive = np.zeros(part.num_rows, bool)
                alive[where[~bad] if len(where) else where] = True
                out += [pa.array(ran)] if runs else []
                yield pa.RecordBatch.from_arrays([*part.columns, *out, pa.array(alive)], names=[*part.schema.names, *names])

    return map_arrow(docs, judge, schema)
