"""Operators against brute force, on rows with nulls, empties, ties, repeats, long texts and clashing columns."""

import base64
import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vestigo.llm import bpe, components, decontaminate, line_dedup, near_dedup, pii, quality, sharding, substring_dedup, token_counts, warc
from vestigo.llm import words as W

P = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Columns that bear the names of outputs and of working columns.
CLASH = {"kept": "x", "size": 1, "shard": "s", "n_lines": 2, "n_words": "w", "component_id": 3, "spans": "q", "ids": "i", "pii": "p", "drops": 4, "rep": 5, "bands": 6, "tag": "t", "row_tag": 7, "bucket": 8, "position": 9, "n_tokens": "z", "line_id": 1, "line_drops": 2}


def _texts(seed=5):
    """(doc_id, text) rows: shared lines, near and exact copies, junk, nulls."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    common = [line(9) for _ in range(3)]
    rows = []
    for k in range(60):
        lines = [line(rng.randint(1, 14)) for _ in range(rng.randint(1, 7))]
        if k % 3 == 0:
            lines.insert(rng.randint(0, len(lines)), rng.choice(["  ", "\t", ""]) + common[k % 2].upper() + " ")
        rows.append((k * 3, "\n".join(lines)))
    base = line(120)
    for k in range(12):  # a family of near copies
        w = base.split()
        for _ in range(k):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        rows.append((500 + k, " ".join(w)))
    rows += [(600, rows[4][1]), (601, rows[4][1]), (700, None), (701, ""), (702, "   \n\t"), (703, "one two"), (704, "One  two"), (705, "a" * 400), (706, "word " * 40), (707, "x\n" * 30)]
    rows += [(710, "### $$$ &&& *** " * 30), (800, (line(3000) + "\n" + common[2] + "\n") * 3), (801, "b" * 120_000)]
    rows += [(None, rows[2][1]), (None, "another " + line(40)), (rows[6][0], rows[6][1])]
    return rows


ROWS = _texts()


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    return df.withColumns({k: F.lit(v) for k, v in CLASH.items()}).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def _key(i):
    return -(2**63) if i is None else i


def _sha(b):
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def _sorted(rows):
    return sorted(map(tuple, rows), key=repr)


def _columns(df, *names):
    return _sorted(df.select(*names).collect())


# --- words ---


def test_shingles_of_blocks():
    texts = [t for _, t in ROWS]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    for size in (1, 3, 5):
        got = []
        for part in W.blocks(batch, size=700):
            h, at = W.Words(part.column(0)).shingles(size)
            got += [h[a:b] for a, b in zip(at, at[1:], strict=False)]
        seen = {}
        for t, h in zip(texts, got, strict=True):
            w = WORD.findall((t or "").translate(LOW))
            want = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
            assert len(want) == len(h)
            seen.setdefault(frozenset(want), set()).add(h.tobytes())
        assert all(len(v) == 1 for v in seen.values()) and len({v for s in seen.values() for v in s}) == len(seen)


def test_a_text_larger_than_the_power_table():
    t = "ab cd ef " * 700_000
    h, at = W.Words(pa.array([t, "ab cd ef"])).shingles(3)
    assert np.diff(at).tolist() == [3, 1] and h[-1] in h[:3]


# --- token counts ---


def test_histogram_and_sums(spark, docs, none):
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    n = [len(e.encode_ordinary(t or "")) for _, t in ROWS]
    hist = token_counts.length_histogram(docs, path, P.PATTERN).cache()
    assert {r.n_tokens: r.n_docs for r in hist.collect()} == Counter(n)
    sums = token_counts.with_suffix_sums(hist, run=8)
    for r in sums.collect():
        assert r.docs_at_least == sum(x >= r.n_tokens for x in n) and r.tokens_at_least == sum(x for x in n if x >= r.n_tokens)
        assert r.docs_at_most == sum(x <= r.n_tokens for x in n) and r.truncated_total == sum(min(x, r.n_tokens) for x in n)
        assert r.total_docs == len(n) and r.total_tokens == sum(n)
    limits = [0, 1, 7, 50, 10**7]
    got = {r.context: (r.docs_within, r.docs_cut, r.tokens_kept) for r in token_counts.totals_at(sums, limits).collect()}
    assert got == {c: (sum(x <= c for x in n), sum(x > c for x in n), sum(min(x, c) for x in n)) for c in limits}
    q = {r.share: r.n_tokens for r in token_counts.quantiles(sums, [0.5, 0.9, 1.0]).collect()}
    assert q == {s: min(v for v in n if sum(x <= v for x in n) >= s * len(n)) for s in (0.5, 0.9, 1.0)}
    assert token_counts.with_suffix_sums(token_counts.length_histogram(none, path, P.PATTERN)).count() == 0


def test_pieces_keep_tokens():
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    for _ in range(150):
        t = "".join(rng.choice(["a", "B", " ", "  ", "\n", "'s", "12", "!?", "é", "the"]) for _ in range(rng.randint(0, 120)))
        assert [x for p in token_counts.pieces(t, 9) for x in e.encode_ordinary(p)] == e.encode_ordinary(t)
        runs = re.compile(token_counts._BLANK + "{2,}")
        assert [x for p in token_counts.pieces(t, 9, runs) for x in e.encode_ordinary(p)] == e.encode_ordinary(t)


def test_long_white_space_is_counted(spark):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    n = 5_000_000
    single = lambda s: len(e._encode_single_piece(s.encode()))
    texts = [" " * n + "x", "a" + "\n" * n, "a b" + "\t \u3000" * (n // 3) + "\nc d", " " * token_counts.RUN_CHARS, "\x1f" * 300_000 + "a"]
    want = [single(" " * (n - 1)) + 1, 1 + single("\n" * n), 2 + single("\t \u3000" * (n // 3)) + 3, single(" " * token_counts.RUN_CHARS), len(e.encode_ordinary("\x1f" * 300_000 + "a"))]
    assert [token_counts.count_tokens(t, e) for t in texts] == want
    small = [t[: 3 * token_counts.RUN_CHARS] + "x y" for t in texts]
    assert [token_counts.count_tokens(t, e) for t in small] == [len(e.encode_ordinary(t)) for t in small]
    hist = token_counts.length_histogram(spark.createDataFrame([(t,) for t in texts[:2]], "text string"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    assert {r.n_tokens: r.n_docs for r in hist.collect()} == Counter(want[:2])


# --- lines ---


def _lines(rows, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    key = lambda s: s.strip(" \t\n\x0b\x0c\r").translate(LOW)
    for i, t in rows:
        for s in (t or "").split("\n"):
            if len(key(s)) >= min_chars:
                holders[key(s)].add(_key(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [s for s in lines if not (len(h := holders.get(key(s), ())) >= min_docs and _key(i) != max(h))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup(docs, none, monkeypatch):
    want = _sorted(_lines(ROWS))
    assert sum(r[2] for r in want) > 10
    assert _columns(line_dedup.dedup_lines(docs), "doc_id", "n_lines", "n_dropped", "kept_text") == want
    assert _columns(line_dedup.without_lines(docs).withColumn("text", F.coalesce("text", F.lit(""))), "doc_id", "text") == _sorted((i, t) for i, _, _, t in want)
    assert line_dedup.without_lines(docs).columns == docs.columns
    assert line_dedup.dedup_lines(none).count() == 0


def test_line_dedup_with_a_line_in_most_documents(spark):
    rows = [(k, f"a line that nearly every document has\nown line number {k} of this text\n") for k in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert line_dedup._wide_keys(line_dedup._rows(df), 20, 4)
    assert _columns(line_dedup.dedup_lines(df), "doc_id", "n_lines", "n_dropped", "kept_text") == _sorted(_lines(rows))


# --- archive ---


def test_archive(spark):
    big = "é" * 600
    rows = [(1, "u1", big), (2, "u2\r\nX: y", big), (3, None, "small"), (4, "u", "small"), (5, "u", None), (6, "u", ""), (7, "u", big), (7, "u", big), (None, "u", big), (9, "u", "z" * 999), (10, "u", "z" * 999), (11, "u", "y" * 1000), (12, "u", "y" * 1000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"header": F.lit(1), "sha256": F.lit("q"), "holder": F.lit(2), "payload": F.lit("p")})
    archive = warc.write_archive(df)
    got = warc.read_archive(spark, archive).collect()
    holder = {big: 7, "y" * 1000: 12}
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        revisit = len(b) >= 1000 and i != holder[h]
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", holder[h] if revisit else None))
    assert _sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == _sorted(want)
    assert spark.read.parquet(archive.payloads).count() == len({h or "" for _, _, h in rows})
    for r in got:
        head, block = bytes(r.record).split(b"\r\n\r\n", 1)
        length = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert len(block) == length + 4 and block.endswith(b"\r\n\r\n") and head.startswith(b"WARC/1.1\r\n")
        body = block[:-4].split(b"\r\n\r\n", 1)[1]
        assert body == (bytes(r.payload) if r.record_type == "response" else b"")
    empty = warc.write_archive(df.limit(0))
    assert warc.read_archive(spark, empty).count() == 0


def test_a_spoiled_payload_stops_the_read(spark):
    archive = warc.write_archive(spark.createDataFrame([(1, "u", "hello")], "page_id long, url string, html string"))
    spark.read.parquet(archive.payloads).withColumn("payload", F.lit(b"other")).write.parquet(archive.payloads + "2")
    with pytest.raises(Exception, match="digest"):
        warc.read_archive(spark, warc.Archive(archive.records, archive.payloads + "2")).collect()


def test_an_archive_leaves_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {f for f in disk.getAllFiles().mkString("\n").split("\n") if re.search(r"/shuffle_\d+_\d+_0\.data$", f)}
    before = shuffled()
    warc.write_archive(spark.createDataFrame([(k, "u", f"{k % 5}" * 1200) for k in range(40)], "page_id long, url string, html string"))
    until = time.monotonic() + 10  # files are deleted in the background
    while (left := shuffled() - before) and time.monotonic() < until:
        time.sleep(0.1)
    assert not left


# --- benchmark ---


def _grams(t, n=5):
    w = WORD.findall((t or "").translate(LOW))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_contained_items(spark, docs, none, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rng = random.Random(4)
    items = []
    for k, (_, t) in enumerate(r for r in ROWS if r[1] and 20 < len(r[1].split()) < 400):
        w = t.split()
        a = rng.randrange(len(w) - 12)
        part = w[a : a + rng.randint(5, 40)]
        if k % 2:
            part[rng.randrange(len(part))] = "changed"
        items.append((k, " \n".join(part).translate({v: k for k, v in LOW.items()})))
    items += [(900, None), (901, "only four words here"), (902, ""), (None, items[0][1])]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    want = []
    for d, t in ROWS:
        for i, s in items:
            g = _grams(s)
            if g and 100 * len(g & _grams(t)) >= 80 * len(g):
                want.append((d, i, len(g), len(g & _grams(t))))
    assert len(want) > 10
    assert _columns(decontaminate.contained_items(docs, table), "doc_id", "item_id", "n_shingles", "n_shared") == _sorted(want)
    hit = Counter((d, t) for d, t in ROWS if any(100 * len(_grams(s) & _grams(t)) >= 80 * len(_grams(s)) for _, s in items if _grams(s)))
    assert _columns(decontaminate.clean(docs, table), "doc_id", "text") == _sorted(r for r in ROWS if r not in hit)
    assert decontaminate.clean(docs, table).columns == docs.columns
    assert decontaminate.contained_items(none, table).count() == 0 and decontaminate.contained_items(docs, table.limit(0)).count() == 0


# --- near duplicates ---


def _components(rows, size, percent):
    sets = [(_key(i), frozenset(_grams(t, size)) or (frozenset([tuple(w)]) if (w := WORD.findall((t or "").translate(LOW))) else frozenset())) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, r in sets[:a]:
            if s and r and 100 * len(s & r) >= percent * len(s | r):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    out = lambda x: None if x == _key(None) else x
    return _sorted((out(i), len(s), out(root(i)), root(i) == i) for i, s in sets)


@pytest.mark.parametrize(("size", "percent", "cell"), [(3, 85, 512), (5, 80, 3)])
def test_near_components(docs, none, monkeypatch, size, percent, cell):
    monkeypatch.setattr(near_dedup, "CELL", cell)
    want = _components(ROWS, size, percent)
    assert sum(not r[3] for r in want) > 5
    assert _columns(near_dedup.near_components(docs, size, percent), "doc_id", "n_shingles", "component_id", "kept") == want
    gone = {r[0] for r in want if not r[3]}
    assert _columns(near_dedup.one_per_group(docs, size, percent), "doc_id", "text") == _sorted(r for r in ROWS if r[0] not in gone)
    assert near_dedup.near_components(none).count() == 0


def _sentence(rng, n):
    return " ".join(rng.choice("abcdefgh") + str(rng.randrange(50)) for _ in range(n))


def test_rows_of_one_id_are_one_document(spark, monkeypatch):
    """Repeated and null ids with different texts, each text with near and exact copies elsewhere, over small cells."""
    monkeypatch.setattr(near_dedup, "CELL", 4)
    monkeypatch.setattr(near_dedup, "FOLLOWERS", 3)
    rng = random.Random(12)

    def near(t, k):
        w = t.split()
        for _ in range(k):
            w[rng.randrange(len(w))] = "new" + str(rng.randrange(9))
        return " ".join(w)

    a, b, c, d = (_sentence(rng, 150) for _ in range(4))
    rows = [(1, a), (1, b), (2, near(b, 2)), (9, near(a, 1)), (3, c), (None, c), (None, d), (4, near(d, 2)), (4, ""), (5, near(d, 1)), (6, None), (6, a), (7, ""), (1, a), (1, a)]
    rows += [(None, _sentence(rng, 30)) for _ in range(20)] + [(50, near(c, k % 9)) for k in range(30)] + [(100 + k, near(b, 12 + k % 3)) for k in range(40)] + [(200 + k, a) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for size, percent in ((3, 85), (5, 80), (1, 90)):
        want = _components(rows, size, percent)
        assert _columns(near_dedup.near_components(df, size, percent), "doc_id", "n_shingles", "component_id", "kept") == want


@pytest.mark.parametrize("percent", [80, 85])
def test_pairs_at_the_threshold_share_a_band(percent):
    """Recall of the bands and the sketch floor on random pairs at the threshold, against their exact similarity."""
    rng = np.random.default_rng(percent)
    bands, rows = near_dedup.bands_for(percent)
    missed = below = 0
    for _ in range(600):
        union = int(rng.integers(40, 400))
        common = -(-percent * union // 100)
        pool = rng.integers(0, 2**63, union, dtype=np.uint64)
        cut = common + (union - common) // 2
        a, b = np.sort(pool[:cut]), np.sort(np.concatenate([pool[:common], pool[cut:]]))
        assert near_dedup._near(a, b, percent)
        s = near_dedup.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        same = (s[0] == s[1])[: bands * rows].reshape(bands, rows).all(axis=1)
        missed += not same.any()
        below += ((s[0] & 255) == (s[1] & 255)).sum() < near_dedup.floor_for(percent)
    assert missed == below == 0


def test_signatures_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    shares = []
    for _ in range(40):
        a, b = np.sort(pool[:700]), np.sort(pool[300:1000])  # Jaccard 0.4
        rng.shuffle(pool)
        s = near_dedup.signatures(np.concatenate([a, b]), np.array([0, 700, 1400]))
        shares.append((s[0] == s[1]).mean())
    assert abs(np.mean(shares) - 0.4) < 0.02
    for percent in (80, 85):
        bands, rows = near_dedup.bands_for(percent)
        assert (1 - (percent / 100) ** rows) ** bands < 1e-8


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(200, 260)] + [(259, 3), (3, 3), (140, 100)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 100 for k in range(101, 141)}, **{k: 3 for k in range(200, 260)}, 7: 3}


# --- substrings ---


def _repeats(rows, length=100):
    first, out = {}, []
    data = sorted(((_key(i), (t or "").encode()) for i, t in rows), key=lambda r: r[0])
    for i, b in data:
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            first[w] = min(first.get(w, (i, p)), (i, p))
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < (i, p):
                gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((None if i == _key(None) else i, len(b), sum(gone), spans, _sha(kept)))
    return _sorted(out)


def test_segments_hold_every_window_once(monkeypatch):
    monkeypatch.setattr(substring_dedup, "SEGMENT", 1 << 11)
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (9000, 99, 100, 2147, 2148, 0)]
    seen = defaultdict(list)
    for k, t in enumerate(texts):
        batch = pa.RecordBatch.from_arrays([pa.array([k]), pa.array([k]), pa.array([0]), pa.array([t])], ["doc_id", "tag1", "tag2", "text"])
        for out in substring_dedup._parse([batch]):
            for doc, place in zip(out.column(2).to_pylist(), out.column(5).to_pylist(), strict=True):
                seen[doc] += range(place >> 16, (place >> 16) + (place & 255) + 1)
    assert all(sorted(seen[k]) == list(range(len(t) - 99)) for k, t in enumerate(texts))


@pytest.mark.parametrize("array", [1, 700, 1 << 19])
def test_suffix_arrays_of_whole_grams(monkeypatch, array):
    monkeypatch.setattr(substring_dedup, "ARRAY_BYTES", array)
    rng, rows = random.Random(9), []
    for gram in range(12):
        base = "".join(rng.choice("ab" + chr(99 + gram)) for _ in range(180))
        for _ in range(rng.randint(1, 7)):
            a = rng.randint(0, 40)
            rows.append((gram, rng.randrange(5), 1, 2, rng.randrange(400), chr(99 + gram).encode() + base[a : a + rng.randint(100, 140)].encode()))
    first = {}
    places = [(r, r[1], r[4] + k, r[5][k : k + 100]) for r in rows for k in range(len(r[5]) - 99)]
    for _, doc, at, w in places:
        first[w] = min(first.get(w, (doc, at)), (doc, at))
    want = sorted((doc, at) for _, doc, at, w in places if first[w] < (doc, at))
    names = ["gram", "doc_id", "tag1", "tag2", "start", "phrase"]
    for cut in (1, 3, 100):
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[k : k + cut], strict=True)], names) for k in range(0, len(rows), cut)]
        got = [(d, (p >> 16) + k) for out in substring_dedup._suffix_arrays(batches) for d, p in zip(out.column(0).to_pylist(), out.column(3).to_pylist(), strict=True) for k in range((p & 255) + 1)]
        assert sorted(got) == want and len(want) > 100
    assert list(substring_dedup._suffix_arrays([])) == []


def test_suffix_ranks_are_the_byte_order():
    rng = np.random.default_rng(2)
    for alphabet in (2, 3, 256):
        data = rng.integers(0, alphabet, 1500).astype(np.uint8)
        data[700:1000] = data[100:400]
        starts = np.sort(rng.choice(1400, 900, replace=False))
        strings = [data[p : p + 100].tobytes() for p in starts.tolist()]
        place = {x: k for k, x in enumerate(sorted(set(strings)))}
        assert substring_dedup.suffix_ranks(data, starts).tolist() == [place[x] for x in strings]


@pytest.mark.parametrize(("segment", "group", "array"), [(1 << 22, 4096, 1 << 19), (1 << 22, 2, 1 << 19), (1 << 22, 0, 1), (1 << 11, 4096, 300)])
def test_substring_dedup(spark, docs, none, segment, group, array, monkeypatch):
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    monkeypatch.setattr(substring_dedup, "ARRAY_BYTES", array)
    rng = random.Random(8)
    passage = "".join(rng.choice("abcd ") for _ in range(260))
    extra = [(900 + k, "".join(rng.choice("wxyz ") for _ in range(rng.randint(0, 90))) + passage[rng.randint(0, 80) : rng.randint(150, 260)] + f"{k}" * rng.randint(0, 120)) for k in range(14)]
    rows = [r for r in ROWS if r[0] != 801] + extra + [(950, "ab" * 200), (951, "q" * 99), (952, "q" * 100), (953, "é" * 90)]
    # rows that share an id (or have none) with one passage at one place, which also stands before, and copies of such rows
    for i in (None, 905):
        rows += [(i, "." + passage), (i, passage + " and one"), (i, passage + " or other"), (i, passage + " or other"), (i, "w" + passage[:200] + "v" * 99)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({k: F.lit(v) for k, v in CLASH.items()}).repartition(3)
    df = df if segment > 1 << 12 else df.filter("length(text) > 3000 or doc_id > 940")
    rows = rows if segment > 1 << 12 else [r for r in rows if len(r[1] or "") > 3000 or (r[0] or 0) > 940]
    old = substring_dedup.SEGMENT
    substring_dedup.SEGMENT = segment
    try:
        assert _columns(substring_dedup.drop_repeats(df), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == _repeats(rows)
    finally:
        substring_dedup.SEGMENT = old
    assert substring_dedup.drop_repeats(none).count() == 0


def test_large_grams_look_no_text_up_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(substring_dedup, "GROUP", 2)
    rng = random.Random(4)
    passage = "".join(rng.choice("abcd ") for _ in range(160))
    rows = [(k, "".join(rng.choice("wxyz ") for _ in range(rng.randint(0, 300))) + passage[rng.randint(0, 40) :] + f"{k % 7}" * rng.randint(0, 150)) for k in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/source")
    read, mapped = {}, substring_dedup.map_arrow

    def noted(df, run, schema):
        read[run.__name__] = any("/source/" in f for f in df.inputFiles())
        return mapped(df, run, schema)

    monkeypatch.setattr(substring_dedup, "map_arrow", noted)
    got = substring_dedup.drop_repeats(spark.read.parquet(f"{tmp_path}/source"))
    assert _columns(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == _repeats(rows)
    assert read == {"_parse": True, "_phrases": True, "_suffix_arrays": False, "_split": False, "_windows": False, "_cut": True}


# --- shards ---


def _sharded(rows, shards, seed, buckets):
    """(doc_id, text, shard, slot) of every record by a plain external shuffle."""
    import struct

    import xxhash

    def tag(i, t):
        h = xxhash.xxh64_intdigest(struct.pack("<i", seed), 42)
        h = h if i is None else xxhash.xxh64_intdigest(struct.pack("<q", i), h)
        h = h if t is None else xxhash.xxh64_intdigest(t.encode(), h)
        return h - (h >> 63 << 64)

    held = defaultdict(list)
    for i, t in rows:
        held[tag(i, t) % buckets].append((tag(i, t), i is None, i or 0, t))
    out = []
    for b in sorted(held):
        records = sorted(held[b], key=lambda r: r[:3])
        high = np.arange(1, len(records) + 1)
        draws = np.random.Generator(np.random.PCG64([seed, b])).integers(0, high)
        for k in range(len(records))[:0:-1]:
            records[k], records[draws[k]] = records[draws[k]], records[k]
        out += records
    n, laid = len(out), []
    for p, (_, null, i, t) in enumerate(out):
        s = p * shards // n
        laid.append((None if null else i, t, s, p - min(q for q in range(p + 1) if q * shards // n == s)))
    return _sorted(laid)


@pytest.mark.parametrize(("bucket", "most"), [(1 << 24, 20_000), (4000, 20_000), (4000, 3)])
def test_shards(docs, none, bucket, most, monkeypatch):
    monkeypatch.setattr(sharding, "MOST", most)
    rows = sharding.external_shuffle(docs, 7, bucket_bytes=bucket).collect()
    assert _sorted((r.doc_id, r.text) for r in rows) == _sorted(ROWS)
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
        assert r.size == 16 + len((r.text or "").encode())
    counts = [len(by[s]) for s in range(7)]
    assert max(counts) - min(counts) <= 1 and all(sorted(v) == list(range(len(v))) for v in by.values())
    again = {(r.shard, r.slot): (r.doc_id, r.text) for r in sharding.external_shuffle(docs.repartition(2), 7, bucket_bytes=bucket).collect()}
    assert again == {(r.shard, r.slot): (r.doc_id, r.text) for r in rows}
    assert {(r.shard, r.slot): r.doc_id for r in sharding.external_shuffle(docs, 7, seed=1, bucket_bytes=bucket).collect()} != {(r.shard, r.slot): r.doc_id for r in rows}
    assert sharding.external_shuffle(none, 7).count() == 0


def test_shards_like_a_plain_shuffle(spark, docs):
    got = sharding.external_shuffle(docs, 7)
    assert _columns(got, "doc_id", "text", "shard", "slot") == _sharded(ROWS, 7, 42, sharding.FEWEST)
    few = [r for r in ROWS if r[0] not in (800, 801)]
    total = sum(8 + 8 + len((t or "").encode()) for _, t in few)
    df = spark.createDataFrame(few, "doc_id long, text string").repartition(3)
    assert _columns(sharding.external_shuffle(df, 5, seed=9, bucket_bytes=700), "doc_id", "text", "shard", "slot") == _sharded(few, 5, 9, max(sharding.FEWEST, -(-total // 700)))


def test_a_record_in_very_many_copies_is_dealt_to_many_buckets(spark, tmp_path):
    rows = [(None, "the same record " * 20)] * 3000 + [(k, f"record {k}") for k in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sharding.external_shuffle(df, 40)
    runs = sorted((r.shard, r.slot, r.doc_id is None) for r in got.select("shard", "slot", "doc_id").collect())
    assert _sorted((r.doc_id, r.text) for r in got.collect()) == _sorted(rows) and len({s for s, _, copy in runs if copy}) == 40
    sharding.write_shards(got, f"{tmp_path}/shards")
    assert spark.read.parquet(f"{tmp_path}/shards").filter("shard = 3").count() == sum(s == 3 for s, _, _ in runs)


def test_crc(spark):
    t = "é\x00z"
    assert spark.createDataFrame([(t,)], "t string").select(F.crc32(F.col("t").cast("binary")).alias("c")).first().c == zlib.crc32(t.encode())


# --- quality ---


def _stats(t):
    t = t or ""
    w = WORD.findall(t)
    grams = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    cover = {p for k in range(len(w) - 7) if grams[tuple(w[k : k + 8])] > 1 for p in range(k, k + 8)}
    lines = t.split("\n")
    seen, dups = set(), 0
    for s in lines:
        if WORD.search(s):
            dups += s in seen
            seen.add(s)
    s = dict(n_words=len(w), word_chars=sum(map(len, w)), n_symbols=len(re.findall(r"[#*$%&|<>]", t)), n_lines=len(lines), n_dup_lines=dups, n_repeat_words=len(cover))
    n = s["n_words"]
    base = n < 20 or 100 * s["n_repeat_words"] > 30 * n
    good = 10 * s["n_symbols"] <= n and 3 * n <= s["word_chars"] <= 12 * n and 2 * dups <= len(lines)
    m = _more_stats(t)
    good = good and 2 * m["n_upper_words"] <= n and 5 * m["n_exclamations"] <= n and 10 * m["n_alpha_words"] >= 8 * n
    good = good and 10 * m["n_bullet_lines"] <= 9 * m["n_word_lines"] and 10 * m["n_ellipsis_lines"] <= 3 * m["n_word_lines"]
    good = good and (m["n_top_bigram"] < 5 or 10 * m["n_top_bigram"] <= n) and (n < 50 or m["n_function_words"] > 0)
    return (*s.values(), base, not base and good)


def _more_stats(t):
    w = WORD.findall(t or "")
    lines = [s for s in (t or "").split("\n") if WORD.search(s)]
    return dict(
        n_upper_words=sum(bool(re.search("[A-Z]", x)) and not re.search("[a-z]", x) for x in w),
        n_exclamations=(t or "").count("!"),
        n_alpha_words=sum(bool(re.search("[A-Za-z\x80-\U0010ffff]", x)) for x in w),
        n_word_lines=len(lines),
        n_bullet_lines=sum(WORD.findall(s)[0][0] in "-*•" for s in lines),
        n_ellipsis_lines=sum(WORD.findall(s)[-1].endswith(("...", "…")) for s in lines),
        n_top_bigram=max(Counter(zip(w, w[1:], strict=False)).values(), default=0),
        n_function_words=sum(x.translate(LOW) in quality.FUNCTION_WORDS for x in w),
    )


JUNK = [
    "LOUD WORDS!! ÉÀ!! " * 12, "- one\n  • two\n* three\n" * 9, "well... \nso…\t\nand ...\r\n" * 8, "12 34 == -- " * 9 + "word", "a b " * 30 + " ".join(f"w{k}" for k in range(40)), " ".join(f"xq{k}" for k in range(60)),
    "The of AND\x00 the\x00 " + " ".join(f"xq{k}" for k in range(60)), "!", "…", ".. ...", "-", "\n\n-\n", "A", "é É", "…a", "a…", "•", "x" * 9 + " the",
]


def test_statistics_of_rules():
    texts = [t for _, t in ROWS] + JUNK
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    rng = random.Random(3)
    for size in (60, 5000, 1 << 20):
        at = 0
        for part in W.blocks(batch, size=size):
            stats = quality.TextStats(part.column(0))
            own = texts[at : at + part.num_rows]
            at += part.num_rows
            half = sorted(rng.sample(range(len(own)), rng.randint(0, len(own))))
            for seen, of in ((stats, own), (quality.TextStats(part.column(0)).take(np.array(half, np.int64)), [own[k] for k in half]), (stats.take(np.array(half, np.int64)), [own[k] for k in half])):
                want = [_more_stats(t) for t in of]
                for name in _more_stats(""):
                    assert getattr(seen, name).tolist() == [m[name] for m in want], name
                for name, k in (("n_words", 0), ("n_symbols", 2), ("n_lines", 3), ("n_dup_lines", 4), ("n_repeat_words", 5)):
                    assert getattr(seen, name).tolist() == [_stats(t)[k] for t in of], name


def test_rules_run_on_what_is_left(spark):
    rng = random.Random(8)
    good = " ".join(f"the w{rng.randrange(900)}" for _ in range(60))
    rows = [(k, t * 4 if len(t) > 20 else t) for k, t in enumerate(JUNK)] + [(100 + k, good) for k in range(20)] + [(None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    every = quality.BASE_RULES + quality.RULES
    plain = {k: [not _stats(t)[-1]] for k, t in rows}
    for order in (every, every[::-1], quality.plan_order(df, every)):
        got = quality.cascade(df, order, runs="ran").collect()
        assert {r.doc_id: [not r.kept] for r in got} == plain
        assert all(r.ran == len(every) for r in got if r.kept) and sum(r.ran for r in got) < len(every) * len(rows)
        assert all(r.ran >= 1 for r in got)
    op8 = quality.cascade(df, quality.RULES, quality.STATS, quality.BASE_RULES, runs="ran").collect()
    assert all((r.ran == 0) == r.base_failed for r in op8)


def test_order_by_conditional_rejections():
    # rule 0 rejects a and b, rule 1 rejects b and c, rule 2 rejects b only: behind rule 1, rule 2 has nothing left
    assert quality.best_order({0b001: 5, 0b111: 10, 0b010: 8, 0: 100}, [1.0, 1.0, 0.9]) == [1, 0, 2]
    assert quality.best_order({0b001: 5, 0b111: 10, 0b010: 8, 0: 100}, [1.0, 1.0, 0.1]) == [2, 1, 0]
    assert quality.best_order({}, [0.3, 0.1]) == [1, 0]


def test_quality(docs, none):
    want = _sorted((i, *_stats(t)) for i, t in ROWS)
    rules = quality.plan_order(docs, quality.RULES)
    got = quality.cascade(docs, rules, quality.STATS, quality.BASE_RULES)
    assert _columns(got, "doc_id", *quality.STATS, "base_failed", "kept") == want
    every = quality.BASE_RULES + quality.RULES
    for order in (every, every[::-1], quality.plan_order(docs, every)):
        plain = quality.cascade(docs.drop("kept"), order)
        assert _columns(plain, "doc_id", "kept") == _sorted((r[0], r[-1]) for r in want)
        assert plain.columns == [*docs.drop("kept").columns, "kept"]
    assert quality.cascade(none, quality.plan_order(none, every)).count() == 0


# --- encoding ---


def test_encoding(docs, none):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    want = []
    for i, text in ROWS:
        e = t.encode(text or "", add_special_tokens=False)
        want.append((i, len(e.ids), _sha(np.array(e.ids, "<u4").tobytes()), _sha(t.decode(e.ids, skip_special_tokens=False))))
    got = bpe.encode(docs, path, ("n_tokens", "ids_sha256", "decoded_sha256", "ids"))
    assert _columns(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == _sorted(want)
    assert bpe.encode(none, path).count() == 0


def test_tree_concatenation():
    path = P.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    small = bpe.Codec(path, leaf=16, cache_words=50)
    rng = random.Random(9)
    kinds = ["abcdefgh", "aé́'std'rellvm", "01a-_.<|>'", "a", "漢字🎉x", "<|endoftext|>ab"]
    for _ in range(400):
        s = "".join(rng.choice(rng.choice(kinds)) for _ in range(rng.choice([1, 20, 90, 300])))
        assert small.encode_unsplit(s) == t.encode(s, add_special_tokens=False).ids
        ids, decoded = small.encode(s + " \x85 " + s[::-1])
        e = t.encode(s + " \x85 " + s[::-1], add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == e and decoded == t.decode(e, skip_special_tokens=False)


def test_a_megabyte_without_a_space():
    path = P.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    t, codec, rng = Tokenizer.from_file(path), bpe.Codec(path), random.Random(4)
    for alphabet, n in (("abcdeéñ'漢01", 1_000_000), ("a", 300_000), ("the're", 200_000), ("e\u0301", 100_000), ("!?", 100_000), ("\x1f\u00a0ab", 100_000)):
        s = "".join(rng.choice(alphabet) for _ in range(n))
        assert codec.encode_unsplit(s) == t.encode(s, add_special_tokens=False).ids


def test_long_words_go_through_the_tree(spark, tmp_path):
    from tokenizers import Tokenizer

    from vestigo.llm import queries as Q

    path, rng = P.path("word_bpe_49k.json"), random.Random(6)
    word = lambda n: "".join(rng.choice(["ab", "the", "é", "<|endoftext|>", "'ll", "9", "漢", "-", "\x00"]) for _ in range(n))
    texts = [" ".join(word(rng.randint(1, 40)) for _ in range(30)) for _ in range(40)] + [word(9000), word(3) + "\n" + word(9000), "x" * 16, "x" * 17, None, ""]
    codec = bpe.Codec(path)
    long = {w for t in texts for w in (t or "").encode().split() if len(w) > bpe.LEAF_BYTES}
    codec.encode_block(pa.array(texts))
    assert codec.trees == len(long) > 500
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    t = Tokenizer.from_file(path)
    want = []
    for i, x in enumerate(texts):
        ids = t.encode(x or "", add_special_tokens=False).ids
        want.append((i, len(ids), _sha(np.array(ids, "<u4").tobytes()), _sha(t.decode(ids, skip_special_tokens=False))))
    assert _columns(Q.op9_bpe(spark, str(tmp_path)), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == _sorted(want)


def test_a_full_table_changes_nothing():
    path, rng = P.path("word_bpe_49k.json"), random.Random(7)
    texts = [" ".join(f"w{rng.randrange(3000)}x{'y' * rng.randrange(30)}" for _ in range(60)) for _ in range(40)]
    big = bpe.Codec(path)
    for small in (bpe.Codec(path, cache_words=10), bpe.Codec(path, cache_bytes=100)):
        for t in texts:
            assert small.encode(t) == big.encode(t)
    table = bpe._Table()
    table.slot = table.slot[:8].copy()
    for k in range(200):  # the slots grow with the entries
        made = table.add([[k]])
        table.put(made, np.array([k], np.uint64), np.array([7], np.uint64), np.array([1]))
    assert table.find(np.arange(220, dtype=np.uint64), np.full(220, 7, np.uint64), np.ones(220, np.int64)).tolist() == [*range(200), *[-1] * 20]


def test_neighbouring_tokens_decide_an_encoding():
    """Why one agreed token inside a split is enough: a run of letters is the encoding of its text pair by pair."""
    from tokenizers import Tokenizer

    t, rng = Tokenizer.from_file(P.path("word_bpe_49k.json")), random.Random(3)
    for _ in range(300):
        s = "".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 40)))
        e = t.encode(s, add_special_tokens=False)
        for (a, _), (_, b) in zip(e.offsets, e.offsets[1:], strict=False):
            inner = t.encode(s[a:b] + s[b:], add_special_tokens=False)
            assert inner.offsets[0][1] + a == next(y for x, y in e.offsets if x == a)


@pytest.mark.parametrize("percent", [80, 85])
def test_sketches_of_pairs_at_the_threshold_agree_enough(percent):
    q, n, k = percent / 100, near_dedup.COORDINATES, near_dedup.floor_for(percent)
    below = lambda k: sum(math.comb(n, x) * q**x * (1 - q) ** (n - x) for x in range(k))
    assert below(k) < 1e-8 <= below(k + 1)
    # one pair in one cell, whose sketches agree in just as many coordinates
    same, sketch = np.arange(100, dtype=np.uint64), np.zeros((2, n), np.uint8)
    sketch[1, k:] = 1
    rows = {"doc": np.array([1, 2]), "comp": np.array([1, 2]), "chunk": np.array([0, 0]), "cell": (0, 0), "band": 0, "bands": np.zeros((2, 20), np.int64), "sketch": sketch, "sets": [same, same[: percent]]}
    assert near_dedup._cell_links(rows, percent, 20) == [(1, 2)]


# --- pseudonyms ---


def _luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if k % 2 == 0 else 2 * x - 9 * (x > 4) for k, x in enumerate(d)) % 10 == 0


def test_pseudonyms(spark, none):
    rows = [
        (1, "call +1 (743) 555-3824 or +1-743-555-3824, card 4111 1111 1111 1111 or 4111111111111111."), (2, "bad 4111111111111112, 300.1.1.1, 2023-02-29, 000-12-3456, 1.2.3.4.5"),
        (3, "Hein.19@mail5.example.com hein.19@mail5.example.com 10.0.0.1 2024-02-29 29/02/2024 29.02.2024 123-45-6789"), (4, None), (5, ""), (6, "plain"), (None, "card 4111111111111111"), (1, "card 4111111111111111"),
        (7, "b" * 50_000 + " 10.0.0.1 " + "1" * 50_000),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"pii": F.lit(1), "pii_found": F.lit(2), "pii_key": F.lit("mine")})
    assert {(r.pii_found, r.pii_key) for r in pii.pseudonymise(df, "k").collect()} == {(2, "mine")}
    out = pii.pseudonymise(df, "k").cache()
    by = defaultdict(list)
    for r in out.collect():
        by[r.doc_id].append(r)
    assert by[2][0].text == rows[1][1] and by[2][0].pii == [] and by[4][0].text is None and by[5][0].text == "" and by[6][0].text == "plain"
    one = next(r for r in by[1] if len(r.pii) == 4)
    values = [p.value for p in one.pii]
    assert re.sub(r"\D", "", values[0]) == re.sub(r"\D", "", values[1]) != "17435553824" and values[2].replace(" ", "") == values[3] != "4111111111111111"
    assert _luhn(values[3]) and re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", values[0]) and re.fullmatch(r"\d{4} \d{4} \d{4} \d{4}", values[2])
    assert by[None][0].text == "card " + values[3]
    three = [p.value for p in by[3][0].pii]
    assert three[0].lower() == three[1] and three[0][0].isupper() and three[1].endswith("@mail5.example.com") and len(three[1]) == len("hein.19@mail5.example.com")
    y, m, d = three[3].split("-")
    assert three[4] == f"{d}/{m}/{y}" and three[5] == f"{d}.{m}.{y}" and re.fullmatch(r"\d{3}-\d\d-\d{4}", three[6])
    back = pii.pseudonymise(out, "k", back=True)
    assert _columns(back, "doc_id", "text") == _sorted(rows)
    assert pii.pseudonymise(df, "other").filter("doc_id = 1").first().text != one.text
    assert pii.pseudonymise(none, "k").count() == 0


def test_cards_beside_other_numbers(spark):
    card, other = "4111 1111 1111 1111", "5500-0000-0000-0004"
    kept = ["{} 123", "{} 12/26", "{} 12", "7 {}", "12345 {}", "12 34 56 78 90 {} 123", "{} 12a", "{}", "{} 2024-13-15"]
    texts = [k.format(c) for k in kept for c in (card, card.replace(" ", ""), card.replace(" ", "-"))]
    texts += [f"{card} {other} 99", f"{card} 123-45-6789", f"{card} 2024-01-15", f"{card} 10.0.0.1", f"{card} 12@mail5.example.com", "4111 1111 1111 1112 123", "1" * 25, "12 34 " * 3000 + card]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = pii.pseudonymise(df, "k").cache()
    got = {r.doc_id: r for r in out.collect()}
    new = got[texts.index(card)].text
    digits = lambda s: re.sub(r"\D", "", s)
    assert new != card and _luhn(new)
    for i, k in enumerate(kept):
        for j, sep in enumerate((" ", "", "-")):
            r = got[3 * i + j]
            assert r.text == k.format(new.replace(" ", sep)) and [(p.kind, digits(p.value)) for p in r.pii] == [("card", digits(new))], r
    n = 3 * len(kept)
    two = [p.value for p in got[n].pii]
    assert two[0] == new and two[1] != other and _luhn(two[1]) and got[n].text == f"{new} {two[1]} 99"
    assert [[p.kind for p in got[n + k].pii] for k in range(1, 5)] == [["card", x] for x in ("ssn", "date", "ipv4", "email")]
    assert all(got[n + k].text.startswith(new + " ") for k in range(1, 5))
    assert got[n + 5].text == texts[n + 5] and got[n + 6].text == texts[n + 6] and got[n + 7].text.endswith(new)
    back = {r.doc_id: r.text for r in pii.pseudonymise(out, "k", back=True).collect()}
    assert [back[i] for i in range(n + 5)] == texts[: n + 5]


def test_permutations_are_bijections(spark):
    for size in (1, 2, 3):
        m = spark.range(10**size).select(F.lpad(F.col("id").cast("string"), size, "0").alias("m"))
        assert m.select(F.expr(pii.permute_digits("m", "'t'", "'k'"))).distinct().count() == 10**size
    letters = spark.range(26 * 26).select(F.concat(F.chr(97 + F.floor(F.col("id") / 26)), F.chr(97 + F.col("id") % 26)).alias("m"))
    assert letters.select(F.expr(pii._permute_letters("m", "'t'", "'k'"))).distinct().count() == 676
    days = spark.range(0, 146097).select(F.expr("date_format(date_add(date'1800-01-01', cast(id as int)), 'yyyy-MM-dd')").alias("m"))
    assert days.select(F.expr(pii._date("m", "'k'", False)).alias("z")).distinct().count() == 146097
    american = spark.range(0, 146097).select(F.expr("date_add(date'1800-01-01', cast(id as int))").alias("d")).filter("day(d) > 12").select(F.date_format("d", "MM/dd/yyyy").alias("m"))
    made = american.select("m", F.expr(pii._date("m", "'k'", False)).alias("z"))
    assert made.select("z").distinct().count() == made.count() == 221 * 400 + 97
    assert made.filter(F.expr(pii._date("z", "'k'", True)) == F.col("m")).filter("int(substr(z, 4, 2)) > 12").count() == 221 * 400 + 97
