"""The stages over rows with nulls, empties, repeats, long texts and clashing columns, against a plain version."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import CLASH, _components, _grams, _lines, _sorted, _stats

P = pytest.importorskip("public_tokenizers")
CLASHING = {**CLASH, "__kept": 1.5, "n_symbols": "y", "base_failed": 8, "label": "z", "node": 9, "n_shingles": "m", "mark1": "h", "line": "l", "key": "k"}


def _rows():
    rng = random.Random(21)
    words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{k}" for k in range(300)]
    prose = lambda n: " ".join(["the"] + [rng.choice(words) for _ in range(n)])
    shared = [prose(9) for _ in range(2)]
    rows = [(k, f"{prose(40)}\n{shared[k % 2]}\n{prose(10)}") for k in range(12)]
    base, passage = prose(120), prose(60)
    rows += [(50 + k, base + " " + prose(k)) for k in range(5)] + [(70, rows[3][1]), (71, prose(30) + " " + passage + " " + prose(9)), (72, passage[: len(passage) // 2] + " " + prose(30))]
    rows += [(80, None), (81, ""), (82, " \n\t"), (83, "LOUD!! WORDS!! " * 30), (84, "a | b | c | " * 20), (85, (prose(4000) + "\n") * 1), (86, "x" * 60_000 + " " + prose(30))]
    rows += [(None, base), (None, prose(50)), (None, None), (7, rows[7][1]), (7, prose(45)), (90, base), (90, prose(44))]
    return rows, [(0, passage), (1, None), (2, "too few words"), (None, prose(30))]


def test_stages_against_a_plain_version(spark, tmp_path):
    rows, items = _rows()
    spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)).write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({k: F.lit(v) for k, v in CLASHING.items()}).repartition(3)
    names, extra = docs.columns, sorted(CLASHING)
    grams = [g for g in (_grams(t) for _, t in items) if g]

    def near(now):
        kept = {i for i, _, _, k in _components(now, 5, 80) if k}
        return [r for r in now if r[0] in kept or r[0] is None]

    plain = [lambda now: [r for r in now if _stats(r[1])[-1]], lambda now: [(i, t) for i, _, _, t in _lines(now)], near, lambda now: [r for r in now if not any(100 * len(g & _grams(r[1])) >= 80 * len(g) for g in grams)]]
    now = rows
    for (name, stage), law in zip(corpus_pipeline.STAGES[:-1], plain, strict=True):
        before, now = len(now), law(now)
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == names, name
        found = docs.collect()
        assert _sorted((r.doc_id, r.text) for r in found) == _sorted(now), name
        assert all([r[k] for k in extra] == [CLASHING[k] for k in extra] for r in found) and all(r.n_chars == len(r.text) for r in found), name
        assert name == "line_dedup" or len(now) < before, name
        docs = spark.createDataFrame(found, docs.schema)
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path(corpus_pipeline.VOCABULARY))
    got = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert _sorted((r.doc_id, tuple(r.ids), r.n_tokens) for r in got) == _sorted((i, tuple(ids), len(ids)) for i, x in now for ids in [t.encode(x, add_special_tokens=False).ids])


@pytest.mark.parametrize("text", [None, "", " \n"])
def test_stages_take_anything(spark, tmp_path, text):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for rows in ([], [(None, text, None, None, None)] * 3 + [(1, text, None, None, 0)]):
        docs = spark.createDataFrame(rows, schema)
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            got = stage(spark, docs, str(tmp_path))
            assert got.count() == (0 if k == 0 else len(rows)), name
            assert k == 4 or _sorted(got.select("doc_id", "text").collect()) == ([] if k == 0 else _sorted((r[0], r[1]) for r in rows)), name


def test_run_of_an_empty_table(spark, tmp_path):
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "lang", "source", "n_tokens", "ids"] and got.count() == 0
