"""The subpackage's queries against DuckDB, and the pipeline against a plain version, on the smallest tables."""

import os
import re
from collections import defaultdict

import duckdb
import pytest

import corpus_pipeline
from tests.llm.test_operators import WORD, _components, _grams, _lines, _stats
from vestigo.llm import queries as Q

P = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query(spark, name):
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = c.execute(Q.ORACLES[name])
    names = [d[0] for d in found.description]
    df = Q.QUERIES[name](spark, SF)
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect()), key=repr) == sorted(found.fetchall(), key=repr)


def test_pseudonym_query_leaves_clean_documents_out(spark):
    rows = Q.op10_pii(spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    mail = re.compile(r"[\w.]+@mail\d+\.example\.com")
    assert {i for i, t in texts.items() if mail.search(t)} <= {r.doc_id for r in rows}
    assert all(r.text != texts[r.doc_id] and not set(mail.findall(r.text)) & set(mail.findall(texts[r.doc_id])) for r in rows)


def test_pipeline(spark):
    from tokenizers import Tokenizer

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [d for d in docs if _stats(d[1])[-1]]
    docs = [(i, t) for i, _, _, t in _lines(docs)]
    kept = {i for i, _, _, k in _components(docs, 5, 80) if k}
    docs = [d for d in docs if d[0] in kept]
    grams = [g for g in map(_grams, items) if g]
    docs = [(i, t) for i, t in docs if not any(100 * len(g & _grams(t)) >= 80 * len(g) for g in grams)]
    t = Tokenizer.from_file(P.path(corpus_pipeline.VOCABULARY))
    want = {i: t.encode(x, add_special_tokens=False).ids for i, x in docs}
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(20), SF).columns == docs.columns
    assert WORD.findall("a b") and defaultdict(int)[1] == 0
