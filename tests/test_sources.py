import io
import os
import tracemalloc
import zipfile

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tests.lots import records
from vestigo import schemas
from vestigo.operators import detect, jobs
from vestigo.plans import more, queries as plans  # noqa: F401
from vestigo.sources import files as S
from vestigo.sources import records as R
from vestigo.streaming import ingest


def _zip(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)
    return out.getvalue()


DOCX = _zip({"word/document.xml": "<w:p>assinado por ANA &amp; BIA</w:p><w:p>a<w:tab/>b<w:br/>c</w:p>", "word/media/i.png": b"x", "word/media/a.txt": b"x"})
PPTX = _zip({"ppt/slides/slide2.xml": "<a:p>dois</a:p>", "ppt/slides/slide1.xml": "<a:p>um</a:p>"})


def test_tree(spark, tmp_path):
    for name, data in {
        "a/contrato.pdf": b"x", "a/~$rascunho.docx": b"x", "b/.oculto": b"x", "b/x.pdf:Zone.Identifier": b"x", "_x.pdf": b"x", ".d/y.pdf": b"x", "vazio.pdf": b"", "B/planilha.xlsx": b"x",
        "c/lote.zip": _zip({"interno/i.pdf": b"x", "outro.zip": _zip({"j.pdf": b"x"})}), "c/ruim.zip": b"no zip", "c/lote2": b"file", "c/lote2.zip": _zip({"k.pdf": b"x"}),
    }.items():
        os.makedirs(tmp_path / os.path.dirname(name), exist_ok=True)
        (tmp_path / name).write_bytes(data)
    done = {e.source: e for e in S.expand_zips(str(tmp_path))}
    assert done["c/lote.zip"].files == 2 and done["c/lote/outro.zip"].files == 1 and done["c/ruim.zip"].error and done["c/lote2.zip"].target == "c/lote2__zip"
    assert all(e.existed for e in S.expand_zips(str(tmp_path)) if not e.error)
    rows = {r.arquivo: r for r in S.list_documents(spark, str(tmp_path)).collect()}
    assert {"_x.pdf", ".d/y.pdf", "vazio.pdf", "c/lote/interno/i.pdf", "c/lote/outro/j.pdf", "c/lote2__zip/k.pdf"} <= set(rows)
    assert not any("~$" in p or "oculto" in p or "Zone" in p for p in rows) and rows["vazio.pdf"].tamanho_bytes == 0 and rows["c/lote2"].formato == "(sem extensão)"
    z = {r.arquivo: (r.status, r.erro_tipo, r.retentavel) for r in S.zip_records(spark, list(done.values())).collect()}
    assert z["c/lote.zip"] == ("container", None, False) and z["c/ruim.zip"] == ("erro", "ZipInvalidoError", False)


def test_packages(spark):
    df = spark.createDataFrame([("d", ".docx", bytearray(DOCX)), ("p", ".PPTX", bytearray(PPTX)), ("x", ".docx", bytearray(b"bad"))], "arquivo string, formato string, conteudo binary")
    got = {r.arquivo: r for r in S.packages(df).collect()}
    assert got["d"].texto == "assinado por ANA & BIA\na\tb\nc\n" and got["d"].midias == 1 and got["p"].texto == "um\n\ndois\n" and got["x"].erro
    m = {r.membro for r in S.zip_members(df.filter("arquivo = 'p'")).collect()}
    assert m == {"ppt/slides/slide1.xml", "ppt/slides/slide2.xml"}


def test_damaged_checkpoint(spark, tmp_path):
    lines = ['{"arquivo": "z", "status": "assinado"}', '{"arquivo": "b", "sta', "", '{"status": "erro"}', "[1]", '{"arquivo": "A", "status": "erro", "paginas": "x"}', '{"arquivo": "z", "status": "erro"}', '{"arquivo": "m.pptx", "status": "nao_suportado", "formato": ".pptx"}', '{"arquivo": "m.xls", "status": "nao_suportado", "formato": ".xls"}']
    (tmp_path / "r.jsonl").write_text("\n".join(lines), encoding="utf-8")
    path = str(tmp_path / "r.jsonl")
    got = R.ordered(R.read_records(spark, path)).collect()
    assert [(r.arquivo, r.status) for r in got] == [("A", "erro"), ("m.pptx", "nao_suportado"), ("m.xls", "nao_suportado"), ("z", "erro")] and got[0].paginas == 0 and got[0].tentativas == 1
    done = {r.arquivo for r in R.completed(R.parse(R.numbered_lines(spark, path), schemas.RECORD, "arquivo")).collect()}
    assert done == {"A", "z", "m.xls"}


def test_appended_batches_keep_their_order(spark, tmp_path):
    path = str(tmp_path / "registros")
    for k in range(12):
        R.append_records(records(spark, [{"arquivo": "a", "status": "erro" if k < 11 else "assinado", "tentativas": k}, {"arquivo": f"b{k}"}]).repartition(2), path)
    (tmp_path / "registros" / "_novo-x").mkdir()
    (tmp_path / "registros" / "_novo-x" / "part-0.json").write_text('{"arquivo": "a", "status": "never"}')
    got = {r.arquivo: r for r in R.read_records(spark, path).collect()}
    assert got["a"].status == "assinado" and got["a"].tentativas == 11 and len(got) == 13
    labels = str(tmp_path / "rotulos")
    for label in (True, None, False, True, None):
        R.append_label(spark, labels, "s", label)
    assert [tuple(r)[:2] for r in R.read_labels(spark, labels).collect()] == [("s", None)]


def test_label_folders(spark, tmp_path):
    for place in ("com_assinatura/0123456789ab.jpg", "duvida/0123456789ab.jpg", "sem_assinatura/aaaaaaaaaaaa.jpg", "pendentes/bbbbbbbbbbbb.jpg", "com_assinatura/nota.jpg"):
        (tmp_path / place).parent.mkdir(exist_ok=True)
        (tmp_path / place).write_bytes(b"x")
    got = sorted(map(tuple, S.label_files(spark, str(tmp_path)).collect()))
    assert got == [("0123456789ab", "com_assinatura"), ("0123456789ab", "duvida"), ("aaaaaaaaaaaa", "sem_assinatura")]


def test_labels_round_trip(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"sha256": "a", "tem_assinatura": true}\n{"sha256": "a", "tem_assinatura": false}\n{"sha256": "b", "tem_assinatura": null}\n{"sha256": "c"}\n{bad', encoding="utf-8")
    got = R.read_labels(spark, str(tmp_path / "l.jsonl"))
    assert {r.sha256: r.tem_assinatura for r in got.collect()} == {"a": False, "b": None}
    R.write_labels(got, str(tmp_path / "out"))
    assert {r.sha256: r.tem_assinatura for r in R.read_labels(spark, str(tmp_path / "out")).collect()} == {"a": False, "b": None}
    assert R.read_parameters(str(tmp_path / "none")) == {}


def test_triage_must_be_json(spark, tmp_path):
    (tmp_path / "t.json").write_text('[{"id": "a", "causa": "rever"}, {"id": "b", "causa": "modelo"}]')
    from vestigo.operators.triage import review_ids

    assert [r.id for r in review_ids(R.read_triage(spark, str(tmp_path / "t.json"))).collect()] == ["a"]
    (tmp_path / "u.json").write_text("[{")
    with pytest.raises(Exception):  # noqa: B017
        R.read_triage(spark, str(tmp_path / "u.json")).collect()


def test_retries(spark):
    queue = spark.createDataFrame([("good",), ("flaky",), ("broken",)], "arquivo string")
    rounds = []

    def run(df):
        rounds.append(sorted(r.arquivo for r in df.collect()))
        bad = F.col("arquivo").isin("flaky", "broken")
        return df.select("arquivo", F.when(bad, "erro").otherwise("assinado").alias("status"), (F.col("arquivo") == "flaky").alias("retentavel"))

    got = {r.arquivo: r.tentativas for r in jobs.with_retries(queue, run, most=2).collect()}
    assert got == {"good": 1, "flaky": 3, "broken": 1} and rounds == [["broken", "flaky", "good"], ["flaky"], ["flaky"]]


def test_work_queue_and_lock(spark, tmp_path):
    files = spark.createDataFrame([("a", "pdf"), ("b", "pdf"), ("z.zip", "zip")], "arquivo string, tipo string")
    docs, zips = jobs.work_queue(files, records(spark, [{"arquivo": "a"}]))
    assert [r.arquivo for r in docs.collect()] == ["b"] and [r.arquivo for r in zips.collect()] == ["z.zip"]
    lock = str(tmp_path / ".lock")
    with jobs.run_lock(lock), pytest.raises(RuntimeError), jobs.run_lock(lock):
        pass
    (tmp_path / ".lock").write_text('{"pid": 99999999}')
    with jobs.run_lock(lock):
        assert os.path.exists(lock)
    assert not os.path.exists(lock)


def _detector():
    """A detector that travels to the workers by value."""

    def fake(gray, tile):
        if gray == b"\x01" * 8:
            raise RuntimeError("no model")
        if gray == b"\x02" * 8 and tile is None:
            return np.zeros((0, 5))
        if gray == b"\x02" * 8:
            return np.array([[320, 320, 64, 64, 0.8]]) if tile[0] == 0 and tile[1] == 0 else np.zeros((0, 5))
        return np.array([[320, 320, 64, 32, 0.9], [322, 320, 64, 32, 0.5]]) if gray == b"\x03" * 8 else np.zeros((0, 5))

    return fake


def test_cascade(spark):
    docs = spark.createDataFrame([("stamp", "assinado por ANA", None), ("form", "", None), ("seen", "x", None), ("tile", "x", None), ("fail", "x", None), ("none", "x", None), ("given", "assinado por X", "")], "doc string, texto string, texto_extraido string")
    page = lambda d, b: (d, 1, bytearray(b * 8), "")
    pages = spark.createDataFrame([page("stamp", b"\x03"), page("form", b"\x09"), page("seen", b"\x03"), page("tile", b"\x02"), page("fail", b"\x01"), page("none", b"\xff"), page("given", b"\x09")], "doc string, numero int, gray binary, texto string")
    widgets = spark.createDataFrame([("form", 1, "s", True, True, 10), ("none", 1, "s", True, False, 10)], "doc string, page int, campo string, tem_valor boolean, tem_byterange boolean, bytes_contents int")
    got = {r.doc: r for r in detect.detect_documents(docs, pages, widgets, _detector(), detect.BATCH).collect()}
    assert {k: r.status for k, r in got.items()} == {"stamp": "assinado", "form": "assinado", "seen": "assinado", "tile": "assinado", "fail": "indeterminado", "none": "sem_assinatura", "given": "sem_assinatura"}
    assert got["stamp"].fontes == ["digital", "visual"] and got["stamp"].nivel1_total == 1 and got["form"].fontes == ["pdf_embedded"] and got["tile"].paginas_ladrilhadas == 1
    assert got["none"].paginas_em_branco == 1 and got["none"].paginas_analisadas == 0 and got["stamp"].signatarios == ["ANA"]
    off = {r.doc: r.status for r in detect.detect_documents(docs, pages, widgets, None).collect()}
    assert off["fail"] == off["seen"] == "sem_assinatura" and off["stamp"] == "assinado"
    # one failing page among good ones drops level 1 as a whole
    more = pages.unionByName(spark.createDataFrame([("seen", 2, bytearray(b"\x01" * 8), "")], pages.schema))
    broken = {r.doc: r for r in detect.detect_documents(docs, more, widgets, _detector(), detect.BATCH).collect()}["seen"]
    assert (broken.status, broken.visual, broken.paginas_analisadas, broken.tempo_inferencia_ms) == ("indeterminado", [], 0, 0) and "no model" in broken.nivel1_erro
    tool = {r.doc: r for r in detect.detect_documents(docs, pages, widgets, _detector(), detect.TOOL).collect()}
    assert tool["stamp"].paginas_analisadas == 0 and tool["seen"].nivel1_total == 1


def test_hits_in_order_of_place(spark):
    def two(gray, tile):
        return np.array([[320, 500, 64, 32, 0.9], [320, 100, 64, 32, 0.5], [100, 300, 64, 32, 0.7]])

    pages = spark.createDataFrame([("d", k, bytearray(b"\x03" * 8), "") for k in (3, 1, 2)], "doc string, numero int, gray binary, texto string").repartition(3)
    docs = spark.createDataFrame([("d", "", None)], "doc string, texto string, texto_extraido string")
    none = spark.createDataFrame([], "doc string, page int, campo string, tem_valor boolean, tem_byterange boolean, bytes_contents int")
    hits = detect.detect_documents(docs, pages, none, two).first().visual
    assert [(h.page, h.confidence) for h in hits] == [(p, c) for p in (1, 2, 3) for c in (0.5, 0.7, 0.9)]


def test_package_references(spark, tmp_path):
    """Pages cut off inside a reference: the query's SQL resolves four whole ones and no others; an operator's default is HTML's."""
    html = ["<p>a &amp</p>p{&am<i>p; &copy; &middot; &quot;", "&amp;quot; &ampp; &amp", "&lt; &#65; &copy &nbsp;", None]
    spark.createDataFrame(list(enumerate(html)), "page_id long, html string").selectExpr("*", "'u' as url").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.arquivo: r.texto for r in plans.QUERIES["package_texts"](spark, str(tmp_path)).collect()}
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
        assert got == {name: text for name, text, _ in c.execute(plans.ORACLES["package_texts"]).fetchall()}
    assert got["p0/texto.docx"] == 'a &ampp{& © · "' and got["p3/texto.docx"] == ""
    assert S.package_text(_zip({"word/document.xml": "<p>a &amp</p>p; &lt;"}), ".docx") == "a &p; <"


def test_contents(spark):
    rows = [(r"/Contents (a(b\))\101\n)",), ("/Contents <0a1>",), ("/Other",), ("/Contents (open",)]
    got = [bytes(r.x) for r in spark.createDataFrame(rows, "o string").select(detect.pdf_contents("o").alias("x")).collect()]
    assert got == [b"a(b))A\n", b"\x0a", b"", b""]


def test_contents_block_by_block():
    """A batch of 32 MB is decoded a megabyte at a time, whatever the number of its rows; order, nulls and longer texts stay."""
    texts = [f"/Contents ({k}{'y' * 4000})" for k in range(8000)] + [None, "", f"/Contents ({'z' * 3_000_000})", "/Contents <0a>"]
    batches = [pa.array(texts[:5000], pa.string()), pa.array([], pa.string()), pa.array(texts[4000:], pa.string()).slice(1000)]
    rows, most = [], 0
    tracemalloc.start()
    for block in detect.pdf_contents.func(iter(batches)):
        rows += pc.binary_length(block).to_pylist()
        most = max(most, block.nbytes if len(block) > 1 else 0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == [4000 + len(str(k)) for k in range(8000)] + [0, 0, 3_000_000, 1] and most < 2 << 20 and peak < 16 << 20


def test_streams(spark, tmp_path):
    src, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    src.mkdir()
    (src / "1.jsonl").write_text('{"arquivo": "a", "status": "assinado", "processado_em": "2026-08-06T10:00:01"}\nbad\n')
    for n in (1, 2):
        ingest.append_table(ingest.stream_records(spark, str(src)), str(out), str(state)).awaitTermination()
        assert spark.read.parquet(str(out)).count() == n
        (src / f"{n + 1}.jsonl").write_text('{"arquivo": "b", "status": "erro"}\n')
    labels = tmp_path / "labels"
    labels.mkdir()
    (labels / "1.json").write_text('{"sha256": "a", "tem_assinatura": true, "seq": 1}\n{"sha256": "b", "tem_assinatura": null, "seq": 2}\n')
    for n in (0, 1):
        s = spark.readStream.schema("sha256 string, tem_assinatura boolean, seq long").json(str(labels))
        ingest.upsert_labels(s, str(tmp_path / "t"), str(tmp_path / "ts")).awaitTermination()
        (labels / f"{n + 2}.json").write_text('{"sha256": "a", "tem_assinatura": false, "seq": 3}\n')
    got = {r.sha256: r.tem_assinatura for r in ingest.current_labels(spark, str(tmp_path / "t")).collect()}
    assert got == {"a": False, "b": None}
