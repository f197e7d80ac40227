"""The batch run over a tree of made documents, and the PDF reader."""

import io
import json
import os
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vestigo import cli, schemas
from vestigo.operators import batch, detect, jobs
from vestigo.sources import files as S
from vestigo.sources import pdf
from vestigo.sources import records as R


def make_pdf(*texts, fields=(), packed=False, extra=b""):
    """A PDF of a page per text; fields are (page, name, value dictionary or None)."""
    bodies = {1: b"<< /Type /Catalog /Pages 2 0 R >>"}
    first = 10
    kids = " ".join(f"{first + 3 * k} 0 R" for k in range(len(texts)))
    bodies[2] = f"<< /Type /Pages /Kids [{kids}] /Count {len(texts)} /Resources << /Font << /F1 << /Type /Font >> >> >> >>".encode()
    for k, t in enumerate(texts):
        notes = " ".join(f"{200 + 2 * n} 0 R" for n, (page, _, _) in enumerate(fields) if page == k + 1)
        bodies[first + 3 * k] = f"<< /Type /Page /Parent 2 0 R /Contents {first + 3 * k + 1} 0 R /Annots [{notes}] >>".encode()
        shown = "".join(f"({line.replace('(', chr(92) + '(').replace(')', chr(92) + ')')}) Tj 0 -14 Td\n" for line in t.split("\n"))
        stream = zlib.compress(f"BT /F1 12 Tf 72 700 Td\n{shown}ET".encode("cp1252"))
        bodies[first + 3 * k + 1] = f"<< /Length {len(stream)} /Filter /FlateDecode >>\nstream\n".encode() + stream + b"\nendstream"
    for n, (_, name, value) in enumerate(fields):
        v = f"/V {201 + 2 * n} 0 R" if value else ""
        bodies[200 + 2 * n] = f"<< /Type /Annot /Subtype /Widget /FT /Sig /T ({name}) {v} >>".encode()
        if value:
            bodies[201 + 2 * n] = value.encode()
    out = b"%PDF-1.7\n"
    if packed:  # everything but streams goes into an object stream
        plain = {n: b for n, b in bodies.items() if b"stream\n" not in b}
        head, body = "", b""
        for n, b in plain.items():
            head += f"{n} {len(body)} "
            body += b + b" "
        data = zlib.compress(head.encode() + body)
        bodies = {n: b for n, b in bodies.items() if n not in plain}
        bodies[900] = f"<< /Type /ObjStm /N {len(plain)} /First {len(head)} /Length {len(data)} /Filter /FlateDecode >>\nstream\n".encode() + data + b"\nendstream"
    for n, b in bodies.items():
        out += f"{n} 0 obj\n".encode() + b + b"\nendobj\n"
    return out + extra + b"trailer << /Root 1 0 R >>\n%%EOF"


SIGNED = "<< /Type /Sig /ByteRange [0 100 400 50] /Contents <" + "30" * 40 + "00> /Name () /SubFilter /adbe.pkcs7.detached /Reason (visto) >>"
SHORT = "<< /Type /Sig /ByteRange [0 100 400 50] /Contents <3030> >>"


def _zip(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)
    return out.getvalue()


def _png(width, height):
    return b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + width.to_bytes(4) + height.to_bytes(4)


TREE = {
    "norte/acordo.pdf": make_pdf("Acordo assinado digitalmente por RITA COSTA", "segunda folha"),
    "norte/ficha.pdf": make_pdf("Ficha em branco", fields=[(1, "campo", None)]),
    "norte/campo.pdf": make_pdf("x", "y", fields=[(2, "visto", SIGNED)]),
    "norte/_capa.pdf": make_pdf("capa assinada por ELZA"),
    "norte/cifrado.pdf": make_pdf("x").replace(b"/Root 1 0 R", b"/Root 1 0 R /Encrypt 5 0 R"),
    "sul/vazio.pdf": b"",
    "sul/ruim.pdf": b"%PDF-1.4 nothing",
    "sul/rubrica.png": _png(400, 200),
    "sul/carta.docx": _zip({"word/document.xml": "<w:p>assinado por IVO &amp; LIA</w:p>", "word/media/a.png": _png(400, 200), "word/media/b.png": _png(60, 20), "word/media/c.png": b"no"}),
    "sul/falso.docx": b"no zip",
    "sul/oco.pptx": _zip({"a.txt": "x"}),
    "sul/conta.xls": b"x",
    "sul/~$carta.docx": b"x",
    "sul/lote.zip": _zip({"dentro/novo.pdf": make_pdf("assinado por UGO"), "mais.zip": _zip({"fundo.pdf": make_pdf("z")}), ".oculto": "x"}),
    "sul/quebrado.zip": b"PK no",
}
STATUS = {
    "norte/acordo.pdf": "assinado", "norte/ficha.pdf": "sem_assinatura", "norte/campo.pdf": "assinado", "norte/_capa.pdf": "assinado", "norte/cifrado.pdf": "erro", "sul/vazio.pdf": "erro", "sul/ruim.pdf": "erro",
    "sul/rubrica.png": "sem_assinatura", "sul/carta.docx": "assinado", "sul/falso.docx": "erro", "sul/oco.pptx": "erro", "sul/conta.xls": "nao_suportado", "sul/lote.zip": "container", "sul/lote/dentro/novo.pdf": "assinado",
    "sul/lote/mais.zip": "container", "sul/lote/mais/fundo.pdf": "sem_assinatura", "sul/quebrado.zip": "erro",
}
OFF = detect.Options(level1=False)


@pytest.fixture
def tree(tmp_path):
    for name, data in TREE.items():
        os.makedirs(tmp_path / "raiz" / os.path.dirname(name), exist_ok=True)
        (tmp_path / "raiz" / name).write_bytes(data)
    return tmp_path


def test_pdf_texts_and_fields():
    for packed in (False, True):
        texts, fields = pdf.read(make_pdf("Olá (mundo)\nção", "", "três", fields=[(1, "a", None), (3, "b", SIGNED)], packed=packed))
        assert texts == ["Olá (mundo)\nção", "", "três"]
        assert [(f["page"], f["campo"], f["tem_valor"], f["byte_range"], len(f["contents"]), f["motivo"]) for f in fields] == [(1, "a", False, None, 0, None), (3, "b", True, "[0 100 400 50]", 41, "visto")]
    # the last definition of an object counts
    later = make_pdf("x", fields=[(1, "a", SIGNED)], extra=b"201 0 obj\nnull\nendobj\n")
    assert pdf.read(later)[1][0]["tem_valor"] is False
    for bad in (b"", b"%PDF-1.4", b"%PDF " + b"[" * 5000, b"%PDF 1 0 obj << /Type /Catalog /Pages 1 0 R /Kids [1 0 R] >> endobj trailer << /Root 1 0 R >>"):
        try:
            assert pdf.read(bad)
        except (ValueError, RecursionError):
            pass


def test_pdf_reader_survives_noise():
    rng, good = np.random.default_rng(1), make_pdf("assinado por ANA", "b", fields=[(1, "a", SIGNED)])
    for _ in range(300):
        data = bytearray(good)
        for at in rng.integers(0, len(data), 12):
            data[at] = rng.integers(0, 256)
        try:
            pdf.read(bytes(data))
        except (ValueError, RecursionError):
            pass


def test_a_lot_from_files_to_records(spark, tree):
    root, log = str(tree / "raiz"), str(tree / "registros")
    found = batch.run_batch(spark, root, log, options=OFF)
    rows = {r.arquivo: r for r in R.read_records(spark, log).collect()}
    assert {k: r.status for k, r in rows.items()} == STATUS
    assert rows["norte/acordo.pdf"].signatarios == ["RITA COSTA"] and rows["norte/acordo.pdf"].paginas == 2 and rows["norte/campo.pdf"].fontes == ["pdf_embedded"]
    assert rows["sul/carta.docx"].signatarios == ["IVO & LIA"] and rows["sul/carta.docx"].paginas == 1 and rows["sul/vazio.pdf"].erro_tipo == "DocumentoInvalidoError" and not rows["sul/vazio.pdf"].retentavel
    assert rows["sul/conta.xls"].erro == "formato `.xls`" and rows["sul/quebrado.zip"].erro_tipo == "ZipInvalidoError" and "`sul/lote` (3 arquivos)" in rows["sul/lote.zip"].observacao
    assert (found["documentos_processados"], found["documentos_retomados"], found["zips_expandidos"]) == (len(STATUS), 0, 2)
    # a second run has nothing to do, a third one only what is new
    again = batch.run_batch(spark, root, log, options=OFF)
    assert (again["documentos_processados"], again["documentos_retomados"]) == (0, len(STATUS))
    (tree / "raiz" / "novo.pdf").write_bytes(TREE["norte/ficha.pdf"])
    assert batch.run_batch(spark, root, log, options=OFF, slices=3)["documentos_processados"] == 1
    assert batch.run_batch(spark, root, log, options=OFF, reprocess=True)["documentos_processados"] == len(STATUS) + 1
    # what was cut off in the middle of a line is done again
    (tree / "meio").mkdir()
    (tree / "meio" / "a.json").write_text('{"arquivo": "novo.pdf", "status": "sem_assinatura"}\n{"arquivo": "norte/ficha.pdf", "sta')
    assert batch.run_batch(spark, root, str(tree / "meio"), options=OFF)["documentos_processados"] == len(STATUS)


def _draw(fail: str):
    def draw(data, extension):
        if fail == "png" and extension == ".png":
            raise RuntimeError("backend down")
        if data[:4] == b"\x89PNG" and int.from_bytes(data[16:20]) == 60:
            raise ValueError("small")
        return [b"\x03" * 8] * (1 if data[:4] == b"\x89PNG" else len(pdf.read(data)[0]))

    return draw


def _see(gray, tile):
    return np.array([[320, 320, 64, 32, 0.9]]) if gray == b"\x03" * 8 else np.zeros((0, 5))


def test_a_failing_backend_is_tried_again_and_recorded(spark, tree):
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    root, log = str(tree / "raiz"), str(tree / "registros")
    with pytest.raises(RuntimeError):
        batch.run_batch(spark, root, log)
    batch.run_batch(spark, root, log, batch.Backends(_draw("png"), _see), retries=2)
    rows = {r.arquivo: r for r in R.read_records(spark, log).collect()}
    png = rows["sul/rubrica.png"]
    assert (png.status, png.erro_tipo, png.tentativas, png.retentavel) == ("erro", "RuntimeError", 3, True) and rows["norte/ficha.pdf"].status == "assinado" and rows["norte/ficha.pdf"].fontes == ["visual"]
    assert rows["norte/acordo.pdf"].nivel1_total == 2 and rows["norte/acordo.pdf"].tentativas == 1
    good = batch.detect_one(spark, "x/rubrica.png", TREE["sul/rubrica.png"], batch.Backends(_draw(""), _see))
    assert good["record"]["nivel1_total"] == 1 and "- Possui assinatura: SIM" in good["contexto"]
    assert batch.detect_one(spark, "x.xls", b"x", options=OFF)["aviso"] == "formato `.xls`"


def test_command_line_runs_a_lot_and_audits_forms(spark, tree):
    root, log, out = str(tree / "raiz"), str(tree / "registros"), str(tree / "saida")
    assert cli.main(["processar", "--raiz", root, "--registros", log, "--saida", out, "--sem-nivel1"]) == 0
    assert json.loads((tree / "saida" / "execucao.json").read_text())["documentos_processados"] == len(STATUS)
    assert cli.main(["hashes", "--raiz", root, "--registros", log, "--hashes", str(tree / "hashes"), "--saida", out]) == 0
    assert R.read_hashes(spark, str(tree / "hashes")).count() == sum(STATUS[k] in ("assinado", "sem_assinatura") and "lote/" not in k for k in STATUS)
    assert cli.main(["acroform", "--raiz", root, "--registros", log, "--hashes", str(tree / "hashes"), "--saida", out]) == 0
    rows = [json.loads(x) for f in sorted((tree / "saida" / "ACROFORM.jsonl").glob("*.json")) for x in f.read_text().splitlines()]
    assert [(r["arquivo"], r["veredito"], r["campos"][0]["bytes_pkcs7"]) for r in rows] == [("norte/campo.pdf", "incompleto" if len(b"0" * 41) < 64 else "assinado", 41)]
    assert cli.main(["rotular", "--rotulos", str(tree / "rotulos"), "--sha256", "a" * 64, "--rotulo", "duvida", "--saida", out]) == 0
    assert [r.tem_assinatura for r in R.read_labels(spark, str(tree / "rotulos")).collect()] == [None]


def test_forms_that_cannot_be_read(spark, tree):
    log = [("norte/campo.pdf", ["pdf_embedded"]), ("sul/ruim.pdf", ["pdf_embedded"]), ("gone.pdf", ["pdf_embedded", "visual"])]
    from tests.lots import records

    rows = batch.audit_forms(spark, str(tree / "raiz"), records(spark, [{"arquivo": a, "fontes": f} for a, f in log]), spark.createDataFrame([], schemas.HASH))
    assert {r.arquivo: r.veredito for r in rows.collect()} == {"norte/campo.pdf": "incompleto", "sul/ruim.pdf": "erro", "gone.pdf": "erro"}
    fields = batch.inspect_forms(spark.createDataFrame([("a", bytearray(make_pdf("x", fields=[(1, "n", SHORT), (1, "m", SIGNED.replace("30" * 40, "30" * 70))])))], "arquivo string, conteudo binary")).first().campos
    assert [(f.nome, f.bytes_pkcs7, f.tem_byterange, f.subfilter) for f in fields] == [("n", 2, True, None), ("m", 71, True, "adbe.pkcs7.detached")]


def test_samples_are_rendered_once(spark):
    index = spark.createDataFrame([("a" * 12, "a" * 64, "x", "s", "assinado", 1), ("a" * 12, "a" * 64, "y", "s", "assinado", 1), ("b" * 12, "b" * 64, "z", "s", "assinado", 1), ("c" * 12, "c" * 64, "w", "s", "assinado", 1)], schemas.SAMPLE)
    todo = batch.sample_to_render(index, spark.createDataFrame([("b" * 12,)], "id string"))
    assert {(r.id[0], r.arquivo) for r in todo.collect()} == {("a", "y"), ("c", "w")}
    render = lambda data, extension: data if data else 1 / 0
    items = todo.withColumns({"formato": F.lit(".pdf"), "conteudo": F.when(F.col("arquivo") == "y", F.lit(b"q"))})
    done, failed = batch.render_sample(items, render)
    assert [bytes(r.imagem) for r in done.collect()] == [b"q"] and [(r.id[0], r.erro.split(":")[0]) for r in failed.collect()] == [("c", "ZeroDivisionError")]


def test_contents_are_read_whatever_the_name(spark, tmp_path):
    names = ["a.pdf", "_b.pdf", ".c/d.pdf", "e f/ção 100%.pdf", "vazio.pdf"]
    for n in names:
        os.makedirs(tmp_path / os.path.dirname(n), exist_ok=True)
        (tmp_path / n).write_bytes(b"" if n == "vazio.pdf" else n.encode())
    files = S.list_documents(spark, str(tmp_path))
    got = {r.arquivo: bytes(r.conteudo) for r in S.read_contents(spark, str(tmp_path), files).collect()}
    assert got == {n: b"" if n == "vazio.pdf" else n.encode() for n in names}
    assert S.content_hashes(S.read_contents(spark, str(tmp_path), files)).count() == 5


def test_lock_knows_a_reused_pid(tmp_path):
    lock = str(tmp_path / ".lock")
    (tmp_path / ".lock").write_text(json.dumps({"pid": os.getpid(), "inicio": "1"}))
    with jobs.run_lock(lock), pytest.raises(RuntimeError), jobs.run_lock(lock):
        pass
    with jobs.Sampler(0.01) as s:
        while not s.samples:
            pass
    assert all(len(x) == 3 for x in s.samples)
