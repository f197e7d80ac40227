import re

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vestigo.functions import classify as C
from vestigo.functions import geometry as G
from vestigo.functions import stats as S
from vestigo.functions import text as X


def _one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_stamp_names_its_signer(spark):
    t = "Documento assinado digitalmente por FULANO DE TAL SILVA\nICP-Brasil"
    hits = _one(spark, X.stamp_hits(F.lit(t)))
    assert [h.signatario for h in hits] == ["FULANO DE TAL SILVA"]
    assert hits[0].evidencia == "assinado digitalmente por FULANO DE TAL SILVA ICP-Brasil"


def test_stamp_without_a_name_and_order_of_marks(spark):
    assert _one(spark, X.stamp_hits(F.lit(""))) == []
    assert _one(spark, X.stamp_hits(F.lit("Relatorio"))) == []
    hits = _one(spark, X.stamp_hits(F.lit("ICP Brasil e ASSINATURA ELETRÔNICA")))
    assert [(h.signatario, h.evidencia) for h in hits] == [(None, "ASSINATURA ELETRÔNICA")]


def test_signers_differ_by_more_than_case(spark):
    t = "assinado por: Ana .\nassinada por ANA\nassinado eletronicamente por Bia;\nassinado por ..."
    assert [h.signatario for h in _one(spark, X.stamp_hits(F.lit(t)))] == ["Ana", "Bia"]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["assinado", "por", ":", " ", "\n", "ana", "ANA", ".", "digitalmente", "bia", " "]), max_size=14))
def test_signers_like_a_plain_reading(spark, parts):
    t = "".join(parts)
    seen, names = set(), []
    for m in re.finditer(r"assinad[oa]\s+(?:digitalmente|eletronicamente)?\s*por[:\s]+([^\n\r]+)", t, re.I):
        name = re.sub(r"\s+", " ", m[1]).strip().strip(" .,:;-")
        if name and name.lower() not in seen:
            seen.add(name.lower())
            names.append(name)
    got = [h.signatario for h in _one(spark, X.stamp_hits(F.lit(t))) if h.signatario]
    assert got == names


def test_labels_and_values(spark):
    cue = lambda t: _one(spark, X.has_signature_label(F.lit(t)))
    assert cue("Assinatura do empregado: ___") and cue("ASSINATURA DO ÓRGÃO") and not cue("Recebi os") and not cue("") and not cue("Relatorio mensal de producao")
    valid = lambda v: _one(spark, X.byte_range_valid(F.lit(v)))
    assert valid("[0 10 20 5]") and not valid("[0 30 20 5]") and not valid("[0 1 2]") and not valid("[-1 1 2 3]") and not valid(None)
    assert _one(spark, X.hex_contents(F.lit("/Contents <0a 1b 2>"))) == bytes.fromhex("0a1b")
    assert _one(spark, X.pdf_value(F.lit("/(Ana)"))) == "Ana" and _one(spark, X.pdf_value(F.lit("null"))) is None
    assert _one(spark, X.markdown_cell(F.lit("a|b\nc"))) == "a\\|b c"
    names = _one(spark, X.certificate_names(F.lit(b"\x00FULANO DE TAL:1 FULANO DE TAL X ANA")))
    assert names[0] == "FULANO DE TAL"


def test_suffix_and_type(spark):
    for name, ext, kind in (("a/b.PDF", ".pdf", "pdf"), ("a.tar.gz", ".gz", "nao_suportado"), (".bashrc", "", "nao_suportado"), ("x.JFIF", ".jfif", "imagem"), ("d.x/nada", "", "nao_suportado"), ("z.zip", ".zip", "zip"), ("a.pptm", ".pptm", "ooxml")):
        assert _one(spark, C.suffix(F.lit(name))) == ext
        assert _one(spark, C.file_type(C.suffix(F.lit(name)))) == kind


def test_form_verdicts(spark):
    kind = "array<struct<tem_valor: boolean, tem_byterange: boolean, bytes_pkcs7: int>>"
    verdict = lambda *f: spark.createDataFrame([(list(f),)], f"f {kind}").select(C.form_verdict("f").alias("x")).first().x
    assert verdict() == "sem_campo" and verdict((False, False, 0)) == "campo_vazio"
    assert verdict((True, True, 64)) == "assinado" and verdict((True, True, 63)) == "incompleto" and verdict((True, False, 900)) == "incompleto"
    assert verdict((False, False, 0), (True, True, 80)) == "assinado"


def _nms(boxes, most):
    order = sorted(range(len(boxes)), key=lambda i: (-boxes[i][4], i))
    kept = []

    def iou(a, b):
        w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
        inter = max(w, 0) * max(h, 0)
        union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter
        return inter / union if union > 0 else 0

    for i in order:
        if all(iou(boxes[k], boxes[i]) <= most for k in kept):
            kept.append(i)
    return kept


def test_nms_against_a_plain_one(spark):
    rng = np.random.default_rng(1)
    rows, want = [], []
    for n in range(40):
        b = [(float(x), float(y), float(x + w), float(y + h), float(s)) for x, y, w, h, s in rng.integers(1, 9, (n % 12, 5))]
        rows.append((n, [(*x, i) for i, x in enumerate(b)]))
        want.append(_nms(b, 0.4))
    df = spark.createDataFrame(rows, f"n int, boxes array<{G.BOX}>").select("n", F.transform(G.nms(F.col("boxes"), 0.4), lambda x: x["index"]).alias("k"))
    assert [r.k for r in df.orderBy("n").collect()] == want


def test_head_and_tiles(spark):
    hits = _one(spark, G.decode_head(F.array(F.array(*[F.lit(float(x)) for x in (320, 320, 64, 32, 0.9)]), F.array(*[F.lit(float(x)) for x in (5, 5, 2, 2, 0.1)]))))
    assert [(h.confidence, *h.bounding_box) for h in hits] == [(0.9, 0.45, 0.475, 0.1, 0.05)]
    tiles = _one(spark, G.tile_rects())
    assert len(tiles) == 9 and tiles[0].left == tiles[0].top == 0 and tiles[8].right == tiles[8].bottom == 1 and abs(tiles[4].left - (1 / 3 - 0.05)) < 1e-12


def test_ink(spark):
    ink = lambda p, k=200: _one(spark, G.ink_density(F.array(*map(F.lit, p)).cast("array<int>"), k))
    assert ink([0, 0, 255, 255]) == 0.5 and ink([230] * 4) == 0 and ink([230] * 4, 240) == 1 and ink([]) == 0


def test_wilson(spark):
    low, high = S.wilson(F.lit(95.0), F.lit(100))
    assert abs(_one(spark, low) - 0.8872) < 0.002 and abs(_one(spark, high) - 0.9781) < 0.002
    assert [_one(spark, x) for x in S.wilson(F.lit(0.0), F.lit(0))] == [0, 0]


def test_index_percentile(spark):
    for n in (1, 7, 10, 19, 20, 21, 40, 100):
        values = [float((k * 37) % n) - 3 for k in range(n)]
        got = S.index_percentile(spark.createDataFrame([(v,) for v in values], "v double"), "v", 95).first().p95_v
        assert got == sorted(values)[min(int(n * 95 / 100), n - 1)]
    assert S.index_percentile(spark.createDataFrame([], "v double"), "v", 95).count() == 0
