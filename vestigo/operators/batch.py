"""The batch run: list, expand, prepare, detect and append, with resume and retries.

A document's failure becomes its record; nothing stops the lot. Finished rounds
are appended one by one, so a run that dies goes on where it was.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import text as X
from ..sources import files as S
from ..sources import pdf
from ..sources import records as R
from ..storage import materialise
from .detect import BATCH, Detector, Options, detect_documents

#: Gray pixels (8 bits) of every page of a PDF or picture, given its bytes and extension.
Draw = Callable[[bytes, str], Iterable[bytes]]


class InvalidDocument(Exception):
    """A document that no second attempt makes readable."""


@dataclass(frozen=True)
class Backends:
    """Functions that run on the executors. Without ``draw`` pages have no pixels and count as not blank."""

    draw: Draw | None = None
    detect: Detector | None = None


_PART = """arquivo string, numero int, gray binary, texto string, extraido string, erro string, erro_tipo string, retentavel boolean, ms double,
campos array<struct<page: int, campo: string, tem_valor: boolean, byte_range: string, contents: binary>>"""
_FIELD = pa.struct([("page", pa.int32()), ("campo", pa.string()), ("tem_valor", pa.bool_()), ("byte_range", pa.string()), ("contents", pa.binary())])
_ARROW = pa.schema([
    ("arquivo", pa.string()), ("numero", pa.int32()), ("gray", pa.binary()), ("texto", pa.string()), ("extraido", pa.string()),
    ("erro", pa.string()), ("erro_tipo", pa.string()), ("retentavel", pa.bool_()), ("ms", pa.float64()), ("campos", pa.list_(_FIELD)),
])


def _read(data: bytes | None, kind: str, extension: str, draw: Draw | None) -> tuple[list[tuple[bytes | None, str]], str | None, list[dict]]:
    """(pages as pixels and text, text from outside the pages, signature fields) of one document."""
    if data is None:
        raise OSError("the file can't be read")
    if not data:
        raise InvalidDocument("arquivo vazio (0 bytes)")
    if kind == "pdf":
        try:
            texts, fields = pdf.read(data)
        except (ValueError, RecursionError) as e:
            raise InvalidDocument("PDF ilegível ou protegido por senha") from e
        pixels = list(draw(data, extension)) if draw else [None] * len(texts)
        return list(zip(pixels, texts, strict=True)), None, fields
    if kind == "imagem":
        try:
            return [(p, "") for p in (draw(data, extension) if draw else [None])], None, []
        except ValueError as e:
            raise InvalidDocument(f"imagem ilegível: {e}") from e
    try:
        text, pictures = S.package_text(data, extension), list(S.package_pictures(data, extension))
    except (KeyError, ValueError, S.zipfile.BadZipFile) as e:
        raise InvalidDocument(f"pacote OOXML: {e}") from e
    pages: list[tuple[bytes | None, str]] = []
    for picture in pictures:
        try:
            pages += [(p, "") for p in (draw(picture, ".png") if draw else [None])]
        except ValueError:  # a broken picture inside a good package
            continue
    return pages or [(b"", "")], text, []  # without pictures one blank page


def prepare(files: DataFrame, draw: Draw | None = None) -> DataFrame:
    """Rows of documents given as (arquivo, formato, tipo, conteudo): numero 0 is the document, 1 and up its pages."""

    def run(batches):
        for batch in batches:
            for name, extension, kind, data in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                began, rows = time.perf_counter(), []
                head = {"arquivo": name, "numero": 0, "campos": []}
                try:
                    pages, text, fields = _read(data, kind, extension, draw)
                    head |= {"texto": "\n".join(t for _, t in pages), "extraido": text, "campos": [{k: f[k] for k in ("page", "campo", "tem_valor", "byte_range", "contents")} for f in fields]}
                    rows = [{"arquivo": name, "numero": k, "gray": g, "texto": t} for k, (g, t) in enumerate(pages, 1)]
                except InvalidDocument as e:
                    head |= {"erro": str(e), "erro_tipo": "DocumentoInvalidoError", "retentavel": False}
                except Exception as e:  # a failing document must not stop the lot
                    head |= {"erro": str(e), "erro_tipo": type(e).__name__, "retentavel": True}
                head["ms"] = (time.perf_counter() - began) * 1000
                yield pa.RecordBatch.from_pylist([head], schema=_ARROW)
                for a in range(0, len(rows), 16):  # pages leave in small batches
                    yield pa.RecordBatch.from_pylist(rows[a : a + 16], schema=_ARROW)

    return files.select("arquivo", "formato", "tipo", "conteudo").mapInArrow(run, _PART)


def process(files: DataFrame, backends: Backends = Backends(), options: Options = BATCH) -> DataFrame:  # noqa: B008
    """One record per document given as (arquivo, formato, tipo, tamanho_bytes, conteudo); every failure is a record."""
    outside = F.col("tipo").isin("nao_suportado", "zip")
    parts = materialise(prepare(files.filter(~outside), backends.draw), "prepared")
    heads = parts.filter("numero = 0")
    docs = heads.filter("erro_tipo is null").select(F.col("arquivo").alias("doc"), "texto", F.col("extraido").alias("texto_extraido"))
    pages = parts.filter("numero > 0").select(F.col("arquivo").alias("doc"), "numero", "gray", "texto")
    field = heads.select(F.col("arquivo").alias("doc"), F.explode("campos").alias("f"))
    widgets = field.select("doc", "f.page", "f.campo", "f.tem_valor", X.byte_range_valid(F.col("f.byte_range")).alias("tem_byterange"), F.octet_length("f.contents").alias("bytes_contents"))
    found = detect_documents(docs, pages, widgets, backends.detect, options).withColumnRenamed("doc", "arquivo")
    known = files.select("arquivo", "formato", "tipo", "tamanho_bytes")
    rows = known.join(heads.select("arquivo", "erro", "erro_tipo", "retentavel", "ms"), "arquivo", "left").join(found.drop("texto"), "arquivo", "left")
    message = F.concat(F.lit("formato `"), F.when(F.col("formato") == "(sem extensão)", "sem extensão").otherwise(F.col("formato")), F.lit("`"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("int")
    none = F.array().cast("array<string>")
    made = {
        "status": F.when(outside, "nao_suportado").when(F.col("erro_tipo").isNotNull() | F.col("status").isNull(), "erro").otherwise(F.col("status")),
        "erro": F.when(outside, message).otherwise(F.col("erro")),
        "erro_tipo": F.when(outside, "FormatoNaoSuportadoError").otherwise(F.col("erro_tipo")),
        "retentavel": F.when(outside, False).otherwise(F.coalesce("retentavel", F.lit(True))),
        "paginas_analisadas_nivel1": zero("paginas_analisadas"), "paginas_limitadas": F.coalesce("paginas_limitadas", F.lit(False)),
        "tempo_inferencia_ms": F.bround(F.coalesce("tempo_inferencia_ms", F.lit(0.0)), 2), "tempo_ms": F.bround(F.coalesce("ms", F.lit(0.0)) + F.coalesce("tempo_inferencia_ms", F.lit(0.0)), 1),
        "fontes": F.coalesce("fontes", none), "signatarios": F.coalesce("signatarios", none), "observacao": F.lit(None).cast("string"), "tentativas": F.lit(1),
        "processado_em": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"),
        **{c: zero(c) for c in ("assinaturas_total", "nivel0_total", "nivel1_total", "paginas", "paginas_em_branco", "paginas_ladrilhadas")},
    }
    return _as_records(rows.withColumns(made))


def _as_records(rows: DataFrame) -> DataFrame:
    """The columns of the checkpoint, in its order; what ``rows`` lacks is what absence means."""
    record = T._parse_datatype_string(schemas.RECORD)
    have = set(rows.columns)
    return schemas.with_defaults(rows.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in record.fields]))


def zip_records(boxes: DataFrame, zips: DataFrame) -> DataFrame:
    """A container record per archive (arquivo, destino, arquivos, falha), or an error that isn't tried again."""
    bad = F.col("falha").isNotNull()
    rows = boxes.join(zips.select("arquivo", "tamanho_bytes"), "arquivo", "left").withColumns({
        "formato": F.lit(".zip"), "tipo": F.lit("zip"), "status": F.when(bad, "erro").otherwise("container"), "retentavel": F.lit(False), "tentativas": F.lit(1),
        "observacao": F.when(~bad, F.concat(F.lit("extraído em `"), F.col("destino"), F.lit("` ("), F.col("arquivos").cast("string"), F.lit(" arquivos) — o conteúdo tem linha própria"))),
        "erro": F.when(bad, F.concat(F.lit("falha ao extrair o zip: "), F.col("falha"))), "erro_tipo": F.when(bad, "ZipInvalidoError"),
        "processado_em": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss"),
    })
    return _as_records(rows)


def preflight(options: Options, backends: Backends) -> None:
    """Fails before a lot is run whose level 1 is on and can't run: its counts would read as zero findings."""
    if options.level1 and (backends.detect is None or backends.draw is None):
        raise RuntimeError("level 1 is on and has no detector or no pages to look at")


def _exists(spark: SparkSession, path: str, delete: bool = False) -> bool:
    fs, at = S._hadoop(spark, path)
    if delete and fs.exists(at):
        fs.delete(at, True)
    return fs.exists(at)


def run_batch(spark: SparkSession, root: str, checkpoint: str, backends: Backends = Backends(), options: Options = BATCH, retries: int = 2, reprocess: bool = False, slices: int = 1) -> dict:  # noqa: B008
    """Processes what the checkpoint has no final line for and appends a line per document.

    Failed documents that may be tried again run up to ``retries`` more times behind the others. The work
    is cut into ``slices``, each appended when it is done, so that a run that dies loses one at most.
    """
    preflight(options, backends)
    began = time.perf_counter()
    lines = None
    if _exists(spark, checkpoint, delete=reprocess):
        lines = materialise(R.parse(R.numbered_lines(spark, checkpoint), schemas.RECORD, "arquivo").select("arquivo", "status", "formato"), "lines")
    done = R.completed(lines) if lines is not None else spark.createDataFrame([], "arquivo string")
    files = materialise(S.list_documents(spark, root), "listing")
    zips = S.read_contents(spark, root, files.filter("tipo = 'zip'"))
    inside, boxes = S.expand_archives(spark, zips, files.select("arquivo"), lambda df: materialise(df, "members"))
    inside, boxes = materialise(inside, "inside"), materialise(boxes, "boxes")
    resumed = done.count()
    found = files.count() + inside.count() + boxes.join(files, "arquivo", "left_anti").count()
    sizes = files.select("arquivo", "tamanho_bytes")
    archives = materialise(zip_records(boxes.join(done, "arquivo", "left_anti"), sizes), "archives")
    processed = archives.count()
    if processed:
        R.append_records(archives, checkpoint)
    outer = files.filter("tipo <> 'zip'").join(done, "arquivo", "left_anti")
    inner = inside.join(done, "arquivo", "left_anti")
    for k in range(slices):
        mine = F.pmod(F.xxhash64("arquivo"), F.lit(slices)) == k
        left = materialise(S.read_contents(spark, root, outer.filter(mine)).unionByName(inner.filter(mine).select(*outer.columns, "conteudo")), "queue")
        for attempt in range(1, retries + 2):
            if left.isEmpty():
                break
            records = materialise(process(left, backends, options).withColumn("tentativas", F.lit(attempt)), "records")
            again = (F.col("status") == "erro") & F.col("retentavel")
            final = records if attempt == retries + 1 else records.filter(~again)
            if not final.isEmpty():
                R.append_records(final, checkpoint)
                processed += final.count()
            left = left.join(records.filter(again).select("arquivo"), "arquivo", "left_semi") if attempt <= retries else left.limit(0)
    opened = boxes.filter("falha is null").agg(F.count("*").alias("n"), F.coalesce(F.sum("arquivos"), F.lit(0)).alias("m")).first()
    return {
        "documentos_encontrados": found, "zips_expandidos": opened.n, "arquivos_extraidos_de_zip": opened.m, "documentos_retomados": resumed,
        "documentos_processados": processed, "segundos_totais": round(time.perf_counter() - began, 1), "opcoes": asdict(options),
    }


def inspect_forms(files: DataFrame) -> DataFrame:
    """(arquivo, campos, erro): the signature fields of PDFs given as (arquivo, conteudo); an unreadable one is an error row."""

    def run(batches):
        for batch in batches:
            for name, data in zip(*(batch.column(k).to_pylist() for k in range(2)), strict=True):
                fields, error = [], None
                try:
                    fields = pdf.read(data or b"")[1]
                except Exception as e:
                    error = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_pylist([{"arquivo": name, "lidos": fields, "erro": error}], schema=arrow)

    text = ("campo", "byte_range", "subfilter", "nome_declarado", "data", "motivo")
    field = pa.struct([("page", pa.int32()), ("tem_valor", pa.bool_()), ("contents", pa.binary()), *((t, pa.string()) for t in text)])
    arrow = pa.schema([("arquivo", pa.string()), ("lidos", pa.list_(field)), ("erro", pa.string())])
    ddl = "arquivo string, lidos array<struct<page: int, tem_valor: boolean, contents: binary, " + ", ".join(f"{t}: string" for t in text) + ">>, erro string"
    read = files.select("arquivo", "conteudo").mapInArrow(run, ddl)
    one = lambda f: F.struct(
        f["page"].alias("pagina"), f["campo"].alias("nome"), f["tem_valor"].alias("tem_valor"), X.byte_range_valid(f["byte_range"]).alias("tem_byterange"), F.octet_length(f["contents"]).alias("bytes_pkcs7"),
        f["subfilter"].alias("subfilter"), f["nome_declarado"].alias("nome_declarado"), f["data"].alias("data"), f["motivo"].alias("motivo"), X.certificate_names(f["contents"]).alias("nomes_no_certificado"),
    )
    return read.select("arquivo", F.when(F.col("erro").isNull(), F.transform("lidos", one)).alias("campos"), "erro")


def audit_forms(spark: SparkSession, root: str, records: DataFrame, hashes: DataFrame, per_group: int = 25, seed: int = 42) -> DataFrame:
    """The form audit: a sample per evidence group, its PDFs read and judged, one row per document."""
    from .forms import audited
    from .sampling import draw_forms

    sample = materialise(draw_forms(records, hashes, per_group, seed), "form_sample")
    files = S.list_documents(spark, root).join(sample, "arquivo", "left_semi")
    read = inspect_forms(S.read_contents(spark, root, files))
    missing = sample.join(files, "arquivo", "left_anti").select("arquivo", F.lit(None).cast(read.schema["campos"].dataType).alias("campos"), F.lit("FileNotFoundError: arquivo ausente").alias("erro"))
    rows = audited(sample, read.unionByName(missing))
    return rows.join(records.select("arquivo", "fontes", "nivel0_total", "nivel1_total"), "arquivo", "left")


def detect_one(spark: SparkSession, name: str, data: bytes, backends: Backends = Backends(), options: Options = BATCH) -> dict:  # noqa: B008
    """One document's record and its evidence block for a language model, as for a tool call."""
    files = S._typed(spark.createDataFrame([(name, len(data), bytearray(data))], "arquivo string, tamanho_bytes long, conteudo binary"))
    record = process(files, backends, options).first()
    if record.status in ("erro", "nao_suportado"):
        return {"record": record.asDict(True), "contexto": None, "aviso": record.erro}
    seen = lambda kind, c: [{c: None}] * (kind in record.fontes)
    block = {
        "tem_assinatura": record.assinaturas_total > 0, "fontes": record.fontes, "signatarios": record.signatarios, "digital": [{"evidencia": s} for s in record.signatarios] or seen("digital", "evidencia"),
        "visual": [], "embedded": [], "visual_error": record.nivel1_erro,
    }
    schema = "tem_assinatura boolean, fontes array<string>, signatarios array<string>, digital array<struct<evidencia: string>>, visual array<struct<page: int, confidence: double, quem_assinou: string>>, embedded array<struct<page: int>>, visual_error string"
    text = spark.createDataFrame([block], schema).select(X.context_block(F.struct("*")).alias("t")).first().t
    return {"record": record.asDict(True), "contexto": text, "aviso": None}


def sample_to_render(index: DataFrame, existing: DataFrame) -> DataFrame:
    """One item per content of the index that has no picture yet (``existing`` has the ids that do); the last item stands for it."""
    one = index.groupBy("id", "sha256").agg(F.max_by("arquivo", F.struct("estrato", "arquivo")).alias("arquivo"))
    return one.join(existing.select("id").distinct(), "id", "left_anti")


def render_sample(items: DataFrame, render: Callable[[bytes, str], bytes]) -> tuple[DataFrame, DataFrame]:
    """(pictures, failures) of items given as (id, arquivo, formato, conteudo); one that fails doesn't stop the others."""

    def run(batches):
        for batch in batches:
            for id_, name, extension, data in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                picture, error = None, None
                try:
                    picture = render(data, extension)
                except Exception as e:
                    error = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_pylist([{"id": id_, "arquivo": name, "imagem": picture, "erro": error}], schema=pa.schema([("id", pa.string()), ("arquivo", pa.string()), ("imagem", pa.binary()), ("erro", pa.string())]))

    rows = materialise(items.select("id", "arquivo", "formato", "conteudo").mapInArrow(run, "id string, arquivo string, imagem binary, erro string"), "rendered")
    return rows.filter("erro is null").select("id", "imagem"), rows.filter("erro is not null").select("id", "arquivo", "erro")


