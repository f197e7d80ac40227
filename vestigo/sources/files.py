"""Document trees: listing, zip expansion, package text and content hashes.

The listing keeps what Spark's own file sources would drop (empty files, names
with a leading underscore, files in dot folders) and drops lock files and
hidden names.
"""

from __future__ import annotations

import html
import io
import os
import re
import shutil
import zipfile
import zlib
from collections.abc import Callable, Iterator
from contextlib import suppress
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import vocabulary as V
from ..functions.classify import file_type, suffix
from .records import append_lines


def is_listed(name: str) -> bool:
    return not name.startswith(("~$", ".")) and ":Zone.Identifier" not in name


def walk(root: str) -> Iterator[str]:
    """Paths under ``root``, relative and with forward slashes, by lower-cased path."""
    found = []
    for folder, _, names in os.walk(root):
        found += [os.path.relpath(os.path.join(folder, n), root).replace(os.sep, "/") for n in names if is_listed(n)]
    yield from sorted(found, key=str.lower)


def _hadoop(spark: SparkSession, path: str):
    """(file system, qualified path) of a path in any store that Spark reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(p)


def listing(spark: SparkSession, root: str) -> Iterator[tuple[str, int]]:
    """(path, bytes) of every listed file under ``root`` in any store, path relative and with forward slashes.

    Names and sizes only, as the store's own listing gives them; contents stay where they are.
    """
    fs, base = _hadoop(spark, root)
    if not fs.exists(base):
        return
    prefix, found = base.toString().rstrip("/") + "/", fs.listFiles(base, True)
    while found.hasNext():
        status = found.next()
        path = status.getPath().toString()
        if is_listed(path.rsplit("/", 1)[-1]):
            yield path.removeprefix(prefix), status.getLen()


def _typed(files: DataFrame) -> DataFrame:
    ext = suffix("arquivo")
    return files.withColumns({"formato": F.when(ext == "", "(sem extensão)").otherwise(ext), "tipo": file_type(ext)})


def list_documents(spark: SparkSession, root: str) -> DataFrame:
    """arquivo, tamanho_bytes, formato, tipo of every file, supported or not."""
    return _typed(spark.createDataFrame(list(listing(spark, root)), "arquivo string, tamanho_bytes long"))


def read_contents(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """``files`` with ``conteudo``, read on the executors; NULL where a file can't be read.

    Spark's reader passes over empty files and over names with a leading underscore or dot: the
    former need no reading, the latter are opened one by one through Arrow's file systems.
    """
    _, base = _hadoop(spark, root)
    prefix = base.toString().rstrip("/") + "/"
    hidden = F.col("arquivo").rlike("(^|/)[_.]")
    names = files.columns
    seen = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(F.substring("path", len(prefix) + 1, 1 << 20).alias("arquivo"), F.col("content").alias("conteudo"))
    plain = files.filter(~hidden & (F.col("tamanho_bytes") > 0)).join(seen, "arquivo", "left").select(*names, "conteudo")
    empty = files.filter(F.col("tamanho_bytes") == 0).withColumn("conteudo", F.lit(b""))

    def open_each(batches):
        from pyarrow import fs

        for batch in batches:
            for k, name in enumerate(batch.column(names.index("arquivo")).to_pylist()):
                try:
                    store, path = fs.FileSystem.from_uri(prefix + name) if not prefix.startswith("file:") else (fs.LocalFileSystem(), (prefix + name).removeprefix("file:").replace("///", "/", 1))
                    with store.open_input_stream(path) as f:
                        data = f.read()
                except OSError:
                    data = None
                yield pa.RecordBatch.from_arrays([*batch.slice(k, 1).columns, pa.array([data], pa.binary())], names=[*names, "conteudo"])

    odd = files.filter(hidden & (F.col("tamanho_bytes") > 0)).mapInArrow(open_each, T.StructType([*files.schema.fields, T.StructField("conteudo", T.BinaryType())]))
    return plain.unionByName(empty).unionByName(odd)


@dataclass(frozen=True)
class Expanded:
    source: str
    target: str
    files: int
    existed: bool
    error: str | None = None


def _extract(path: str, target: str) -> int:
    """Members of a zip into ``target``, all or nothing; too many or too large ones are refused."""
    part = target + ".parcial"
    shutil.rmtree(part, ignore_errors=True)
    with zipfile.ZipFile(path) as z:
        members = [m for m in z.infolist() if not m.is_dir()]
        if len(members) > V.MAX_ZIP_FILES:
            raise ValueError(f"more than {V.MAX_ZIP_FILES} members")
        if sum(m.file_size for m in members) > V.MAX_ZIP_BYTES:
            raise ValueError(f"more than {V.MAX_ZIP_BYTES} bytes")
        os.makedirs(part)
        z.extractall(part, members)  # zipfile strips absolute and parent paths
    os.rename(part, target)
    return len(members)


def expand_zips(root: str, depth: int = V.MAX_ZIP_DEPTH) -> list[Expanded]:
    """Expands zips beside themselves, and zips inside those, to the given depth. A target that exists is left alone."""
    done: dict[str, Expanded] = {}
    for _ in range(depth):
        fresh = [p for p in walk(root) if p.lower().endswith(V.ZIP) and p not in done]
        if not fresh:
            break
        for p in fresh:
            path = os.path.join(root, p)
            target = os.path.splitext(path)[0]
            if os.path.isfile(target):
                target += "__zip"
            name = os.path.relpath(target, root).replace(os.sep, "/")
            if os.path.isdir(target):
                done[p] = Expanded(p, name, sum(len(f) for _, _, f in os.walk(target)), True)
                continue
            try:
                done[p] = Expanded(p, name, _extract(path, target), False)
            except (OSError, ValueError, RuntimeError, zipfile.BadZipFile, NotImplementedError) as e:
                shutil.rmtree(target + ".parcial", ignore_errors=True)
                done[p] = Expanded(p, name, 0, False, str(e))
    return list(done.values())


def zip_records(spark: SparkSession, expanded: list[Expanded]) -> DataFrame:
    """A container record per zip, or an error that isn't tried again."""
    rows = spark.createDataFrame([(e.source, e.files, e.error) for e in expanded], "arquivo string, arquivos int, falha string")
    bad = F.col("falha").isNotNull()
    return rows.select(
        "arquivo",
        F.lit(".zip").alias("formato"),
        F.lit("zip").alias("tipo"),
        F.when(bad, "erro").otherwise("container").alias("status"),
        F.when(~bad, F.concat(F.lit("expandido: "), F.col("arquivos").cast("string"), F.lit(" arquivo(s)"))).alias("observacao"),
        F.col("falha").alias("erro"),
        F.when(bad, "ZipInvalidoError").alias("erro_tipo"),
        F.lit(False).alias("retentavel"),
        F.lit(1).alias("tentativas"),
    )


def zip_members(archives: DataFrame) -> DataFrame:
    """(arquivo, membro, conteudo, erro) of archives given as (arquivo, conteudo): expansion without a disk.

    A member that can't be a value (over MAX_MEMBER_BYTES) or is broken gives its name and an error.
    """

    def row(name, member, data, error):
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([member], pa.string()), pa.array([data], pa.binary()), pa.array([error], pa.string())], ["arquivo", "membro", "conteudo", "erro"])

    def expand(batches):
        bad = (ValueError, RuntimeError, zipfile.BadZipFile, NotImplementedError, OSError, EOFError, zlib.error)
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(data or b"")) as z:
                        members = [m for m in z.infolist() if not m.is_dir()]
                        if len(members) > V.MAX_ZIP_FILES or sum(m.file_size for m in members) > V.MAX_ZIP_BYTES:
                            raise ValueError("archive over its limits")
                        for m in members:  # one member at a time stays in memory
                            try:
                                if m.file_size > V.MAX_MEMBER_BYTES:
                                    raise ValueError(f"member over {V.MAX_MEMBER_BYTES} bytes")
                                yield row(name, m.filename, z.read(m), None)
                            except bad as e:
                                yield row(name, m.filename, None, str(e))
                except bad as e:
                    yield row(name, None, None, str(e))

    return archives.select("arquivo", "conteudo").mapInArrow(expand, "arquivo string, membro string, conteudo binary, erro string")


def expand_archives(spark: SparkSession, zips: DataFrame, known: DataFrame, keep, depth: int = V.MAX_ZIP_DEPTH) -> tuple[DataFrame, DataFrame]:
    """(documents, archives) inside zips given as (arquivo, conteudo), to the given depth and without a disk.

    A member's path is its archive's without the extension, ``__zip`` added where a file has that name,
    and the member's own. ``known`` has the paths (arquivo) that exist; members among them are left out.
    ``keep`` makes a table durable. Archives come as (arquivo, destino, arquivos, falha).
    """
    docs, boxes, left = None, None, zips.select("arquivo", "conteudo")
    for level in range(depth):
        bare = F.regexp_replace("arquivo", "[.][^./]*$", "")
        clash = known.select(F.col("arquivo").alias("destino"), F.lit(True).alias("taken"))
        named = left.withColumn("destino", bare).join(clash, "destino", "left")
        named = keep(named.select("arquivo", F.when(F.col("taken"), F.concat("destino", F.lit("__zip"))).otherwise(F.col("destino")).alias("destino"), "conteudo"))
        found = keep(zip_members(named).join(named.select("arquivo", "destino"), "arquivo"))
        box = found.groupBy("arquivo", "destino").agg(F.count_if(F.col("membro").isNotNull()).cast("int").alias("arquivos"), F.max(F.when(F.col("membro").isNull(), F.col("erro"))).alias("falha"))
        # An archive without members has no row above.
        box = named.select("arquivo", "destino").join(box.drop("destino"), "arquivo", "left").withColumn("arquivos", F.coalesce("arquivos", F.lit(0)))
        inside = found.filter("membro is not null").select(F.concat("destino", F.lit("/"), F.regexp_replace("membro", r"^([A-Za-z]:)?/+|(^|/)[.][.](?=/)", "")).alias("arquivo"), "conteudo")
        name = F.regexp_extract("arquivo", "([^/]*)$", 1)
        inside = inside.filter(~name.rlike("^(~[$]|[.])") & ~F.contains(name, F.lit(":Zone.Identifier"))).join(known, "arquivo", "left_anti")
        inside = _typed(inside.dropDuplicates(["arquivo"]).withColumn("tamanho_bytes", F.coalesce(F.octet_length("conteudo"), F.lit(0)).cast("long")))
        boxes = box if boxes is None else boxes.unionByName(box)
        plain = inside if level == depth - 1 else inside.filter("tipo <> 'zip'")
        docs = plain if docs is None else docs.unionByName(plain)
        left = inside.filter("tipo = 'zip'").select("arquivo", "conteudo")
        if level == depth - 1 or left.isEmpty():
            break
    return docs, boxes


_BREAK, _TAB, _TAG = re.compile(V.XML_BREAK), re.compile(V.XML_TAB), re.compile(V.XML_TAG)


def resolver(references: dict[str, str]) -> Callable[[str], str]:
    """Resolves these references and no others, each once; ``html.unescape`` knows all of HTML's, some without their semicolon."""
    known = re.compile("|".join(map(re.escape, references)))
    return lambda text: known.sub(lambda m: references[m[0]], text)


def package_text(data: bytes, extension: str, resolve: Callable[[str], str] = html.unescape) -> str:
    """Text of an Office package: its XML parts in name order, joined by newlines."""
    prefix = V.OOXML_TEXT[extension.lower()]
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        parts = [m for m in z.infolist() if m.filename.startswith(prefix) and m.filename.endswith(".xml")]
        if sum(m.file_size for m in parts) > V.MAX_XML_BYTES:
            raise ValueError("package text over its limit")
        if not parts:
            raise ValueError(f"package without {prefix}*.xml")
        names = sorted(m.filename for m in parts)
        raw = [z.read(n).decode("utf-8", "replace") for n in names]
    return "\n".join(resolve(_TAG.sub("", _TAB.sub("\t", _BREAK.sub("\n", x)))) for x in raw)


def package_media(data: bytes, extension: str) -> list[tuple[str, int]]:
    """(name, bytes) of a package's pictures, in its own order, within the limits of number and total size."""
    prefix, left, out = V.OOXML_MEDIA[extension.lower()], V.MAX_MEDIA_BYTES, []
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        pictures = [m for m in z.infolist() if m.filename.startswith(prefix) and os.path.splitext(m.filename)[1].lower() in V.IMAGES]
        for m in pictures[: V.MAX_MEDIA_FILES]:
            left -= m.file_size
            if left < 0:
                break
            out.append((m.filename, m.file_size))
    return out


def image_size(data: bytes) -> tuple[int, int] | None:
    """(width, height) of a PNG, GIF, BMP or JPEG from its header; None for other or broken data."""
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return int.from_bytes(data[16:20]), int.from_bytes(data[20:24])
    if data[:6] in (b"GIF87a", b"GIF89a") and len(data) >= 10:
        return int.from_bytes(data[6:8], "little"), int.from_bytes(data[8:10], "little")
    if data[:2] == b"BM" and len(data) >= 26:
        return int.from_bytes(data[18:22], "little", signed=True), abs(int.from_bytes(data[22:26], "little", signed=True))
    at = 2
    while data[:2] == b"\xff\xd8" and at + 9 < len(data) and data[at] == 0xFF:
        if data[at + 1] in (0xC0, 0xC1, 0xC2, 0xC3):
            return int.from_bytes(data[at + 7 : at + 9]), int.from_bytes(data[at + 5 : at + 7])
        at += 2 + int.from_bytes(data[at + 2 : at + 4])
    return None


def package_pictures(data: bytes, extension: str) -> Iterator[bytes]:
    """A package's pictures that may be scanned pages: those of a readable size of 64 x 32 pixels or more."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for name, _ in package_media(data, extension):
            with suppress(RuntimeError, zipfile.BadZipFile, NotImplementedError, zlib.error, EOFError):
                picture = z.read(name)
                size = image_size(picture)
                if size and size[0] >= V.MIN_MEDIA_WIDTH and size[1] >= V.MIN_MEDIA_HEIGHT:
                    yield picture


def packages(files: DataFrame, resolve: Callable[[str], str] = html.unescape) -> DataFrame:
    """(arquivo, texto, midias, erro) of packages given as (arquivo, formato, conteudo); ``resolve`` turns references into characters."""

    def read(batches):
        for batch in batches:
            for name, ext, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                text, media, error = None, None, None
                try:
                    text, media = package_text(data, ext, resolve), len(package_media(data, ext))
                except (KeyError, ValueError, TypeError, RuntimeError, zipfile.BadZipFile, NotImplementedError) as e:
                    error = str(e)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([text], pa.string()), pa.array([media], pa.int32()), pa.array([error], pa.string())], ["arquivo", "texto", "midias", "erro"])

    return files.select("arquivo", "formato", "conteudo").mapInArrow(read, "arquivo string, texto string, midias int, erro string")


def unhashed(files: DataFrame, hashes: DataFrame) -> DataFrame:
    return files.join(hashes.select("arquivo"), "arquivo", "left_anti")


def content_hashes(files: DataFrame) -> DataFrame:
    """(arquivo, sha256) of files given as (arquivo, conteudo); an unreadable one has no row."""
    return files.filter(F.col("conteudo").isNotNull()).select("arquivo", F.sha2("conteudo", 256).alias("sha256"))


def append_hashes(hashes: DataFrame, path: str) -> None:
    """New rows of the hash cache, one committed append per batch."""
    append_lines(hashes.select("arquivo", "sha256"), path)


def label_files(spark: SparkSession, folder: str) -> DataFrame:
    """(id, pasta) of the pictures that lie in label folders; a name that isn't a short id is passed over."""
    rows = [(n.rsplit("/", 1)[-1].rsplit(".", 1)[0], n.rsplit("/", 1)[0]) for n, _ in listing(spark, folder) if "/" in n]
    return spark.createDataFrame(rows, "id string, pasta string").filter(F.col("id").rlike("^[0-9a-f]{12}$") & F.col("pasta").isin(*V.LABEL_FOLDERS))
