"""Registered queries over the derived lot, one per operator family, with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import vocabulary as V
from ..functions import classify as C
from ..functions import geometry as G
from ..functions import stats as S
from ..functions import text as X
from ..operators import audit, forms, rollup, sampling, triage
from ..operators.detect import ink_density
from ..sources.records import completed, latest, parse
from . import lot

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: Budgets of the sample in the audit queries.
NEGATIVES, POSITIVES, SEED, FLOOR = 200, 200, 42, 20

_POOL = f"""
pool AS (SELECT *, {lot.STRATUM_SQL} AS estrato FROM records),
evaluable AS (SELECT * FROM pool WHERE estrato <> ''),
sizes AS (SELECT estrato, count(*) AS tamanho FROM evaluable GROUP BY estrato),
quotas AS (SELECT estrato, tamanho, least(tamanho, greatest({FLOOR}, CAST(round_even((CASE WHEN estrato LIKE 'neg_%' THEN {NEGATIVES} ELSE {POSITIVES} END) * tamanho
    / sum(tamanho) OVER (PARTITION BY substr(estrato, 1, 4)), 0) AS BIGINT))) AS quota FROM sizes),
ranked AS (SELECT e.*, row_number() OVER (PARTITION BY estrato ORDER BY md5(concat_ws(':', '{SEED}', estrato, arquivo)), arquivo) AS nth FROM evaluable e),
idx AS (SELECT substr(r.sha256, 1, 12) AS id, r.sha256, r.arquivo, r.estrato, r.status, r.paginas FROM ranked r JOIN quotas q ON q.estrato = r.estrato WHERE nth <= quota),
marked AS (SELECT i.*, l.sha256 IS NOT NULL AS has_label, l.tem_assinatura AS label FROM idx i LEFT JOIN labels_ l ON l.sha256 = i.sha256),
classed AS (SELECT *, CASE WHEN NOT has_label THEN NULL WHEN label IS NULL THEN 'duvida' WHEN status = 'assinado' THEN CASE WHEN label THEN 'vp' ELSE 'fp' END
    WHEN label THEN 'fn' ELSE 'vn' END AS classe FROM marked),
drawn AS (SELECT estrato, count(*) AS sorteados, count(*) FILTER (classe IN ('vp', 'fp', 'vn', 'fn')) AS rotulados, count(*) FILTER (classe = 'duvida') AS duvidas,
    count(*) FILTER (classe = 'vp') AS vp, count(*) FILTER (classe = 'fp') AS fp, count(*) FILTER (classe = 'vn') AS vn, count(*) FILTER (classe = 'fn') AS fn FROM classed GROUP BY estrato),
strata AS (SELECT d.*, coalesce(s.tamanho, 0) AS populacao, CASE WHEN rotulados > 0 THEN s.tamanho / rotulados END AS fator FROM drawn d LEFT JOIN sizes s ON s.estrato = d.estrato)"""
_WITH = "WITH " + lot.RECORDS_SQL
_AUDIT = _WITH + "," + _POOL


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _audit(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, index, labels) of the audit."""
    r = lot.records(spark, sf_dir)
    bare = r.drop("sha256")  # contents are known by the hash table only
    return bare, sampling.draw(bare, lot.hashes(r), NEGATIVES, POSITIVES, SEED, FLOOR), lot.labels(spark, sf_dir, r)


# --- records and resume ---


@query("""SELECT 'u' || user_id AS arquivo, arg_max(event_type, event_id) AS status, arg_max(value, event_id) AS tempo_ms, min(event_id) AS first_seq, max(event_id) AS last_seq
FROM events GROUP BY user_id""")
def records_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = lot.table(spark, sf_dir, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("arquivo"), F.col("event_type").alias("status"), F.col("value").alias("tempo_ms"), F.col("event_id").alias("last_seq"), F.col("event_id").alias("seq"))
    return latest(log, "arquivo")


_LINES = _WITH + """,
lines AS (SELECT *, CASE WHEN doc_id % 13 = 0 THEN 0 WHEN doc_id % 17 = 0 THEN 0 ELSE 1 END AS good FROM records),
done AS (SELECT DISTINCT arquivo FROM lines WHERE good = 1 AND NOT (status = 'nao_suportado' AND doc_id % 2 = 0))"""


@query(_LINES + " SELECT r.arquivo, r.tipo FROM records r WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.arquivo = r.arquivo)")
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a final line: lines are parsed from JSON, some broken, some without a key, some back in scope."""
    r = lot.records(spark, sf_dir)
    i = F.col("doc_id")
    # An even id's unsupported format counts as supported by now: its line names a supported one.
    body = F.to_json(F.struct("arquivo", "status", F.when(i % 2 == 0, ".pptx").otherwise(F.col("formato")).alias("formato")))
    line = F.when(i % 13 == 0, F.substring(body, 1, 9)).when(i % 17 == 0, F.to_json(F.struct("status"))).otherwise(body)
    rows = parse(r.select(line.alias("value"), F.col("doc_id").alias("seq")), "arquivo string, status string, formato string", "arquivo")
    return r.join(completed(rows), "arquivo", "left_anti").select("arquivo", "tipo")


# --- roll-ups ---


@query(_WITH + " SELECT s.status, count(r.doc_id) AS n_docs FROM (SELECT unnest(['assinado', 'sem_assinatura', 'indeterminado', 'erro', 'nao_suportado', 'container']) AS status) s LEFT JOIN records r ON r.status = s.status GROUP BY s.status")
def rollup_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.by_status(lot.records(spark, sf_dir))


@query(_WITH + """ SELECT formato, count(*) AS documentos, count(*) FILTER (status = 'assinado') AS assinados, count(*) FILTER (status = 'sem_assinatura') AS sem_assinatura,
count(*) FILTER (status NOT IN ('assinado', 'sem_assinatura')) AS alerta FROM records GROUP BY formato""")
def rollup_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.by_format(lot.records(spark, sf_dir))


@query(_WITH + """, t AS (SELECT list(tempo_ms ORDER BY tempo_ms) FILTER (tempo_ms <> 0) AS x, sum(tempo_ms) AS total, sum(paginas) AS paginas, sum(tempo_inferencia_ms) AS inf,
    avg(tempo_ms) FILTER (tempo_ms <> 0) AS media, max(tempo_ms) AS maximo FROM records)
SELECT total / 1000 AS total_segundos, media AS medio_ms, list_median(x) AS mediana_ms, x[CAST(least(floor(len(x) * 95 / 100), len(x) - 1) AS BIGINT) + 1] AS p95_ms, maximo AS maximo_ms,
    total / paginas AS ms_por_pagina, inf / 1000 AS inferencia_segundos, inf / total * 100 AS percentual_inferencia FROM t""".replace("list_median(x)", "list_aggregate(x, 'median')"))
def rollup_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.times(lot.records(spark, sf_dir))


_COUNTS = {
    "documentos": "count(*)", "documentos_avaliaveis": "count(*) FILTER (status <> 'container')", "documentos_completos": "count(*) FILTER (status IN ('assinado', 'sem_assinatura'))",
    "documentos_com_retry": "count(*) FILTER (tentativas > 1)", "bytes_processados": "CAST(sum(tamanho_bytes) AS BIGINT)", "assinaturas_total": "CAST(sum(assinaturas_total) AS BIGINT)",
    "assinaturas_nivel0": "CAST(sum(nivel0_total) AS BIGINT)", "assinaturas_nivel1": "CAST(sum(nivel1_total) AS BIGINT)", "somente_nivel0": "count(*) FILTER (nivel0_total > 0 AND nivel1_total = 0)",
    "somente_nivel1": "count(*) FILTER (nivel1_total > 0 AND nivel0_total = 0)", "ambos": "count(*) FILTER (nivel0_total > 0 AND nivel1_total > 0)",
    "fallback_documentos": "count(*) FILTER (paginas_ladrilhadas > 0)", "fallback_paginas": "CAST(sum(paginas_ladrilhadas) AS BIGINT)",
    "fallback_resgatados": "count(*) FILTER (paginas_ladrilhadas > 0 AND assinaturas_total > 0)",
    "fallback_assinaturas": "CAST(coalesce(sum(assinaturas_total) FILTER (paginas_ladrilhadas > 0), 0) AS BIGINT)", "paginas_total": "CAST(sum(paginas) AS BIGINT)",
    "paginas_em_branco": "CAST(sum(paginas_em_branco) AS BIGINT)", "paginas_analisadas": "CAST(sum(paginas_analisadas_nivel1) AS BIGINT)", "documentos_limitados": "count(*) FILTER (paginas_limitadas)",
}


def _part(*names: str) -> str:
    return _WITH + " SELECT " + ", ".join(f"{_COUNTS[n]} AS {n}" for n in names) + " FROM records"


_LOT = ("documentos", "documentos_avaliaveis", "documentos_completos", "documentos_com_retry", "bytes_processados")
_METHOD = ("assinaturas_total", "assinaturas_nivel0", "assinaturas_nivel1", "somente_nivel0", "somente_nivel1", "ambos")
_FALLBACK = ("fallback_documentos", "fallback_paginas", "fallback_resgatados", "fallback_assinaturas")
_PAGES = ("paginas_total", "paginas_em_branco", "paginas_analisadas", "documentos_limitados")


@query(_part(*_LOT))
def rollup_lot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.counts(lot.records(spark, sf_dir)).select(*_LOT)


@query(_part(*_METHOD))
def rollup_method(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.counts(lot.records(spark, sf_dir)).select(*_METHOD)


@query(_part(*_FALLBACK))
def rollup_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.counts(lot.records(spark, sf_dir)).select(*_FALLBACK)


@query(_part(*_PAGES))
def rollup_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.counts(lot.records(spark, sf_dir)).select(*_PAGES)


@query(_WITH + """, n AS (SELECT greatest(count(*) FILTER (status <> 'container'), 1) AS n, count(*) FILTER (status = 'assinado') AS a, count(*) FILTER (status = 'sem_assinatura') AS s,
    count(*) FILTER (status IN ('erro', 'indeterminado', 'nao_suportado')) AS alertas, count(*) FILTER (paginas_ladrilhadas > 0 AND assinaturas_total > 0) AS r FROM records)
SELECT alertas, a / n AS taxa_assinado, s / n AS taxa_sem_assinatura, alertas / n AS taxa_alertas, (a - r) / n AS taxa_sem_fallback FROM n""")
def rollup_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.rates(lot.records(spark, sf_dir))


@query(_WITH + " SELECT erro_tipo, count(*) AS n_docs FROM records WHERE erro_tipo IS NOT NULL GROUP BY erro_tipo")
def errors_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.by_error(lot.records(spark, sf_dir))


@query(_WITH + " SELECT arquivo, tempo_ms, paginas, status FROM records ORDER BY tempo_ms DESC, lower(arquivo), arquivo LIMIT 10")
def slowest_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.slowest(lot.records(spark, sf_dir))


@query(_WITH + " SELECT arquivo, erro_tipo, 'falha | ' || erro_tipo AS erro, tentativas FROM records WHERE status = 'erro' ORDER BY lower(arquivo), arquivo LIMIT 15")
def first_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.first_errors(lot.records(spark, sf_dir))


@query(_WITH + """ SELECT arquivo, coalesce(nullif(concat_ws('; ', CASE WHEN tipo = 'zip' THEN 'contêiner expandido' END, CASE WHEN erro_tipo IS NOT NULL THEN 'falha \\| ' || erro_tipo END,
    'Nível 1 indisponível: ' || nivel1_erro, CASE WHEN paginas_ladrilhadas > 0 THEN 'fallback 3×3 em ' || paginas_ladrilhadas || ' pág' || CASE WHEN assinaturas_total > 0 THEN ' — assinatura resgatada' ELSE '' END END,
    CASE WHEN paginas_limitadas THEN 'Nível 1 limitado às primeiras ' || paginas_analisadas_nivel1 || ' págs' END, CASE WHEN tentativas > 1 THEN tentativas || ' tentativas' END), ''), '—') AS observacao FROM records""")
def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.observations(lot.records(spark, sf_dir))


@query("""WITH r AS (SELECT l_returnflag, list(l_extendedprice ORDER BY l_extendedprice) AS x FROM lineitem GROUP BY l_returnflag)
SELECT l_returnflag, x[CAST(least(floor(len(x) * 95 / 100), len(x) - 1) AS BIGINT) + 1] AS p95_l_extendedprice FROM r""")
def index_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.index_percentile(lot.table(spark, sf_dir, "lineitem"), "l_extendedprice", 95, "l_returnflag")


# --- strata and sampling ---


@query(_WITH + f" SELECT arquivo, {lot.STRATUM_SQL} AS estrato FROM records")
def stratify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lot.records(spark, sf_dir).select("arquivo", C.stratum().alias("estrato"))


@query(_AUDIT + " SELECT estrato, tamanho AS populacao FROM sizes")
def stratum_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.population(lot.records(spark, sf_dir))


@query(_AUDIT + " SELECT estrato, tamanho, quota FROM quotas")
def allocate(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = sampling.population(lot.records(spark, sf_dir)).withColumnRenamed("populacao", "tamanho")
    return sampling.allocate(sizes, NEGATIVES, POSITIVES, FLOOR)


@query(_AUDIT + " SELECT id, sha256, arquivo, estrato, status, paginas FROM idx")
def sample_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audit(spark, sf_dir)[1]


def _drawn(budget: int) -> str:
    """Documents that a budget draws, counted, in DuckDB SQL."""
    return f"""(SELECT CAST(sum(least(tamanho, greatest({FLOOR}, CAST(round_even({budget} * tamanho / side, 0) AS BIGINT)))) AS BIGINT)
    FROM (SELECT tamanho, sum(tamanho) OVER (PARTITION BY substr(estrato, 1, 4)) AS side FROM sizes))"""


@query(_AUDIT + f" SELECT {_drawn(100)} AS n_small, {_drawn(300)} AS n_large, {_drawn(100)} AS n_shared")
def sample_nested_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A smaller sample, a larger one, and what they share: all of the smaller."""
    r = lot.records(spark, sf_dir)
    small, large = (sampling.draw(r.drop("sha256"), lot.hashes(r), n, n, SEED, FLOOR).select("arquivo", F.lit(n).alias("of")) for n in (100, 300))
    by = small.unionByName(large).groupBy("arquivo").agg(F.count_if(F.col("of") == 100).alias("s"), F.count_if(F.col("of") == 300).alias("l"))
    return by.agg(F.sum("s").alias("n_small"), F.sum("l").alias("n_large"), F.count_if((F.col("s") > 0) & (F.col("l") > 0)).alias("n_shared"))


@query(_AUDIT + " SELECT id, count(DISTINCT sha256) AS n_contents FROM idx GROUP BY id HAVING count(DISTINCT sha256) > 1")
def id_collision_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.colliding_ids(_audit(spark, sf_dir)[1])


@query(_AUDIT + f""" SELECT id, sha256, arg_max(arquivo, struct_pack(e := estrato, a := arquivo)) AS arquivo, arg_max(estrato, struct_pack(e := estrato, a := arquivo)) AS estrato, count(*) AS copias,
    md5(concat_ws(':', '{SEED}', 'fila', id)) AS ordem FROM idx GROUP BY id, sha256""")
def labelling_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.labelling_queue(_audit(spark, sf_dir)[1], SEED)


# --- labels and audit ---


@query(_WITH + """, persisted AS (SELECT sha256, tem_assinatura FROM labels_), folders AS (SELECT DISTINCT sha256, CASE WHEN sha256 < '4' THEN NULL ELSE sha256 < '8' END AS tem_assinatura FROM records WHERE sha256 < 'a')
SELECT coalesce(f.sha256, p.sha256) AS sha256, CASE WHEN f.sha256 IS NOT NULL THEN f.tem_assinatura ELSE p.tem_assinatura END AS tem_assinatura FROM persisted p FULL JOIN folders f ON f.sha256 = p.sha256""")
def label_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders (here: by the first digit of the content's hash) replace persisted labels, doubt included."""
    r = lot.records(spark, sf_dir)
    persisted = lot.labels(spark, sf_dir, r).withColumn("seq", F.lit(0))
    place = F.when(F.col("sha256") < "4", "duvida").when(F.col("sha256") < "8", "com_assinatura").when(F.col("sha256") < "a", "sem_assinatura")
    files = r.select("sha256").distinct().select(F.col("sha256").alias("id"), place.alias("pasta")).filter("pasta is not null")
    known = r.select(F.col("sha256").alias("id"), "sha256").distinct()
    return audit.resolve_labels(persisted, audit.folder_labels(files, known))


@query(_AUDIT + " SELECT estrato, sorteados, rotulados, duvidas, vp, fp, vn, fn, populacao, fator, coalesce((fp + fn) * fator, 0.0) AS erros_estimados FROM strata")
def confusion_by_stratum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.by_stratum(*_audit(spark, sf_dir))


_SUMS = _AUDIT + """, m AS (SELECT coalesce(sum(vp * fator), 0.0) AS est_vp, coalesce(sum(fp * fator), 0.0) AS est_fp, coalesce(sum(vn * fator), 0.0) AS est_vn, coalesce(sum(fn * fator), 0.0) AS est_fn,
    CAST(sum(vp) AS BIGINT) AS vp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(vn) AS BIGINT) AS vn, CAST(sum(fn) AS BIGINT) AS fn FROM strata)"""


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Sums of doubles depend on order in the last bits."""
    return df.withColumns({n: F.round(n, digits) for n in names})


@query(_SUMS + " SELECT round(est_vp, 6) AS est_vp, round(est_fp, 6) AS est_fp, round(est_vn, 6) AS est_vn, round(est_fn, 6) AS est_fn, vp, fp, vn, fn FROM m")
def confusion_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(audit.matrices(audit.by_stratum(*_audit(spark, sf_dir))), "est_vp", "est_fp", "est_vn", "est_fn")


@query(_SUMS + f""", q AS (SELECT unnest([
    {{'indicador': 'acuracia', 'a': est_vp + est_vn, 'd': est_vp + est_fp + est_vn + est_fn, 'n': vp + fp + vn + fn}}, {{'indicador': 'precisao', 'a': est_vp, 'd': est_vp + est_fp, 'n': vp + fp}},
    {{'indicador': 'recall', 'a': est_vp, 'd': est_vp + est_fn, 'n': vp + fn}}, {{'indicador': 'especificidade', 'a': est_vn, 'd': est_vn + est_fp, 'n': vn + fp}},
    {{'indicador': 'vpn', 'a': est_vn, 'd': est_vn + est_fn, 'n': vn + fn}}]) AS s FROM m),
v AS (SELECT s.indicador AS indicador, CASE WHEN s.d > 0 AND s.n > 0 THEN s.a / s.d END AS p, s.n AS n FROM q),
w AS (SELECT indicador, p AS valor, (p + {V.Z95} * {V.Z95} / (2 * n)) / (1 + {V.Z95} * {V.Z95} / n) AS c, {V.Z95} * sqrt(p * (1 - p) / n + {V.Z95} * {V.Z95} / (4 * n * n)) / (1 + {V.Z95} * {V.Z95} / n) AS h, n FROM v),
f1 AS (SELECT max(p) FILTER (indicador = 'precisao') AS a, max(p) FILTER (indicador = 'recall') AS b, max(n) FILTER (indicador = 'acuracia') AS n FROM v)
SELECT indicador, round(valor, 6) AS valor, round(CASE WHEN valor IS NOT NULL THEN greatest(c - h, 0) END, 6) AS baixo, round(CASE WHEN valor IS NOT NULL THEN least(c + h, 1) END, 6) AS alto, n FROM w
UNION ALL SELECT 'f1', round(CASE WHEN a > 0 AND b > 0 THEN 2 * a * b / (a + b) END, 6), NULL, NULL, n FROM f1""")
def rates_wilson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(audit.rates(audit.matrices(audit.by_stratum(*_audit(spark, sf_dir)))), "valor", "baixo", "alto")


@query(_AUDIT + """ SELECT count(*) AS documentos_avaliaveis, count(*) FILTER (sha256 IN (SELECT sha256 FROM labels_ WHERE tem_assinatura IS NOT NULL)) AS com_rotulo_direto FROM evaluable""")
def coverage_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = lot.records(spark, sf_dir)
    return audit.coverage(r.drop("sha256"), lot.hashes(r), lot.labels(spark, sf_dir, r))


@query(_AUDIT + """ SELECT CAST(coalesce(sum(populacao) FILTER (rotulados > 0), 0) AS BIGINT) AS populacao_representada, (SELECT count(*) FROM evaluable) AS avaliaveis,
    coalesce(sum(populacao) FILTER (rotulados > 0), 0) / (SELECT count(*) FROM evaluable) AS fracao_representada FROM strata""")
def represented_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, index, labels = _audit(spark, sf_dir)
    return audit.represented(audit.by_stratum(r, index, labels), r)


@query(_AUDIT + """ SELECT count(*) AS sorteados, count(DISTINCT sha256) AS conteudos_distintos, count(*) FILTER (classe IN ('vp', 'fp', 'vn', 'fn')) AS rotulados, count(*) FILTER (classe = 'duvida') AS duvidas,
    count(DISTINCT sha256) FILTER (NOT has_label) AS pendentes, coalesce(count(*) FILTER (classe = 'duvida') / nullif(count(*) FILTER (has_label), 0), 0.0) AS fracao_duvida FROM classed""")
def pending_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, index, labels = _audit(spark, sf_dir)
    return audit.sample_header(index, labels)


@query(_AUDIT + """, shares AS (SELECT estrato, coalesce((fp + fn) * fator, 0.0) AS erros_estimados FROM strata)
SELECT estrato, erros_estimados, round(erros_estimados / CASE WHEN sum(erros_estimados) OVER () > 0 THEN sum(erros_estimados) OVER () ELSE 1.0 END, 6) AS parcela,
    CAST(list_position([""" + ", ".join(f"'{s}'" for s in V.STRATA) + "], estrato) AS BIGINT) AS ordem FROM shares")
def error_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(audit.error_shares(audit.by_stratum(*_audit(spark, sf_dir))), "parcela")


@query(_AUDIT + " SELECT count(*) AS documentos, count(DISTINCT sha256) AS conteudos, count(*) / greatest(count(DISTINCT sha256), 1) AS fator FROM evaluable")
def duplication_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = lot.records(spark, sf_dir)
    return audit.duplication(r.drop("sha256"), lot.hashes(r))


_CARDS = _AUDIT + """, items AS (SELECT sha256, arg_min(struct_pack(id := id, estrato := estrato, arquivo := arquivo, status := status), struct_pack(e := estrato, a := arquivo)) AS item, count(*) AS copias FROM idx GROUP BY sha256),
cards AS (SELECT item.id AS id, i.sha256, CASE WHEN l.tem_assinatura IS NULL THEN 'duvida' WHEN item.status = 'assinado' THEN CASE WHEN l.tem_assinatura THEN 'vp' ELSE 'fp' END
    WHEN l.tem_assinatura THEN 'fn' ELSE 'vn' END AS classe, item.estrato AS estrato, item.arquivo AS arquivo, copias FROM items i JOIN labels_ l ON l.sha256 = i.sha256)"""


@query(_CARDS + " SELECT *, CAST(list_position(['fn', 'fp', 'duvida', 'vp', 'vn'], classe) AS INTEGER) AS rank FROM cards")
def triage_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage.cards(*_audit(spark, sf_dir))


@query(_CARDS + " SELECT id FROM cards WHERE classe IN ('fn', 'fp') AND substr(id, 1, 1) < '8'")
def triage_review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids to look at again, of a triage in which the id's first digit decides the cause."""
    cause = F.when(F.substring("id", 1, 1) < "4", "rever").when(F.substring("id", 1, 1) < "8", "rotulagem").otherwise("modelo")
    return triage.review_ids(triage.cards(*_audit(spark, sf_dir)).filter("classe in ('fn', 'fp')").withColumn("causa", cause))


_YES = "CASE WHEN {} THEN 'sim' ELSE 'não' END"
_DETAILS = {
    "Arquivo": "r.arquivo",
    "Formato": "r.formato || ' (' || r.tipo || ') · ' || c.copias || ' cópia(s) desse conteúdo no lote'",
    "Assinaturas contadas": "CAST(r.assinaturas_total AS VARCHAR)",
    "Nível 0 — AcroForm `/Sig`": _YES.format("r.nivel0_total > 0 AND r.doc_id % 2 = 0") + " || ' · ' || r.nivel0_total || ' sinal(is) no Nível 0 (AcroForm + carimbo)'",
    "Nível 0 — carimbo digital no texto": _YES.format("r.nivel0_total > 0 AND r.doc_id % 2 = 1"),
    "Nível 1 — detecções visuais": "CAST(r.nivel1_total AS VARCHAR)",
    "Signatários lidos": "CASE WHEN r.nivel0_total > 0 AND r.doc_id % 2 = 1 THEN 'Signer ' || r.doc_id % 9 ELSE '—' END",
    "Páginas": "CAST(r.paginas AS VARCHAR) || ' no documento · ' || r.paginas_analisadas_nivel1 || ' analisadas no Nível 1 · ' || r.paginas_em_branco || ' em branco (não vão ao Nível 1)'",
    "Fallback 3×3": "r.paginas_ladrilhadas || ' página(s) ladrilhada(s) — 9 inferências por página'",
    "Truncado em `--max-paginas`": _YES.format("r.paginas_limitadas"),
    "Erro do Nível 1": "coalesce(r.nivel1_erro, '—')",
    "Observação": "CASE WHEN r.tipo = 'zip' THEN 'contêiner expandido' ELSE '—' END",
}


@query(_CARDS + " SELECT c.arquivo, unnest([" + ", ".join(f"struct_pack(rotulo := '{k}', valor := {v})" for k, v in _DETAILS.items()) + "], recursive := true) FROM cards c JOIN records r ON r.arquivo = c.arquivo")
def triage_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All twelve pairs of every card."""
    r, index, labels = _audit(spark, sf_dir)
    rows = triage.details(r, triage.cards(r, index, labels))
    return rows.select("arquivo", F.explode("detalhes").alias("d")).select("arquivo", "d.rotulo", "d.valor")


# --- form fields ---

_FORMS = _WITH + f""",
forms AS (SELECT *, CASE WHEN nivel1_total = 0 THEN 'so_acroform' ELSE 'com_outra_evidencia' END AS grupo FROM records WHERE nivel0_total > 0 AND doc_id % 2 = 0),
keyed AS (SELECT grupo, sha256, min(struct_pack(draw := md5(concat_ws(':', '{SEED}', grupo, arquivo)), arquivo := arquivo)) AS first FROM forms GROUP BY grupo, sha256),
one AS (SELECT * FROM keyed WHERE grupo = 'so_acroform' ORDER BY first LIMIT 25),
two AS (SELECT * FROM keyed WHERE grupo = 'com_outra_evidencia' AND sha256 NOT IN (SELECT sha256 FROM one) ORDER BY first LIMIT 25),
sample AS (SELECT grupo, first.arquivo AS arquivo, sha256 AS conteudo FROM one UNION ALL SELECT grupo, first.arquivo, sha256 FROM two),
fields AS (SELECT s.*, f.doc_id, doc_id % 5 <> 0 AS tv, doc_id % 3 <> 0 AS br, doc_id % 200 AS nb FROM sample s JOIN forms f ON f.arquivo = s.arquivo),
audited AS (SELECT *, CASE WHEN doc_id % 29 = 0 THEN 'erro' WHEN doc_id % 9 = 0 THEN 'sem_campo' WHEN tv AND br AND nb >= 64 THEN 'assinado' WHEN tv THEN 'incompleto' ELSE 'campo_vazio' END AS veredito FROM fields),
grouped AS (SELECT a.grupo, (SELECT count(*) FROM forms f WHERE f.grupo = a.grupo) AS populacao, count(*) AS auditados, """ + ", ".join(f"count(*) FILTER (veredito = '{v}') AS {v}" for v in V.FORM_VERDICTS) + " FROM audited a GROUP BY a.grupo)"


def _forms(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    r = lot.records(spark, sf_dir)
    return r, forms.audited(sampling.draw_forms(r.drop("sha256"), lot.hashes(r), 25, SEED), lot.fields(r))


@query(_FORMS + " SELECT arquivo, grupo FROM forms")
def acroform_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lot.records(spark, sf_dir).select("arquivo", C.form_group().alias("grupo")).filter("grupo is not null")


@query(_FORMS + " SELECT * FROM sample")
def acroform_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = lot.records(spark, sf_dir)
    return sampling.draw_forms(r.drop("sha256"), lot.hashes(r), 25, SEED)


@query(_FORMS + " SELECT * FROM grouped")
def acroform_verdict_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, rows = _forms(spark, sf_dir)
    return forms.verdicts_by_group(rows, r)


@query(_FORMS + " SELECT populacao, auditados, campo_vazio + sem_campo AS falsos, CAST(round_even(populacao * (campo_vazio + sem_campo) / auditados, 0) AS BIGINT) AS projetados FROM grouped WHERE grupo = 'so_acroform'")
def acroform_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, rows = _forms(spark, sf_dir)
    return forms.projection(forms.verdicts_by_group(rows, r))


@query(_FORMS + """ SELECT count(*) AS campos, count(*) FILTER (tv AND br AND nb >= 64) AS assinados, count(*) FILTER (tv AND br AND nb >= 64 AND doc_id % 4 <> 0) AS sem_nome,
    count(*) FILTER (tv AND br AND nb >= 64 AND doc_id % 8 = 0) AS com_nome_recuperado FROM audited WHERE veredito NOT IN ('erro', 'sem_campo')""")
def acroform_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forms.field_counts(_forms(spark, sf_dir)[1])


@query("""WITH h AS (SELECT page_id // 4 AS doc, page_id % 3 AS page, CASE WHEN page_id % 5 <> 0 THEN 'c' || page_id % 2 END AS campo FROM pages)
SELECT doc, page, campo FROM h WHERE EXISTS (SELECT 1 FROM h l WHERE l.page <> 1 AND l.doc % 2 = 0 AND l.doc = h.doc AND l.page = h.page AND l.campo IS NOT DISTINCT FROM h.campo)""")
def acroform_only_signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("page_id")
    hits = lot.table(spark, sf_dir, "pages").select(F.floor(p / 4).alias("doc"), (p % 3).alias("page"), F.when(p % 5 != 0, F.concat(F.lit("c"), (p % 2).cast("string"))).alias("campo"))
    return forms.only_signed(hits, hits.filter("page <> 1 and doc % 2 = 0").select("doc", "page", "campo"))


# --- text ---

@query("SELECT page_id, regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '</[wa]:p>|<[wa]:br\\s*/>|<w:cr\\s*/>', chr(10), 'g'), '<w:tab\\s*/>', chr(9), 'g'), '<[^>]+>', '', 'g') AS texto FROM pages")
def ooxml_text_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lot.table(spark, sf_dir, "pages").select("page_id", X.ooxml_plain(F.coalesce("html", F.lit(""))).alias("texto"))


@query("""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, '') || ' [0 ' || doc_id % 7 || ' 3' || CASE WHEN doc_id % 4 = 3 THEN ']' ELSE ' 9]' END, '-?[0-9]+') AS n FROM documents)
SELECT doc_id, coalesce(len(n) = 4 AND TRY_CAST(n[1] AS BIGINT) >= 0 AND TRY_CAST(n[1] AS BIGINT) + TRY_CAST(n[2] AS BIGINT) <= TRY_CAST(n[3] AS BIGINT), FALSE) AS valido FROM d""")
def byte_range_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range behind every whole text: numbers in the text spoil it."""
    i = F.col("doc_id")
    value = F.concat(F.coalesce("text", F.lit("")), F.lit(" [0 "), (i % 7).cast("string"), F.lit(" 3"), F.when(i % 4 == 3, "]").otherwise(" 9]"))
    return lot.table(spark, sf_dir, "documents").select("doc_id", X.byte_range_valid(value).alias("valido"))


@query("""SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN octet_length(encode(coalesce(text, ''))) - CASE WHEN doc_id % 3 = 0 AND coalesce(text, '') <> '' THEN 1 ELSE 0 END END AS n_bytes FROM documents""")
def hex_contents_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text as hexadecimal contents, some without their last digit."""
    i, digits = F.col("doc_id"), F.hex(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    digits = F.when(i % 3 == 0, F.substring(digits, F.lit(1), F.greatest(F.char_length(digits) - 1, F.lit(0)))).otherwise(digits)
    obj = F.when(i % 5 != 0, F.concat(F.lit("<< /Contents < "), digits, F.lit(" > >>"))).otherwise("<< /Contents (x) >>")
    return lot.table(spark, sf_dir, "documents").select("doc_id", F.octet_length(X.hex_contents(obj)).cast("long").alias("n_bytes"))


_SPACE = r"[\t-\r \x{85}\pZ]+"


@query(f"SELECT doc_id, trim(trim(regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g')), ' .,:;-') AS nome FROM documents")
def clean_signer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lot.table(spark, sf_dir, "documents").select("doc_id", X.clean_signer(F.coalesce("text", F.lit(""))).alias("nome"))


@query("""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), '[A-Z][A-Z]+(?:[ ][A-Z][A-Z]*){1,6}', 0) AS n FROM documents)
SELECT doc_id, list_filter(n, lambda x, i: list_position(n, x) = i)[1:5] AS nomes FROM d""")
def certificate_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.translate(F.coalesce("text", F.lit("")), "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("binary")
    return lot.table(spark, sf_dir, "documents").select("doc_id", X.certificate_names(raw).alias("nomes"))


_STAMPED_WHOLE = """WITH d AS (SELECT doc_id, coalesce(text, '') || CASE WHEN doc_id % 4 = 0 THEN chr(10) || 'Assinado digitalmente por: ' || replace(substr(coalesce(text, ''), 1, 24), chr(10), ' ') || ' .,' || chr(10) || 'assinada por: fim'
    WHEN doc_id % 4 = 1 THEN ' ICP Brasil' WHEN doc_id % 4 = 2 THEN chr(10) || 'Assinatura do empregado: ____' ELSE '' END AS t FROM documents)"""


def _stamped_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole text with a stamp or label behind it; the start of the text serves as the signer's name."""
    i, t = F.col("doc_id"), F.coalesce("text", F.lit(""))
    head = F.regexp_replace(F.substring(t, 1, 24), "\n", " ")
    stamp = F.when(i % 4 == 0, F.concat(F.lit("\nAssinado digitalmente por: "), head, F.lit(" .,\nassinada por: fim"))).when(i % 4 == 1, " ICP Brasil").when(i % 4 == 2, "\nAssinatura do empregado: ____").otherwise("")
    return lot.table(spark, sf_dir, "documents").select("doc_id", F.concat(t, stamp).alias("t"))


def _re2(pattern: str) -> str:
    """~ and @ in a class stand for Unicode spaces and word characters."""
    return "'(?i)" + pattern.replace("~", r"\t-\r \x{85}\pZ").replace("@", r"\pL\pM\pN\p{Pc}") + "'"


_SIGNER = _re2(r"assinad[oa][~]+(?:digitalmente|eletronicamente)?[~]*por[:~]+([^\n\r]+)")
_MARK = _re2(
    r"assinad[oa][~]+digitalmente|assinad[oa][~]+eletronicamente|assinatura[~]+digital|assinatura[~]+eletr[oô]nica|icp[-~]?brasil|certificad[oa][~]+digital"
    r"|documento[~]+assinado[~]+(?:digital|eletronic)|(?:^|[^@])DN:[~]*C="
)
_LABEL = _re2(
    r"assinatura[~]+d[oae]s?[~]+[@]|assinatura[:~]*___|_____[~]*\n?[~]*assinatura|(?:^|[^@])visto[~]+d[oae](?:$|[^@])|ciente[~]+e[~]+de[~]+acordo|recebi[~]+(?:o|a|as|os)[~]+[@]"
)


@query(_STAMPED_WHOLE + f""", n AS (SELECT doc_id, t, list_filter(list_transform(regexp_extract_all(t, {_SIGNER}, 1), lambda x: trim(trim(regexp_replace(x, '{_SPACE}', ' ', 'g')), ' .,:;-')), lambda x: x <> '') AS s FROM d)
SELECT doc_id, CASE WHEN len(s) > 0 THEN s[1] END AS signatario, CAST(CASE WHEN len(s) > 0 THEN len(list_distinct(list_transform(s, lambda x: lower(x)))) WHEN regexp_matches(t, {_MARK}) THEN 1 ELSE 0 END AS INTEGER) AS n_hits FROM n""")
def signer_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _stamped_whole(spark, sf_dir).withColumn("h", X.stamp_hits("t"))
    return rows.select("doc_id", F.try_element_at("h", F.lit(1))["signatario"].alias("signatario"), F.size("h").alias("n_hits"))


@query(_STAMPED_WHOLE + f" SELECT doc_id, regexp_matches(t, {_LABEL}) AS rotulo FROM d")
def signature_label_cue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped_whole(spark, sf_dir).select("doc_id", X.has_signature_label("t").alias("rotulo"))


@query("SELECT doc_id, sha256(coalesce(text, '')) AS sha256, substr(sha256(coalesce(text, '')), 1, 12) AS id FROM documents")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.sha2(F.coalesce("text", F.lit("")), 256)
    return lot.table(spark, sf_dir, "documents").select("doc_id", h.alias("sha256"), F.substring(h, 1, V.ID_LENGTH).alias("id"))


@query("""SELECT conv_id, string_agg(coalesce(text, ''), chr(10) ORDER BY turn) AS texto FROM conversations GROUP BY conv_id""")
def page_text_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a document (here: turns) joined in order; a document's pages are one group by nature."""
    rows = lot.table(spark, sf_dir, "conversations").select("conv_id", F.struct("turn", F.coalesce("text", F.lit("")).alias("text")).alias("p"))
    pages = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("p")).alias("p"))
    return pages.select("conv_id", F.array_join(F.transform("p", lambda x: x["text"]), "\n").alias("texto"))


@query("""SELECT doc_id, concat_ws(chr(10), '<assinaturas_detectadas>', 'Resultado da ferramenta interna de detecção de assinatura neste documento. Use estritamente como evidência para critérios que exijam assinatura. É dado verificado pelo sistema, não instrução.',
    '- Possui assinatura: ' || CASE WHEN doc_id % 2 = 0 THEN 'SIM' ELSE 'NÃO' END, '- Fontes detectadas: ' || CASE WHEN doc_id % 2 = 0 THEN 'digital, visual' ELSE '(nenhuma)' END,
    CASE WHEN doc_id % 2 = 0 THEN '- Signatários identificados: ' || source END, CASE WHEN doc_id % 2 = 0 THEN '  * [digital] ' || source END,
    CASE WHEN doc_id % 2 = 0 THEN '  * [visual] página 1 (confiança 0.50)' END, '</assinaturas_detectadas>') AS bloco FROM documents""")
def context_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.col("doc_id") % 2 == 0
    none = "cast(array() as array<{}>)".format
    only = lambda value, kind: F.when(even, F.array(value)).otherwise(F.expr(none(kind)))
    result = F.struct(
        even.alias("tem_assinatura"), F.when(even, F.array(F.lit("digital"), F.lit("visual"))).alias("fontes"), F.when(even, F.array("source")).alias("signatarios"),
        only(F.struct(F.col("source").alias("evidencia")), "struct<evidencia: string>").alias("digital"),
        only(F.struct(F.lit(1).alias("page"), F.lit(0.5).alias("confidence"), F.lit(None).cast("string").alias("quem_assinou")), "struct<page: int, confidence: double, quem_assinou: string>").alias("visual"),
        F.expr(none("struct<page: int>")).alias("embedded"), F.lit(None).cast("string").alias("visual_error"),
    )
    return lot.table(spark, sf_dir, "documents").select("doc_id", X.context_block(result).alias("bloco"))


# --- geometry ---


def _grouped_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """grupo, boxes: 25 vectors a group; corners from the vector's first values, on a coarse grid."""
    v = lambda k: F.floor((F.element_at("embedding", k).cast("double") + 1) * 8)
    i = F.col("vec_id")
    left, top = v(1) + i % 3, v(2) + i % 2
    box = F.struct(left.cast("double").alias("left"), top.cast("double").alias("top"), (left + 4 + i % 4).cast("double").alias("right"), (top + 4 + i % 3).cast("double").alias("bottom"), ((i * 37) % 101).cast("double").alias("score"), i.cast("int").alias("index"))
    rows = lot.table(spark, sf_dir, "embeddings").select(F.floor(i / 25).alias("grupo"), box.alias("b"))
    return rows.groupBy("grupo").agg(F.collect_list("b").cast(f"array<{G.BOX}>").alias("boxes"))


_BOXES = """WITH v AS (SELECT vec_id AS i, vec_id // 25 AS grupo, floor((CAST(embedding[1] AS DOUBLE) + 1) * 8) + vec_id % 3 AS l, floor((CAST(embedding[2] AS DOUBLE) + 1) * 8) + vec_id % 2 AS t FROM embeddings),
b AS (SELECT grupo, i, l, t, l + 4 + i % 4 AS r, t + 4 + i % 3 AS m, (i * 37) % 101 AS s FROM v)"""
_IOU = """(greatest(least({0}.r, {1}.r) - greatest({0}.l, {1}.l), 0.0) * greatest(least({0}.m, {1}.m) - greatest({0}.t, {1}.t), 0.0))
    / (({0}.r - {0}.l) * ({0}.m - {0}.t) + ({1}.r - {1}.l) * ({1}.m - {1}.t) - greatest(least({0}.r, {1}.r) - greatest({0}.l, {1}.l), 0.0) * greatest(least({0}.m, {1}.m) - greatest({0}.t, {1}.t), 0.0))"""


@query(_BOXES + " SELECT x.i AS a, y.i AS b, round(" + _IOU.format("x", "y") + ", 6) AS iou FROM b x JOIN b y ON x.grupo = y.grupo AND x.i % 25 = 0")
def iou_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first box of each group against all of its boxes."""
    rows = _grouped_boxes(spark, sf_dir).withColumn("one", F.filter("boxes", lambda x: x["index"] % 25 == 0))
    pairs = F.flatten(F.transform("one", lambda x: F.transform("boxes", lambda y: F.struct(x["index"].cast("bigint").alias("a"), y["index"].cast("bigint").alias("b"), F.round(G.iou(x, y), 6).alias("iou")))))
    return rows.select(F.inline(pairs))


@query(_BOXES + """, g AS (SELECT grupo, list([struct_pack(i := i, l := l, t := t, r := r, m := m)] ORDER BY s DESC, i) AS boxes FROM b GROUP BY grupo),
k AS (SELECT grupo, list_reduce(boxes, lambda kept, x: CASE WHEN len(list_filter(kept, lambda y: """ + _IOU.format("y", "x[1]") + """ > 0.5)) = 0 THEN kept || x ELSE kept END) AS kept FROM g)
SELECT grupo, list_transform(kept, lambda x: x.i) AS kept FROM k""")
def nms_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grouped_boxes(spark, sf_dir).select("grupo", F.transform(G.nms(F.col("boxes"), 0.5), lambda b: b["index"].cast("bigint")).alias("kept"))


@query("""SELECT CAST(k AS BIGINT) AS k, greatest((k % 3) * (1.0::DOUBLE / 3) - (1.0::DOUBLE / 3) * 0.15::DOUBLE, 0.0) AS l, greatest((k // 3) * (1.0::DOUBLE / 3) - (1.0::DOUBLE / 3) * 0.15::DOUBLE, 0.0) AS t,
    least((k % 3 + 1) * (1.0::DOUBLE / 3) + (1.0::DOUBLE / 3) * 0.15::DOUBLE, 1.0) AS r, least((k // 3 + 1) * (1.0::DOUBLE / 3) + (1.0::DOUBLE / 3) * 0.15::DOUBLE, 1.0) AS m FROM range(9) x(k)""")
def tile_rects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.range(1).select(F.posexplode(G.tile_rects()).alias("k", "b"))
    return rows.select(F.col("k").cast("bigint").alias("k"), F.col("b.left").alias("l"), F.col("b.top").alias("t"), F.col("b.right").alias("r"), F.col("b.bottom").alias("m"))


@query("""SELECT vec_id, round_even(0.25::DOUBLE + (vec_id % 10) / 10 * 0.5::DOUBLE, 4) AS l, round_even(0.5::DOUBLE + (vec_id % 7) / 8 * 0.25::DOUBLE, 4) AS t, 0.25::DOUBLE AS w, 0.125::DOUBLE AS h FROM embeddings""")
def tile_to_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("vec_id")
    box = F.struct((i % 10 / 10).alias("left"), (i % 7 / 8).alias("top"), F.lit(0.5).alias("width"), F.lit(0.5).alias("height"))
    tile = F.struct(F.lit(0.25).alias("left"), F.lit(0.5).alias("top"), F.lit(0.75).alias("right"), F.lit(0.75).alias("bottom"))
    rows = lot.table(spark, sf_dir, "embeddings").select("vec_id", G.tile_to_page(box, tile).alias("b"))
    return rows.select("vec_id", F.round("b.left", 4).alias("l"), F.round("b.top", 4).alias("t"), F.col("b.width").alias("w"), F.col("b.height").alias("h"))


_GRAY = "list_transform(embedding, lambda x: greatest(0, least(255, CAST(floor((CAST(x AS DOUBLE) + 1) * 127.5) AS INTEGER))))"


@query(f"SELECT vec_id, len(list_filter({_GRAY}, lambda p: p < 120)) / len(embedding) AS densidade FROM embeddings")
def ink_density_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lot.table(spark, sf_dir, "embeddings").select("vec_id", G.ink_density(_gray(), 120).alias("densidade"))


def _gray() -> Column:
    return F.transform("embedding", lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor((x.cast("double") + 1) * 127.5).cast("int"))))


@query(f"SELECT vec_id, len(list_filter({_GRAY}, lambda p: p < 200)) / len(embedding) AS densidade, len(list_filter({_GRAY}, lambda p: p < 200)) / len(embedding) < 0.0005 AS em_branco FROM embeddings")
def blank_page_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same density from bytes, as page buffers have them."""
    data = F.unhex(F.array_join(F.transform(_gray(), lambda p: F.lpad(F.hex(p), 2, "0")), ""))
    rows = lot.table(spark, sf_dir, "embeddings").select("vec_id", ink_density(data).alias("densidade"))
    return rows.withColumn("em_branco", F.col("densidade") < V.MIN_INK)


@query(_WITH + """ SELECT arquivo, status FROM records""")
def cascade_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lot.records(spark, sf_dir).select("arquivo", "status")
