"""Named queries over the driver's tables, each with the DuckDB SQL that must give the same rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions import text as T
from tributary.functions.calendar import with_working_days
from tributary.operators import audit as A
from tributary.operators import batches as B
from tributary.operators import classify as C
from tributary.operators import companies as K
from tributary.operators import emails as E
from tributary.operators import extract as X
from tributary.operators import logs as L
from tributary.operators import metrics as M
from tributary.operators import pairing as P
from tributary.operators import reports as R
from tributary.operators import xmls as XM
from tributary.sources import readers as RD
from tributary.sources import sinks as W
from tributary.sources import tables as S
from tributary.streaming import events as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def add(name: str, query: Query, sql: str | None = None, *views: str) -> None:
    QUERIES[name] = query
    if sql:
        ORACLE[name] = S.sql(sql, *views)


# ---- batches

PRIORITY = "CASE doc_type WHEN 'NFSE' THEN 0 WHEN 'DANFE' THEN 1 WHEN 'OUTRO' THEN 2 ELSE 3 END"
DUE_PRIORITY = "CASE doc_type WHEN 'NFSE' THEN 0 WHEN 'DANFE' THEN 1 WHEN 'BOLETO' THEN 2 ELSE 3 END"
BUY = f"buy AS (SELECT batch_id, coalesce(arg_min(valor, {PRIORITY} * 100000 + ordinal) FILTER (valor > 0), 0) AS valor_compra, arg_min(CASE doc_type WHEN 'OUTRO' THEN 'OUTROS' ELSE doc_type END, {PRIORITY} * 100000 + ordinal) FILTER (valor > 0) AS fonte FROM docs GROUP BY batch_id)"
RECONCILED = f"""{BUY}, slip AS (
  SELECT batch_id, sum(CASE WHEN doc_type = 'BOLETO' THEN valor::DECIMAL(18,2) ELSE 0 END)::DECIMAL(18,2) AS slip, count(vencimento) AS dated FROM docs GROUP BY batch_id
), rec AS (
  SELECT batch_id, fonte, valor_compra::DECIMAL(18,2) AS bought, slip, bought - slip AS diff, dated,
    CASE WHEN bought > 0 AND slip > 0 THEN CASE WHEN abs(bought - slip) <= 0.01 THEN 'CONCILIADO' ELSE 'DIVERGENTE' END ELSE 'CONFERIR' END AS status
  FROM buy JOIN slip USING (batch_id))"""

add("purchase_value_by_priority", lambda s, d: B.purchase_value(S.documents(s, d)), f"WITH {BUY} SELECT * FROM buy", "docs")
add("reconcile_status", lambda s, d: B.reconciled(S.documents(s, d)).groupBy("status", F.coalesce("fonte", F.lit("-")).alias("fonte")).agg(F.count("*").alias("lotes"), F.sum(F.col("valor_compra").cast("decimal(18,2)")).cast("double").alias("compra"), F.sum(F.col("valor_boleto").cast("decimal(18,2)")).cast("double").alias("boleto")),
    f"WITH {RECONCILED} SELECT status, coalesce(fonte, '-') AS fonte, count(*) AS lotes, sum(bought)::DOUBLE AS compra, sum(slip)::DOUBLE AS boleto FROM rec GROUP BY ALL", "docs")
add("reconcile", lambda s, d: B.reconciled(S.documents(s, d)),
    f"""WITH {RECONCILED} SELECT batch_id, status, fonte, bought::DOUBLE AS valor_compra, slip::DOUBLE AS valor_boleto, diff::DOUBLE AS diferenca,
    nullif(concat_ws(' ', CASE WHEN status = 'DIVERGENTE' THEN 'Valor compra: R$ ' || bought || ' | Valor boleto: R$ ' || slip || ' | Diferença: R$ ' || diff::DECIMAL(18,2)
      WHEN status = 'CONFERIR' AND slip > 0 THEN 'Conferir boleto (R$ ' || slip || ')' WHEN status = 'CONFERIR' THEN 'Conferir valor (R$ ' || bought || ') - sem boleto para comparação' END,
      CASE WHEN fonte = 'OUTROS' THEN '[VALOR DE OUTROS]' END, CASE WHEN dated = 0 THEN '[VENCIMENTO NÃO ENCONTRADO]' END), '') AS divergencia FROM rec""", "docs")  # fmt: skip
add("first_due_date_by_priority", lambda s, d: B.first_due_date(S.documents(s, d)), f"SELECT batch_id, arg_min(vencimento, {DUE_PRIORITY} * 100000 + ordinal) FILTER (vencimento IS NOT NULL) AS vencimento FROM docs GROUP BY batch_id", "docs")
add("first_supplier_by_priority", lambda s, d: B.first_supplier(S.documents(s, d)), f"SELECT batch_id, arg_min(fornecedor_nome, {PRIORITY} * 100000 + ordinal) AS fornecedor FROM docs GROUP BY batch_id", "docs")
_LEVELS = [("NFSE", "numero_nota"), ("DANFE", "numero_nota"), ("NFSE", "numero_pedido"), ("DANFE", "numero_pedido"), ("OUTRO", "numero_documento"), ("BOLETO", "numero_documento")]
add("first_number_by_priority", lambda s, d: B.first_number(S.documents(s, d)), "SELECT batch_id, coalesce(" + ", ".join(f"arg_min({c}, ordinal) FILTER (doc_type = '{t}' AND {c} IS NOT NULL)" for t, c in _LEVELS) + ") AS numero_nota FROM docs GROUP BY batch_id", "docs")
_TOTAL = lambda t, n: f"sum(CASE WHEN doc_type = '{t}' THEN valor::DECIMAL(18,2) ELSE 0 END)::DOUBLE AS {n}"
add("batch_summary", lambda s, d: B.batch_summary(S.documents(s, d)),
    f"""SELECT batch_id, count(*) AS total_documentos, count(*) FILTER (doc_type = 'DANFE') AS danfes, count(*) FILTER (doc_type = 'BOLETO') AS boletos, count(*) FILTER (doc_type = 'NFSE') AS nfses, count(*) FILTER (doc_type = 'OUTRO') AS outros,
    {_TOTAL('DANFE', 'valor_danfes')}, {_TOTAL('BOLETO', 'valor_boletos')}, {_TOTAL('NFSE', 'valor_nfses')}, count(*) FILTER (doc_type = 'BOLETO') > 0 AS tem_boleto, count(*) FILTER (vencimento IS NULL) AS sem_vencimento FROM docs GROUP BY batch_id""", "docs")  # fmt: skip
add("duplicates_by_number", lambda s, d: B.duplicates_by_number(S.documents(s, d)), "SELECT batch_id, numero_nota AS numero, count(*) AS vezes, string_agg(arquivo_origem, ',' ORDER BY ordinal) AS arquivos FROM docs WHERE doc_type IN ('NFSE', 'DANFE') AND numero_nota IS NOT NULL GROUP BY ALL HAVING count(*) > 1", "docs")
add("duplicates_by_supplier_value", lambda s, d: B.duplicates_by_supplier_value(S.documents(s, d).withColumn("valor", F.round(F.col("valor") / 1000) * 1000)), "SELECT batch_id, upper(fornecedor_nome)[1:30] AS fornecedor, (round(valor / 1000) * 1000)::DOUBLE AS valor, count(*) AS vezes FROM docs WHERE round(valor / 1000) > 0 GROUP BY ALL HAVING count(*) > 1", "docs")
add("has_multiple_invoices", lambda s, d: B.has_multiple_invoices(S.documents(s, d)), "SELECT batch_id, count(*) FILTER (doc_type IN ('NFSE', 'DANFE')) > 1 AS multiplas FROM docs GROUP BY batch_id", "docs")
_KEYS = ["batch_id", "ordinal"]
_INHERIT = "SELECT d.batch_id, d.ordinal::INTEGER AS ordinal, {} FROM docs d LEFT JOIN (SELECT batch_id, {} FROM docs GROUP BY batch_id) b USING (batch_id)"
_FIRST = lambda c, w, n: f"arg_min({c}, ordinal) FILTER ({w} AND {c} IS NOT NULL) AS {n}"
add("inherit_due_date", lambda s, d: B.inherited(S.documents(s, d)).select(*_KEYS, "vencimento"), _INHERIT.format("CASE WHEN doc_type IN ('DANFE', 'NFSE') THEN coalesce(vencimento, v) ELSE vencimento END AS vencimento", _FIRST("vencimento", "doc_type = 'BOLETO'", "v")), "docs")
add("inherit_number", lambda s, d: B.inherited(S.documents(s, d)).select(*_KEYS, "referencia_nfse"), _INHERIT.format("CASE WHEN doc_type = 'BOLETO' THEN coalesce(x, y, z) END AS referencia_nfse", ", ".join([_FIRST("numero_nota", "doc_type = 'DANFE'", "x"), _FIRST("numero_nota", "doc_type = 'NFSE'", "y"), _FIRST("numero_documento", "doc_type = 'OUTRO'", "z")])), "docs")
add("inherit_order_number", lambda s, d: B.inherited(S.documents(s, d)).select(*_KEYS, "numero_pedido"), _INHERIT.format("coalesce(numero_pedido, p) AS numero_pedido", _FIRST("numero_pedido", "true", "p")), "docs")


def _metadata(s: SparkSession, d: str) -> DataFrame:
    o = S.load(s, d, "orders")
    return o.select(F.col("o_orderkey").alias("batch_id"), F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("email_vencimento"), F.concat(F.lit("E"), F.col("o_orderkey").cast("string")).alias("email_pedido"), F.col("o_orderkey").cast("string").alias("email_nota"))


add("inherit_from_email", lambda s, d: B.inherited(S.documents(s, d), _metadata(s, d)).select(*_KEYS, "vencimento", "numero_pedido", "numero_nota"),
    "WITH m AS (SELECT o_orderkey AS batch_id, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS ev, 'E' || o_orderkey AS ep, o_orderkey::VARCHAR AS en FROM orders), b AS (SELECT batch_id, "
    + ", ".join([_FIRST("numero_nota", "doc_type IN ('DANFE', 'NFSE')", "x"), _FIRST("numero_documento", "doc_type = 'OUTRO'", "z"), _FIRST("vencimento", "doc_type = 'BOLETO'", "v"), _FIRST("numero_pedido", "true", "p")])
    + """ FROM docs GROUP BY batch_id) SELECT d.batch_id, d.ordinal::INTEGER AS ordinal, CASE WHEN v IS NULL THEN coalesce(vencimento, ev) WHEN doc_type IN ('DANFE', 'NFSE') THEN coalesce(vencimento, v) ELSE vencimento END AS vencimento,
    coalesce(numero_pedido, p, ep) AS numero_pedido, CASE WHEN coalesce(x, z) IS NULL AND doc_type IN ('DANFE', 'NFSE') THEN coalesce(numero_nota, en) ELSE numero_nota END AS numero_nota FROM docs d JOIN b USING (batch_id) LEFT JOIN m USING (batch_id)""", "docs")  # fmt: skip
add("batch_context", lambda s, d: B.with_context(S.documents(s, d)).select(*_KEYS, "status_conciliacao", "valor_compra"), f"WITH {RECONCILED} SELECT batch_id, ordinal::INTEGER AS ordinal, status AS status_conciliacao, bought::DOUBLE AS valor_compra FROM docs JOIN rec USING (batch_id)", "docs")
add("xml_missing_fields", lambda s, d: S.invoices(s, d).select(*_KEYS, F.array_join(B.missing_fields(), ",").alias("faltantes"), B.is_complete().alias("completo")),
    """SELECT batch_id, ordinal::INTEGER AS ordinal, concat_ws(',', CASE WHEN vencimento IS NULL THEN 'vencimento' END, CASE WHEN numero_nota IS NULL THEN 'numero_nota' END, CASE WHEN valor <= 0 THEN 'valor' END) AS faltantes,
    doc_type <> 'OUTRO' AND vencimento IS NOT NULL AND numero_nota IS NOT NULL AND valor > 0 AS completo FROM invoices""", "invoices")  # fmt: skip


def _split(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = S.invoices(s, d)
    return rows.filter("doc_type = 'NFSE'"), rows.filter("doc_type = 'DANFE'")


add("xml_complete_anti_join", lambda s, d: B.merged(*_split(s, d)).filter("doc_type = 'DANFE'").select(*_KEYS),
    """WITH p AS (SELECT * FROM invoices WHERE doc_type = 'DANFE'), m AS (
      SELECT x.batch_id, x.ordinal, min(p.ordinal) AS o FROM invoices x JOIN p ON p.batch_id = x.batch_id AND (p.numero_nota = x.numero_nota
        OR (x.valor > 0 AND upper(p.fornecedor_nome) = upper(x.fornecedor_nome) AND abs(round(p.valor * 100) - round(x.valor * 100)) <= 1)) WHERE x.doc_type = 'NFSE' GROUP BY ALL
    ), f AS (SELECT x.batch_id, coalesce(x.vencimento, p.vencimento) AS v, coalesce(x.numero_nota, p.numero_nota) AS n, CASE WHEN x.valor > 0 THEN x.valor ELSE coalesce(p.valor, x.valor) END AS w FROM invoices x LEFT JOIN m USING (batch_id, ordinal) LEFT JOIN p ON p.batch_id = m.batch_id AND p.ordinal = m.o WHERE x.doc_type = 'NFSE')
    SELECT batch_id, ordinal::INTEGER AS ordinal FROM p WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.batch_id = p.batch_id AND f.n = p.numero_nota AND f.v IS NOT NULL AND f.w > 0)""", "invoices")  # fmt: skip
add("xml_fill_from_pdf", lambda s, d: B.merged(*_split(s, d)).filter("doc_type = 'NFSE'").select(*_KEYS, "vencimento", "numero_nota", "numero_pedido", "valor"),
    """WITH p AS (SELECT * FROM invoices WHERE doc_type = 'DANFE'), m AS (
      SELECT x.batch_id, x.ordinal, min(p.ordinal) AS o FROM invoices x JOIN p ON p.batch_id = x.batch_id AND (p.numero_nota = x.numero_nota
        OR (x.valor > 0 AND upper(p.fornecedor_nome) = upper(x.fornecedor_nome) AND abs(round(p.valor * 100) - round(x.valor * 100)) <= 1)) WHERE x.doc_type = 'NFSE' GROUP BY ALL)
    SELECT x.batch_id, x.ordinal::INTEGER AS ordinal, coalesce(x.vencimento, p.vencimento) AS vencimento, coalesce(x.numero_nota, p.numero_nota) AS numero_nota, coalesce(x.numero_pedido, p.numero_pedido) AS numero_pedido,
      CASE WHEN x.valor > 0 THEN x.valor ELSE coalesce(p.valor, x.valor) END AS valor
    FROM invoices x LEFT JOIN m USING (batch_id, ordinal) LEFT JOIN p ON p.batch_id = m.batch_id AND p.ordinal = m.o WHERE x.doc_type = 'NFSE'""", "invoices")  # fmt: skip

# ---- pairing

_NORM = lambda c: f"coalesce(nullif(regexp_replace({c}, '^0+', ''), ''), '0')"
_KEYED = f"""k AS (
  SELECT batch_id, ordinal, CASE WHEN doc_type = 'BOLETO' THEN 'slip' ELSE 'invoice' END AS side, round(valor * 100)::BIGINT AS cents,
    CASE WHEN doc_type = 'BOLETO' THEN {_NORM('numero_documento')} WHEN numero_nota IS NOT NULL OR numero_documento IS NOT NULL THEN {_NORM('coalesce(numero_nota, numero_documento)')}
      WHEN doc_type <> 'OUTRO' THEN {_NORM("regexp_extract(arquivo_origem, 'NF (\\d+)', 1)")} ELSE '' END AS number
  FROM docs WHERE (doc_type = 'BOLETO' AND valor > 0) OR (doc_type <> 'BOLETO' AND (valor > 0 OR doc_type <> 'OUTRO')))"""
_STATUS = lambda a, b: f"CASE WHEN {a} > 0 AND {b} > 0 THEN CASE WHEN abs({a} - {b}) <= 1 THEN 'CONCILIADO' ELSE 'DIVERGENTE' END ELSE 'CONFERIR' END"
add("pair_relational", lambda s, d: P.paired_by_number(S.documents(s, d)),
    f"""WITH {_KEYED}, n AS (SELECT *, row_number() OVER (PARTITION BY batch_id, side, number ORDER BY ordinal) AS n FROM k WHERE number <> ''),
    p AS (SELECT batch_id, number, n, coalesce(max(cents) FILTER (side = 'invoice'), 0) AS nf, coalesce(max(cents) FILTER (side = 'slip'), 0) AS slip FROM n WHERE side = 'slip' OR cents > 0 GROUP BY ALL)
    SELECT batch_id, number, n::INTEGER AS n, nf / 100.0::DOUBLE AS valor_nf, slip / 100.0::DOUBLE AS valor_boleto, {_STATUS('nf', 'slip')} AS status FROM p""", "docs")  # fmt: skip
_NZ = lambda c: f"coalesce(nullif(ltrim({c}, '0'), ''), '0')"
_SAME = lambda a, b: f"({a} <> '' AND {b} <> '' AND (ends_with({_NZ(a)}, {_NZ(b)}) OR ends_with({_NZ(b)}, {_NZ(a)})))"
_ROW, _GROUP, _OUT = "{'cents': cents, 'number': number, 'file': arquivo_origem}", "STRUCT(cents BIGINT, number VARCHAR, files VARCHAR[])[]", "STRUCT(suffix VARCHAR, number VARCHAR, nf BIGINT, slip BIGINT, notes VARCHAR[], papers VARCHAR[], forced BOOLEAN)[]"
_FIRST_WHERE = lambda xs, cond: f"list_filter(list_transform({xs}, lambda y, ix: CASE WHEN {cond} THEN ix END), lambda z: z IS NOT NULL)[1]"


def _folded(name: str, source: str, match: str, cents: str, number: str) -> str:
    """SQL of the groups that rows fall into, one row after the other."""
    return f"""{name} AS (
  SELECT batch_id, {source} AS todo, 1 AS i, []::{_GROUP} AS gs FROM lists
  UNION ALL
  SELECT batch_id, todo, i + 1, CASE WHEN j IS NULL THEN list_append(gs, {{'cents': x.cents, 'number': x.number, 'files': [x.file]}})
    ELSE list_transform(gs, lambda y, ix: CASE WHEN ix = j THEN {{'cents': {cents}, 'number': {number}, 'files': list_append(y.files, x.file)}} ELSE y END) END
  FROM (SELECT *, todo[i] AS x, {_FIRST_WHERE('gs', match)} AS j FROM {name} WHERE i <= len(todo)))"""


_FOLD = f"""{_KEYED.replace("AS number\n  FROM", "AS number, arquivo_origem\n  FROM")}, lists AS (
  SELECT batch_id, coalesce(list({_ROW} ORDER BY ordinal) FILTER (side = 'invoice' AND cents > 0), []) AS inv, coalesce(list({_ROW} ORDER BY ordinal) FILTER (side = 'slip'), []) AS slips,
    coalesce(list({_ROW} ORDER BY ordinal) FILTER (side = 'invoice' AND cents = 0), []) AS lone
  FROM (SELECT DISTINCT batch_id FROM docs) LEFT JOIN k USING (batch_id) GROUP BY batch_id
), {_folded('g', 'inv', f"abs(y.cents - todo[i].cents) <= 1 OR {_SAME('y.number', 'todo[i].number')}", 'y.cents', "CASE WHEN x.number <> '' AND (y.number = '' OR length(x.number) < length(y.number)) THEN x.number ELSE y.number END")},
{_folded('p', 'slips', _SAME('y.number', 'todo[i].number'), 'y.cents + x.cents', 'y.number')}, w AS (
  SELECT g.batch_id, g.gs, p.gs AS ps, lone, inv, slips FROM g JOIN p USING (batch_id) JOIN lists USING (batch_id) WHERE g.i > len(g.todo) AND p.i > len(p.todo)
), m AS (
  SELECT batch_id, gs, ps, 1 AS i, []::BIGINT[] AS used, []::{_OUT} AS out FROM w
  UNION ALL
  SELECT batch_id, gs, ps, i + 1, CASE WHEN j IS NULL THEN used ELSE list_append(used, j) END,
    list_append(out, {{'suffix': CASE WHEN len(gs) > 1 AND x.number <> '' THEN '_' || x.number ELSE '' END, 'number': coalesce(nullif(x.number, ''), ps[j].number), 'nf': x.cents, 'slip': coalesce(ps[j].cents, 0), 'notes': x.files, 'papers': coalesce(ps[j].files, []), 'forced': false}})
  FROM (SELECT *, gs[i] AS x, {_FIRST_WHERE('ps', f"NOT list_contains(used, ix) AND ({_SAME('gs[i].number', 'y.number')} OR abs(gs[i].cents - y.cents) <= 1)")} AS j FROM m WHERE i <= len(gs))
), o AS (
  SELECT w.batch_id, w.inv, w.lone, w.slips, list_concat(out, list_transform(list_filter(m.ps, lambda y, ix: NOT list_contains(used, ix)), lambda y: {{'suffix': CASE WHEN y.number <> '' THEN '_bol_' || y.number ELSE '_bol' END, 'number': y.number, 'nf': 0, 'slip': y.cents, 'notes': []::VARCHAR[], 'papers': y.files, 'forced': false}})) AS out
  FROM m JOIN w USING (batch_id) WHERE m.i > len(m.gs)
), f AS (
  SELECT batch_id, CASE
    WHEN len(inv) = 0 AND len(lone) = 0 AND len(slips) = 0 THEN [{{'suffix': '', 'number': NULL, 'nf': 0, 'slip': 0, 'notes': []::VARCHAR[], 'papers': []::VARCHAR[], 'forced': false}}]
    WHEN len(lone) = 1 AND len(list_filter(out, lambda y: y.nf = 0)) = 1 AND len(list_filter(out, lambda y: y.nf = 0)[1].papers) = 1 THEN list_append(list_filter(out, lambda y: y.nf <> 0 AND y.slip <> 0),
      {{'suffix': '', 'number': coalesce(nullif(lone[1].number, ''), list_filter(out, lambda y: y.nf = 0)[1].number), 'nf': 0, 'slip': list_filter(out, lambda y: y.nf = 0)[1].slip, 'notes': [lone[1].file], 'papers': list_filter(out, lambda y: y.nf = 0)[1].papers, 'forced': true}})
    WHEN len(out) = 0 THEN [{{'suffix': '', 'number': list_filter(list_transform(lone, lambda y: y.number), lambda z: z <> '')[1], 'nf': 0, 'slip': 0, 'notes': list_transform(lone, lambda y: y.file), 'papers': []::VARCHAR[], 'forced': false}}]
    ELSE out END AS out FROM o
), pairs AS (
  SELECT batch_id, batch_id || x.suffix AS pair_id, nullif(x.number, '') AS numero_nota, x.nf / 100.0::DOUBLE AS valor_nf, x.slip / 100.0::DOUBLE AS valor_boleto, x.forced AS forcado, array_to_string(x.notes, ',') AS notas, array_to_string(x.papers, ',') AS boletos,
    round((x.nf - x.slip) / 100.0::DOUBLE, 2) AS diferenca, CASE WHEN x.forced AND x.slip > 0 AND x.nf = 0 THEN 'PAREADO_FORCADO' ELSE {_STATUS('x.nf', 'x.slip')} END AS status
  FROM (SELECT batch_id, unnest(out) AS x FROM f))"""
_PAIR_COLUMNS = ["batch_id", "pair_id", "numero_nota", "valor_nf", "valor_boleto", "forcado", "notas", "boletos", "diferenca", "status"]
add("pair_exact_fold", lambda s, d: P.paired(S.documents(s, d)).withColumn("notas", F.array_join("notas", ",")).withColumn("boletos", F.array_join("boletos", ",")).select(_PAIR_COLUMNS), f"WITH {_FOLD} SELECT * FROM pairs", "docs")
add("pair_status_counts", lambda s, d: P.paired(S.documents(s, d)).groupBy("status").agg(F.count("*").alias("n")), f"WITH {_FOLD} SELECT status, count(*) AS n FROM pairs GROUP BY status", "docs")
for _k in ("pair_exact_fold", "pair_status_counts"):
    ORACLE[_k] = ORACLE[_k].replace("WITH ", "WITH RECURSIVE ", 1)
_FIRST_OF = lambda c: f"coalesce(arg_min({c}, ordinal) FILTER (side = 'invoice' AND {c} IS NOT NULL), arg_min({c}, ordinal) FILTER (side = 'slip' AND {c} IS NOT NULL)) AS {c}"
add("pair_assembly", lambda s, d: P.paired(S.documents(s, d).filter("ordinal in (1, 1000)")).filter("status <> 'CONFERIR'").select("batch_id", "fornecedor_nome", "cnpj", "vencimento", "data_emissao", "numero_pedido", "aviso"),
    f"""WITH {_KEYED.replace("AS number", "AS number, fornecedor_nome, cnpj, vencimento, data_emissao, numero_pedido")}, one AS (SELECT * FROM k WHERE ordinal IN (1, 1000)), n AS (
      SELECT batch_id, max(cents) FILTER (side = 'invoice') AS nf, max(cents) FILTER (side = 'slip') AS slip, max(number) FILTER (side = 'invoice') AS a, max(number) FILTER (side = 'slip') AS b, {', '.join(_FIRST_OF(c) for c in ('fornecedor_nome', 'cnpj', 'vencimento', 'data_emissao', 'numero_pedido'))} FROM one GROUP BY batch_id)
    SELECT batch_id, fornecedor_nome, cnpj, vencimento, data_emissao, numero_pedido, CASE WHEN vencimento IS NULL THEN '[VENCIMENTO NÃO ENCONTRADO - verificar urgente]' END AS aviso FROM n
    WHERE nf IS NOT NULL AND slip IS NOT NULL AND (nf = 0 OR {_SAME('a', 'b')} OR abs(nf - slip) <= 1)""", "docs")  # fmt: skip
add("forced_pair", lambda s, d: P.forced(S.documents(s, d)),
    f"""WITH {_KEYED}, g AS (SELECT batch_id, count(*) FILTER (side = 'invoice') AS a, count(*) FILTER (side = 'slip') AS b, coalesce(sum(cents) FILTER (side = 'invoice'), 0) AS nf, coalesce(sum(cents) FILTER (side = 'slip'), 0) AS slip FROM k GROUP BY batch_id)
    SELECT batch_id, slip / 100.0::DOUBLE AS valor_boleto, -slip / 100.0::DOUBLE AS diferenca, 'PAREADO_FORCADO' AS status FROM g WHERE a = 1 AND b = 1 AND nf = 0""", "docs")  # fmt: skip
_NUMBERS = "CASE o_orderkey % 5 WHEN 0 THEN 'NF-' || o_orderkey WHEN 1 THEN '2025/' || lpad(o_orderkey::VARCHAR, 6, '0') WHEN 2 THEN '2025' || lpad(o_orderkey::VARCHAR, 11, '0') WHEN 3 THEN '000' || o_orderkey ELSE 'S' || o_orderkey || '-A' END"


def _numbers(s: SparkSession, d: str, whole: bool = False) -> DataFrame:
    """Orders' numbers as documents write them; lpad cuts a key of over 6 digits behind the year, unless they are to be whole."""
    k, m = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 5
    padded = F.when(F.length(k) > 6, k).otherwise(F.lpad(k, 6, "0")) if whole else F.lpad(k, 6, "0")
    v = F.when(m == 0, F.concat(F.lit("NF-"), k)).when(m == 1, F.concat(F.lit("2025/"), padded)).when(m == 2, F.concat(F.lit("2025"), F.lpad(k, 11, "0"))).when(m == 3, F.concat(F.lit("000"), k)).otherwise(F.concat(F.lit("S"), k, F.lit("-A")))
    return S.load(s, d, "orders").select("o_orderkey", v.alias("numero"))


add("normalize_number", lambda s, d: _numbers(s, d).select("o_orderkey", "numero", T.normalized_number("numero").alias("normal")), f"SELECT o_orderkey, {_NUMBERS} AS numero, CASE WHEN o_orderkey % 5 = 4 THEN 'S' || o_orderkey || '-A' ELSE o_orderkey::VARCHAR END AS normal FROM orders")
add("number_equivalence", lambda s, d: _numbers(s, d, whole=True).select("o_orderkey", T.same_number(T.normalized_number("numero"), (F.col("o_orderkey") % 100).cast("string")).alias("igual")),
    "WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN 'S' || o_orderkey || '-A' ELSE o_orderkey::VARCHAR END AS a, (o_orderkey % 100)::VARCHAR AS b FROM orders) SELECT o_orderkey, ends_with(a, b) OR ends_with(b, a) AS igual FROM x")
add("auxiliary_document", lambda s, d: _auxiliary(s, d),
    """WITH x AS (SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN 'Atestamos que ' ELSE '' END || p_name AS f, CASE WHEN p_partkey % 3 = 0 THEN p_retailprice ELSE 0 END AS v, CASE p_partkey % 4 WHEN 0 THEN 'Recibo_' WHEN 1 THEN 'NF ' WHEN 2 THEN 'Termo ' ELSE 'doc' END || p_partkey || '.pdf' AS n FROM part)
    SELECT p_partkey, CASE WHEN starts_with(lower(f), 'atestamos') THEN true WHEN v > 0 THEN false ELSE regexp_matches(lower(n), 'recibo|termo') END AS auxiliar FROM x""")  # fmt: skip


def _auxiliary(s: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    f = F.concat(F.when(k % 11 == 0, "Atestamos que ").otherwise(""), "p_name")
    n = F.concat(F.when(k % 4 == 0, "Recibo_").when(k % 4 == 1, "NF ").when(k % 4 == 2, "Termo ").otherwise("doc"), k.cast("string"), F.lit(".pdf"))
    x = S.load(s, d, "part").select(k, f.alias("f"), F.when(k % 3 == 0, F.col("p_retailprice")).otherwise(0.0).alias("v"), n.alias("n"), F.lit("").alias("t"))
    return x.select("p_partkey", P.is_auxiliary("f", "t", "v", "n").alias("auxiliar"))


# ---- e-mails

_DECIDED = r"""dec AS (
  SELECT *, coalesce(CASE WHEN attachment IS NOT NULL THEN ends_with(attachment, '.pdf') END, has_attachment) AS att, user_bad, subject_bad, hit FROM (
    SELECT *, regexp_matches(sender_address, '(?i)newsletter@|@github\.com$') AS user_bad, coalesce(nullif(regexp_extract(subject, '(?i)comunicado', 0), ''), nullif(regexp_extract(subject, '(?i)^re: re:', 0), '')) AS subject_bad,
      nullif(regexp_extract(subject, '(?i)nf-e|fatura|boleto', 0), '') AS hit FROM emails)),
final AS (SELECT email_id, CASE WHEN NOT att AND user_bad THEN 'SKIP_SENDER_BLACKLIST' WHEN att THEN 'PROCESS' WHEN subject_bad IS NOT NULL THEN 'SKIP_BLACKLIST' WHEN NOT (has_links_nfe OR has_verification_code) THEN 'SKIP_NO_CONTENT'
  WHEN hit IS NOT NULL OR regexp_matches(sender_address, '(?i)cobranca@') THEN 'PROCESS' ELSE 'SKIP_NO_SUBJECT_MATCH' END AS decision, att, subject_bad, hit FROM dec)"""
add("email_decision", lambda s, d: E.decided(S.emails(s, d)).select("email_id", "decision", "blacklist_match", F.array_join("whitelist_matches", ",").alias("whitelist_matches")),
    f"WITH {_DECIDED} SELECT email_id, decision, CASE WHEN decision = 'SKIP_BLACKLIST' THEN subject_bad END AS blacklist_match, CASE WHEN decision = 'PROCESS' AND NOT att THEN coalesce(hit, '') END AS whitelist_matches FROM final", "emails")
add("email_decision_counts", lambda s, d: E.decision_counts(S.emails(s, d)), f"WITH {_DECIDED} SELECT decision, count(*) AS emails FROM final GROUP BY decision", "emails")
add("content_type", lambda s, d: S.emails(s, d).select("email_id", E.content_type().alias("tipo")), "SELECT email_id, CASE WHEN has_attachment THEN 'ATTACHMENT' WHEN has_links_nfe AND has_verification_code THEN 'LINK_CODE' WHEN has_links_nfe THEN 'LINK' WHEN has_verification_code THEN 'CODE' ELSE 'NONE' END AS tipo FROM emails", "emails")
_ADMIN = {"purchase": "Distrato contratual", "signup": "Guia processo 12", "error": "Relatório de faturamento", "click": "Sua ordem 5 foi agendada", "view": "Fatura mensal"}
add("admin_subject_label", lambda s, d: S.load(s, d, "events").withColumn("subject", F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in _ADMIN.items()])).select("event_id", E.admin_label().alias("label")),
    "SELECT event_id, CASE event_type WHEN 'purchase' THEN 'Documento de distrato' WHEN 'signup' THEN 'Guia jurídica/fiscal' WHEN 'error' THEN 'Relatório/planilha de conferência' WHEN 'click' THEN 'Ordem de serviço/agendamento' END AS label FROM events")
_CENTS = "round(o_totalprice * 100)::BIGINT"
_BR = lambda c: f"replace(format('{{:,}}', {c} // 100), ',', '.') || ',' || lpad(({c} % 100)::VARCHAR, 2, '0')"


def _bodies(s: SparkSession, d: str) -> DataFrame:
    o, cents = S.load(s, d, "orders"), F.round(F.col("o_totalprice") * 100).cast("long")
    key = F.col("o_orderkey").cast("string")
    body = F.concat(
        F.lit("Segue a nota fiscal nº "), F.lpad(key, 6, "0"), F.lit(". Valor total R$ "), T.money_text(cents), F.lit(" (entrada R$ "), T.money_text(F.floor(cents / 2)), F.lit("). Vencimento: "), F.date_format("o_orderdate", "dd/MM/yyyy"),
        F.lit("\nPedido: "), key, F.lit(" CNPJ 12.345.678/0001-90. Código de verificação: AB"), F.lpad(key, 6, "0"), F.lit("\nhttps://nfe.cidade.gov.br/nota?nf="), key, F.lit("&cod=XYZ9 https://www.loja.com/p"),
    )
    return o.select("o_orderkey", body.alias("body"), cents.alias("cents"))


add("email_body_fields", lambda s, d: E.body_fields(_bodies(s, d)).select("o_orderkey", "valor_total", "vencimento", "numero_nota", "numero_pedido", "cnpj", "codigo", F.size("valores").alias("n_valores")),
    f"""SELECT o_orderkey, {_CENTS} / 100.0::DOUBLE AS valor_total, strftime(o_orderdate, '%Y-%m-%d') AS vencimento, lpad(o_orderkey::VARCHAR, 6, '0') AS numero_nota, o_orderkey::VARCHAR AS numero_pedido, '12.345.678/0001-90' AS cnpj, 'AB' || lpad(o_orderkey::VARCHAR, 6, '0') AS codigo,
    (({_CENTS} > 0)::INTEGER + ({_CENTS} // 2 > 0 AND {_CENTS} // 2 <> {_CENTS})::INTEGER)::INTEGER AS n_valores FROM orders""")  # fmt: skip
add("email_body_confidence", lambda s, d: E.body_fields(_bodies(s, d)).select("o_orderkey", "confianca"), f"SELECT o_orderkey, CASE WHEN {_CENTS} = 0 THEN 0.0 WHEN {_CENTS} < 1000 THEN 0.7 ELSE 0.9 END::DOUBLE AS confianca FROM orders")
add("link_code_number_from_url", lambda s, d: _bodies(s, d).withColumn("link", F.get(E.invoice_links(), F.lit(0))).select("o_orderkey", "link", E.code_in_link().alias("codigo"), E.number_in_link().alias("numero")),
    "SELECT o_orderkey, 'https://nfe.cidade.gov.br/nota?nf=' || o_orderkey || '&cod=XYZ9' AS link, 'XYZ9' AS codigo, o_orderkey::VARCHAR AS numero FROM orders")
add("email_grouped", lambda s, d: E.grouped(S.emails(s, d).select((F.col("email_id") % 100).alias("email_id"), "subject", F.explode("attachments").alias("filename"))).select("email_id", "subject", F.array_join("attachments", ",").alias("attachments")),
    "SELECT email_id % 100 AS email_id, min(subject) AS subject, string_agg(attachment, ',' ORDER BY attachment) AS attachments FROM emails WHERE attachment IS NOT NULL GROUP BY 1", "emails")
add("ignored_attachment", lambda s, d: S.emails(s, d).select("email_id", F.explode("attachments").alias("filename")).select("email_id", E.ignored_file().alias("ignorado"), T.file_name("filename", 10).alias("nome")), "SELECT email_id, ends_with(attachment, '.png') AS ignorado, CASE WHEN length(attachment) <= 10 THEN attachment ELSE attachment[1:6] || right(attachment, 4) END AS nome FROM emails WHERE attachment IS NOT NULL", "emails")
add("notice_rows", lambda s, d: _bodies(s, d).withColumn("link", F.get(E.links(), F.lit(0))).withColumn("codigo", E.verification_code()).withColumn("numero_nota", F.lit(None).cast("string")).select("o_orderkey", E.notice_text(cut=20).alias("aviso")), "SELECT o_orderkey, 'Link: https://nfe.cidade.g | Código: AB' || lpad(o_orderkey::VARCHAR, 6, '0') AS aviso FROM orders")

# ---- scalars


def _money(s: SparkSession, d: str) -> DataFrame:
    o, cents = S.load(s, d, "orders"), F.round(F.col("o_totalprice") * 100).cast("long")
    return o.select("o_orderkey", F.concat(F.lit("Base R$ "), T.money_text(F.floor(cents / 3)), F.lit(" taxa 0,00 total "), T.money_text(cents), F.lit(" x12,345 9.99")).alias("t"), T.money_text(cents).alias("m"), cents.alias("cents"))


add("money_parse", lambda s, d: _money(s, d).select("o_orderkey", T.money("m").alias("valor"), T.money("t").alias("nada")), f"SELECT o_orderkey, {_CENTS} / 100.0::DOUBLE AS valor, 0.0::DOUBLE AS nada FROM orders")
add("money_all", lambda s, d: _money(s, d).select("o_orderkey", F.size(T.money_all("t")).alias("n"), F.get(T.money_all("t"), F.lit(0)).alias("primeiro")), f"SELECT o_orderkey, 2::INTEGER AS n, ({_CENTS} // 3) / 100.0::DOUBLE AS primeiro FROM orders WHERE {_CENTS} // 3 > 0 UNION ALL SELECT o_orderkey, 1, {_CENTS} / 100.0::DOUBLE FROM orders WHERE {_CENTS} // 3 = 0")
add("money_max", lambda s, d: _money(s, d).select("o_orderkey", T.money_max("t").alias("maior")), f"SELECT o_orderkey, {_CENTS} / 100.0::DOUBLE AS maior FROM orders")


def _dates(s: SparkSession, d: str) -> DataFrame:
    o, m, at = S.load(s, d, "orders"), F.col("o_orderkey") % 4, F.col("o_orderdate")
    short = F.when(m == 0, F.date_format(at, "dd/MM/yyyy")).when(m == 1, F.date_format(at, "dd-MM-yyyy")).when(m == 2, F.date_format(at, "dd/MM/yy")).otherwise("31/02/2024")
    mail = F.when(m == 0, F.concat(F.lit("Mon, "), F.date_format(at, "d MMM yyyy"), F.lit(" 23:59:01 -0300"))).when(m == 1, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")).when(m == 2, F.date_format(at, "dd/MM/yyyy")).otherwise("ontem")
    return o.select("o_orderkey", short.alias("curta"), F.concat(F.lit("emitida em "), short, F.lit(" vence 01/01/2030")).alias("t"), mail.alias("mail"))


_ISO = "strftime(o_orderdate, '%Y-%m-%d')"
add("date_parse", lambda s, d: _dates(s, d).select("o_orderkey", T.date_br("curta").alias("data")), f"SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN {_ISO} END AS data FROM orders")
add("date_first", lambda s, d: _dates(s, d).select("o_orderkey", T.first_date("t").alias("data"), F.size(T.dates_all("t")).alias("n")), f"SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN {_ISO} END AS data, CASE WHEN o_orderkey % 4 < 3 THEN 2 ELSE 1 END::INTEGER AS n FROM orders")
add("email_date", lambda s, d: _dates(s, d).select("o_orderkey", T.email_date("mail").alias("data")), f"SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN {_ISO} END AS data FROM orders")
_D14 = "lpad(s_suppkey::VARCHAR, 8, '0') || '000100'"
_FMT = r"regexp_replace({}, '^(\d{{2}})(\d{{3}})(\d{{3}})(\d{{4}})(\d{{2}})$', '\1.\2.\3/\4-\5')"
_14 = lambda: F.concat(F.lpad(F.col("s_suppkey").cast("string"), 8, "0"), F.lit("000100"))
add("cnpj_format", lambda s, d: S.load(s, d, "supplier").select("s_suppkey", T.cnpj_format(_14()).alias("cnpj"), T.cnpj_format(F.col("s_suppkey").cast("string")).alias("curto"), T.cnpj_format(F.col("s_suppkey").cast("string"), "empty").alias("vazio")), f"SELECT s_suppkey, {_FMT.format(_D14)} AS cnpj, s_suppkey::VARCHAR AS curto, '' AS vazio FROM supplier")
add("cnpj_digits", lambda s, d: S.load(s, d, "supplier").withColumn("t", F.concat(F.lit("x "), T.cnpj_format(_14()), F.lit(" y 123"))).select("s_suppkey", T.cnpj("t").alias("formatado"), T.cnpj_digits(T.cnpj("t")).alias("digitos"), T.cnpj_flexible("t").alias("livre"), T.is_cnpj(T.cnpj("t")).alias("ok")), f"SELECT s_suppkey, {_FMT.format(_D14)} AS formatado, {_D14} AS digitos, {_FMT.format(_D14)} AS livre, true AS ok FROM supplier")
_CPF = lambda: F.regexp_replace(F.lpad(F.col("c_custkey").cast("string"), 11, "0"), r"^(\d{3})(\d{3})(\d{3})(\d{2})$", "$1.$2.$3-$4")
add("cpf_extract", lambda s, d: S.load(s, d, "customer").withColumn("t", F.concat(F.lit("CPF: "), _CPF(), F.lit("; tel 11 99999-0000"))).select("c_custkey", T.cpf("t").alias("cpf"), T.is_cpf(T.cpf("t")).alias("ok")), r"SELECT c_custkey, regexp_replace(lpad(c_custkey::VARCHAR, 11, '0'), '^(\d{3})(\d{3})(\d{3})(\d{2})$', '\1.\2.\3-\4') AS cpf, true AS ok FROM customer")
add("accents_strip", lambda s, d: S.load(s, d, "documents").select("doc_id", F.translate(T.strip_accents("text"), "ß", "").alias("plano")), "SELECT doc_id, replace(strip_accents(text), 'ß', '') AS plano FROM documents")
add("entity_name", lambda s, d: S.load(s, d, "part").select("p_partkey", T.entity_name(F.concat(F.lit("  - "), F.upper("p_name"), F.lit("   LTDA 12.345.678/0001-90  2025.12 : "), F.lpad(F.col("p_partkey").cast("string"), 7, "0"), F.lit(" -;"))).alias("nome")), "SELECT p_partkey, upper(p_name) || ' LTDA' AS nome FROM part")
add("supplier_normalize", lambda s, d: S.load(s, d, "part").select("p_partkey", T.supplier_name(F.concat(F.lit("Razão Social:  "), "p_name", F.lit("\n x"))).alias("nome"), T.supplier_name(F.concat(F.lit("Beneficiário - "), "p_name"), ("Beneficiário",), True).alias("maiusculo")), "SELECT p_partkey, p_name || ' x' AS nome, upper(p_name) AS maiusculo FROM part")
add("text_cleanup", lambda s, d: S.load(s, d, "part").select("p_partkey", T.ready(F.concat(F.lit("a–b\t c"), "p_name", F.lit("□ê■  z"))).alias("limpo"), T.compact(F.concat("p_name", F.lit(" Ção-1"))).alias("compacto"), T.company_code(F.concat(F.lit("("), "p_brand", F.lit(") "), "p_name")).alias("codigo")), "SELECT p_partkey, 'a-b c' || p_name || ' z' AS limpo, upper(replace(p_name, ' ', '')) || 'CAO1' AS compacto, upper(split_part(p_name, ' ', 1)) AS codigo FROM part")
add("domains_distinct", lambda s, d: S.load(s, d, "pages").select("page_id", F.array_join(T.domains_all("url"), ",").alias("dominios")), r"SELECT page_id, regexp_extract(lower(url), 'https?://(?:www\.)?([a-z0-9.-]+\.[a-z]{2,})', 1) AS dominios FROM pages")
add("html_text", lambda s, d: S.load(s, d, "pages").select("page_id", T.html_text("html").alias("texto")),
    r"SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<script\b.*?</script>', ' ', 'g'), '(?is)<style\b.*?</style>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '[ \n\t]+', ' ', 'g')) AS texto FROM pages")

# ---- companies


def _companies(s: SparkSession, d: str) -> DataFrame:
    return S.load(s, d, "supplier").filter("s_suppkey % 10 = 0").select(T.cnpj_format(_14()).alias("cnpj"), F.concat(F.lit("Z"), F.col("s_suppkey").cast("string"), F.lit(" Comercio LTDA")).alias("razao_social"), F.col("s_suppkey").alias("ordinal"))


def _mentions(s: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    text = F.concat(F.lit("PRESTADOR Alfa LTDA CNPJ "), T.cnpj_format(_14()), F.lit("\nTOMADOR Z"), (k - k % 10).cast("string"), F.lit(" CNPJ "), T.cnpj_format(F.concat(F.lpad((k - k % 10).cast("string"), 8, "0"), F.lit("000100"))), F.lit("\nContato: a@z"), (k - k % 10).cast("string"), F.lit(".com.br"))
    return S.load(s, d, "supplier").select(k.alias("doc_id"), text.alias("text"))


_TENS = "(s_suppkey - s_suppkey % 10)"
add("company_match_cnpj", lambda s, d: K.by_cnpj(_mentions(s, d), _companies(s, d)), f"SELECT s_suppkey AS doc_id, 'Z' || {_TENS} || ' Comercio LTDA' AS razao_social, 'Z' || {_TENS} AS codigo, 13::INTEGER AS score FROM supplier")
add("company_match_name", lambda s, d: K.by_code(_mentions(s, d), _companies(s, d)), f"SELECT s_suppkey AS doc_id, 'Z' || {_TENS} || ' Comercio LTDA' AS razao_social, 'Z' || {_TENS} AS codigo FROM supplier")
add("company_match_domain", lambda s, d: K.by_domain(_mentions(s, d), _companies(s, d)), f"SELECT s_suppkey AS doc_id, 'Z' || {_TENS} || ' Comercio LTDA' AS razao_social, 'Z' || {_TENS} AS codigo, (7 + least(3, length('Z' || {_TENS})))::INTEGER AS score FROM supplier")
add("company_match", lambda s, d: K.matched(_mentions(s, d), _companies(s, d)), f"SELECT s_suppkey AS doc_id, 'Z' || {_TENS} || ' Comercio LTDA' AS razao_social, 'Z' || {_TENS} AS codigo, 'cnpj' AS method FROM supplier")
add("company_in_email", lambda s, d: K.in_email(_mentions(s, d), _companies(s, d)).select("doc_id", "codigo", "method"), f"SELECT s_suppkey AS doc_id, 'Z' || {_TENS} AS codigo, 'cnpj' AS method FROM supplier")


def _firms(s: SparkSession, d: str) -> DataFrame:
    return S.load(s, d, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 14, "1").alias("cnpj"), F.concat(F.lit("FIRMA"), F.col("n_nationkey").cast("string"), F.lit(" Servicos LTDA")).alias("razao_social"), F.col("n_nationkey").alias("ordinal"))


def _letters(s: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    a, b = F.concat(F.lit("Firma"), (k % 25).cast("string")), F.concat(F.lit("FIRMA"), ((k + 1) % 25).cast("string"))
    body = F.when(k % 4 == 0, F.concat(F.lit("To: "), a, F.lit(" SA\nassunto "), b)).when(k % 4 == 1, F.concat(F.lit("oi "), a, F.lit("\nFrase de segurança: "), b)).when(k % 4 == 2, F.concat(a, F.lit(" e "), b)).otherwise(F.concat(F.lit("x@gmail.com https://click."), b, F.lit(".com <style>"), b, F.lit("</style> "), a))
    return S.load(s, d, "orders").select(k.alias("doc_id"), body.alias("text"), a.alias("a"))


add("company_context", lambda s, d: K.in_email(_letters(s, d), _firms(s, d)).select("doc_id", F.array_join("codigos", ",").alias("codigos"), "codigo", "method"),
    """WITH x AS (SELECT o_orderkey, 'FIRMA' || (o_orderkey % 25) AS a, 'FIRMA' || ((o_orderkey + 1) % 25) AS b FROM orders)
    SELECT o_orderkey AS doc_id, CASE WHEN o_orderkey % 4 = 3 THEN a ELSE least(a, b) || ',' || greatest(a, b) END AS codigos, CASE WHEN o_orderkey % 4 <> 2 THEN a END AS codigo, CASE WHEN o_orderkey % 4 <> 2 THEN 'nome_exato' END AS method FROM x""")  # fmt: skip
add("company_cnpj_by_code", lambda s, d: K.cnpj_by_code(_letters(s, d).select("doc_id", F.col("a").alias("empresa")).union(S.load(s, d, "region").select("r_regionkey", F.lit("ltda"))), _firms(s, d)).select("doc_id", "empresa", "empresa_cnpj"),
    "SELECT o_orderkey AS doc_id, 'Firma' || (o_orderkey % 25) AS empresa, lpad((o_orderkey % 25)::VARCHAR, 14, '1') AS empresa_cnpj FROM orders UNION ALL SELECT r_regionkey, 'ltda', lpad('0', 14, '1') FROM region")
add("company_semi", lambda s, d: K.ours(S.load(s, d, "supplier").withColumn("cnpj", T.cnpj_format(_14())), _companies(s, d)).select("s_suppkey"), "SELECT s_suppkey FROM supplier WHERE s_suppkey % 10 = 0")
add("company_anti_first", lambda s, d: K.first_foreign_cnpj(_mentions(s, d), _companies(s, d)), f"SELECT s_suppkey AS doc_id, {_D14} AS cnpj_digits FROM supplier WHERE s_suppkey % 10 <> 0")
add("supplier_inferred", lambda s, d: K.inferred_supplier(_mentions(s, d), _companies(s, d)), "SELECT s_suppkey AS doc_id, 'Alfa LTDA' AS fornecedor FROM supplier WHERE s_suppkey % 10 <> 0")
add("bank_lookup", lambda s, d: K.bank_names(S.load(s, d, "orders").select("o_orderkey", F.lpad((F.col("o_orderkey") % 400).cast("string"), 3, "0").alias("codigo_banco")), s.createDataFrame(list(X.BANKS.items()), "codigo string, nome string")).select("o_orderkey", "banco"),
    "SELECT o_orderkey, coalesce(n, 'BANCO_' || c) AS banco FROM (SELECT o_orderkey, lpad((o_orderkey % 400)::VARCHAR, 3, '0') AS c FROM orders) LEFT JOIN (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in X.BANKS.items()) + ") b(k, n) ON c = k")

# ---- extraction

add("slip_fields", lambda s, d: X.extracted(S.slip_texts(s, d), "slip").select("doc_id", "numero_documento", "valor", "vencimento", "data_emissao", "nosso_numero", "cnpj", "fornecedor_nome", "banco"),
    f"""SELECT doc_id, doc_id::VARCHAR AS numero_documento, cents / 100.0::DOUBLE AS valor, strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') AS vencimento, {_ISO} AS data_emissao, '09/' || lpad(doc_id::VARCHAR, 11, '0') || '-4' AS nosso_numero,
    {_FMT.format("lpad(o_custkey::VARCHAR, 8, '0') || '000200'")} AS cnpj, 'COMERCIAL' || CASE WHEN o_custkey < 1000 THEN ' ' || o_custkey ELSE '' END || ' LTDA' AS fornecedor_nome, 'BRADESCO' AS banco FROM slip_texts""", "slip_texts")  # fmt: skip
add("slip_value_from_line", lambda s, d: X.prepared(S.slip_texts(s, d), "text").select("doc_id", X.slip_line_cents("text").alias("centavos"), F.col("text__line").alias("linha")), "SELECT doc_id, nullif(cents, 0) AS centavos, true AS linha FROM slip_texts", "slip_texts")
_I = lambda kind, name, *cols: (lambda s, d: X.extracted(S.invoice_texts(s, d).filter(F.col("kind") == kind), name).select("batch_id", "ordinal", *cols))
_DUE, _SHIP, _OK = "strftime(l_shipdate + INTERVAL 30 DAY, '%Y-%m-%d') AS vencimento", "strftime(l_shipdate, '%Y-%m-%d') AS data_emissao", "batch_id, ordinal::INTEGER AS ordinal"
_VAL = "cents / 100.0::DOUBLE AS valor"
add("nfse_fields", _I("service", "service", "numero_nota", "valor", "data_emissao", "vencimento", "cnpj", "valor_iss"), f"SELECT {_OK}, l_partkey::VARCHAR AS numero_nota, {_VAL}, {_SHIP}, {_DUE}, cnpj, (cents // 20) / 100.0::DOUBLE AS valor_iss FROM invoice_rows WHERE kind = 'service'", "invoice_rows")
add("danfe_fields", _I("product", "product", "numero_nota", "serie_nf", "valor", "data_emissao", "vencimento", "cnpj", "chave_acesso"), f"SELECT {_OK}, l_partkey::VARCHAR AS numero_nota, '1' AS serie_nf, {_VAL}, {_SHIP}, {_DUE}, cnpj, '3525' || lpad(l_suppkey::VARCHAR, 16, '0') || lpad(l_partkey::VARCHAR, 24, '0') AS chave_acesso FROM invoice_rows WHERE kind = 'product'", "invoice_rows")
add("danfe_instalments", lambda s, d: S.invoice_texts(s, d).filter("kind = 'product'").select("batch_id", "ordinal", F.explode(X.instalments("text")).alias("p")).select("batch_id", "ordinal", "p.parcela", "p.vencimento", "p.valor"), f"SELECT {_OK}, '001' AS parcela, {_DUE}, {_VAL} FROM invoice_rows WHERE kind = 'product'", "invoice_rows")
add("outros_fields", _I("rental", "other", "subtipo", "numero_documento", "valor", "data_emissao", "vencimento", "cnpj"), f"SELECT {_OK}, 'LOCACAO' AS subtipo, l_partkey::VARCHAR AS numero_documento, {_VAL}, {_SHIP}, {_DUE}, cnpj FROM invoice_rows WHERE kind = 'rental'", "invoice_rows")
add("energy_fields", _I("energy", "energy", "instalacao", "valor", "data_emissao", "vencimento", "cnpj", "fornecedor_nome"), f"SELECT {_OK}, l_partkey::VARCHAR AS instalacao, {_VAL}, {_SHIP}, {_DUE}, cnpj, 'COMPANHIA DE ENERGIA ELÉTRICA' AS fornecedor_nome FROM invoice_rows WHERE kind = 'energy'", "invoice_rows")
add("admin_fields", lambda s, d: X.extracted(X.routed(S.load(s, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.concat(F.lit("TERMO DE DISTRATO\nentre as partes, em "), F.date_format("o_orderdate", "dd/MM/yyyy")).alias("text"))), "admin").select("doc_id", "extractor", "subtipo", "data_emissao"), f"SELECT o_orderkey AS doc_id, 'admin' AS extractor, 'DISTRATO' AS subtipo, {_ISO} AS data_emissao FROM orders")
add("route_extractor", lambda s, d: X.routed(S.invoice_texts(s, d)).groupBy("kind", "extractor").agg(F.count("*").alias("n")), "SELECT kind, CASE kind WHEN 'rental' THEN 'other' ELSE kind END AS extractor, count(*) AS n FROM invoice_rows GROUP BY kind", "invoice_rows")
add("route_slips", lambda s, d: X.routed(S.slip_texts(s, d)).groupBy("extractor").agg(F.count("*").alias("n")), "SELECT 'slip' AS extractor, count(*) AS n FROM orders")
add("extract_all", lambda s, d: X.extracted_all(S.invoice_texts(s, d)).groupBy("doc_type", "extractor").agg(F.count("*").alias("n"), F.sum(F.col("valor").cast("decimal(18,2)")).cast("double").alias("total"), F.count("vencimento").alias("com_vencimento")),
    "SELECT CASE kind WHEN 'product' THEN 'DANFE' WHEN 'rental' THEN 'OUTRO' ELSE 'NFSE' END AS doc_type, CASE kind WHEN 'rental' THEN 'other' ELSE kind END AS extractor, count(*) AS n, sum((cents / 100.0)::DECIMAL(18,2))::DOUBLE AS total, count(*) AS com_vencimento FROM invoice_rows GROUP BY ALL", "invoice_rows")
add("weighted_value", lambda s, d: X.unprepared(X.prepared(S.invoice_texts(s, d).filter("kind = 'product'"), "text").select("*", X.weighted_value("text", lambda u, v: F.when(u.rlike(r"VALOR\s+TOTAL"), 9).otherwise(1)).alias("valor")), "text").select("batch_id", "ordinal", "valor"), f"SELECT {_OK}, {_VAL} FROM invoice_rows WHERE kind = 'product'", "invoice_rows")

# Three layouts of text for each supplier: {v} an amount, {c} its cents in ten digits, {day} and {due} days, {iso} the first of them, {n} a number, {m} one of four digits.
SUPPLIERS = {
    "line_based_slip": [
        "REPROMAQ\nBanco BRADESCO S.A.\nBeneficiário\nREPROMAQ COM. E IND. LTDA - CNPJ: 01.234.567/0001-89\nNúmero do Documento\n01.234.567/0001-89\n{m}-1\nValor do Documento\n1\nR$\n{v}\nVencimento\n{due}\nData do Documento\n{day}\nNosso Número\n{day}\n09/000{m}103-2",
        "BRADESCO\nREPROMAO LOCACAO\nVencimento: {due}\nValor Cobrado {v}\nEmissão: {day}\nRef {m}-1 CNPJ\nNosso Número: 09/000{m}103-2",
        "Bradesco boleto REPROMAQ\nVENCIMENTO\n{due}\npago em {day}\nfatura {m}-1\nNosso Número\n\n09/000{m}103-2\n23793.38128 60000.000003 00000.000405 1 8434{c}",
    ],
    "rental_invoice": [
        "FATURA DE LOCAÇÃO Nº {n}\nEMPRESA: EMC TECNOLOGIA LTDA TELEFONE 38 1234\nCNPJ 22.261.093/0001-40\nEmissão: {day} VENCIMENTO: {due}\nCONTRATO: 77\nPERIODO {day} ATÉ {due}\nNOTEBOOK DELL R$ 99.999,00\nTOTAL R$ {v}",
        "EMC TECNOLOGIA LTDA\nFATURA DE LOCACAO Nº {n}\nEMPRESA X CNPJ: 22.261.093/0001-40\nEmissao {day}\nVENCIMENTO - {due}\nCONTRATO 77\nperíodo entre {day} e {due}\nTOTAL GERAL: {v}",
        "EMC TECNOLOGIA LTDA 22.261.093/0001-40\nSERVIDOR LENOVO R$ 0,50\nFATURA DE LOCACAO N {n}\nContrato 77 com VENCIMENTO {due}\nEmissão {day}\nperiodo {day} até {due}\nSoma R$ {v}",
    ],
    "net_slip": [
        "NET CENTER UNAI\nVENCIMENTO\n{due}\nCPF/CNPJ: 05.382.200/0001-70\nData do documento {day}\nValor total a pagar: R$ {v}",
        "NETCENTER\nBeneficiário: CPF/CNPJ 05.382.200/0001-70\nEmissão Vencimento Total\n{day} {due}\nValor documento R$ {v}\nMulta 1,00",
        "Provedor 05.382.200/0001-70\nLocal de pagamento Vencimento\nQualquer banco {due}\nData do documento {day}\nParcelas 2,00 e {v}",
    ],
    "montes_claros": [
        "PREFEITURA DE MONTES CLAROS\nNº NFSe: 20250{m}0001505\nRazão Social: ALFA SERVICOS LTDA\nCNPJ: 12.345.678/0001-90\nValor dos Serviços: {v}\nISS: R$ 1,50\nEmitida {iso}T10:11:12\nVencimento: {due}",
        "NOTA.MONTESCLAROS.MG.GOV.BR NOTA FISCAL DE SERVIÇO\nProtocolo 20250{m}0001505\nRazao Social - ALFA SERVICOS LTDA\nCNPJ 12345678000190\nValor R$ {v}\nValor ISS 1,50\nem {iso}\nVencimento {due}",
        "Montes Claros NFS-e\nPrestador\nALFA SERVICOS LTDA\nCPF: 12.345.678/0001-90\nNFSe numero 20250{m}0001505\nValor Total: {v}\nTotal Aprox 1,50\n{day}\nVencimento: {due}",
    ],
    "vila_velha": [
        "PREFEITURA DE VILA VELHA\n{day} 10:00:41 {day} 10:00:41 000{n}\nPrestador: BETA LTDA\nCNPJ: 12.345.678/0001-90\nValor dos serviços R$ {v}\nLei 12.741/2012 R$ 9,99\nVencimento: {due}",
        "PREFEITURA MUNICIPAL DE VILA VELHA\nNúmero: 000{n}\nEmitida em: {day}\nPrestador: BETA LTDA\n12.345.678/0001-90\nValor Líquido R$ {v}\nVencimento {due}",
        "Prefeitura de Vila Velha\nNota Fiscal Nº: 000{n}\n{day}\nPrestador: BETA LTDA\nCNPJ 12.345.678/0001-90\nValor da Nota: R$ {v}\nVencimento: {due}",
    ],
    "telecom_invoice": [
        "DOCUMENTO AUXILIAR DA NOTA FISCAL FATURA DE SERVIÇOS DE COMUNICAÇÃO ELETRÔNICA\nNOME: TELCABLES BRASIL LTDA FILIAL SAO PAULO\nCPF/CNPJ: 20.609.743/0004-13\nNOTA FISCAL FATURA: 0{n}\nSÉRIE: 1 VENCIMENTO: {due}\nDATA DE EMISSÃO: {day}\nTOTAL A PAGAR: R$ {v}",
        "NOTA FISCAL\nTELCABLES BRASIL LTDA FILIAL SAO PAULO\nCNPJ: 20609743000413\nNOTA FATURA: {n}\nVENC. {due}\nProtocolo de Autorização 99 - {day}\nTOTAL: R$ {v}",
        "NOME - TELCABLES BRASIL LTDA FILIAL SAO PAULO\nNOTA FISCAL FATURA: {n}\nSERIE: 1 VENCIMENTO: {due}\npago {day}\nR$ 1,00 e R$ {v}",
    ],
    "association_slip": [
        "ACIMOC\nRECIBO DO SACADO\nSacado: MOC COMUNICACAO\nNúmero: 401-{m}\nDATA DO DOCUMENTO\n{day}\nVENCIMENTO\n{due}\nR$ 0,00\nVALOR DO DOCUMENTO R$ {v}\nmulta 999.999.999,99",
        "ASSOCIAÇÃO COML. INDL. E SERVIÇOS DE MONTES CLAROS\nCEDENTE\nPAGADOR:\nrua x\nMOC\nBoleto 401-{m}\nEMISSÃO {day}\nVCTO {due}\nVALOR {v}",
        "RECIBO DO SACADO\nA MOC deve\nref 401-{m}\nDATA: {day}\nVENCIMENTO em\nate {due}\nDOCUMENTO\n{v}",
    ],
    "goods_invoice": [
        "MUGO TELECOM\nFATURA Nº 00{n}1234\nRAZÃO SOCIAL: \nITACOLOMI LTDA\nEmissão: {day}\nVencimento: {due}\n1 cabo 100,00 2,00\nDESCRIÇÃO VALOR TOTAL {v}\nV.UNIT 999.999.999,99",
        "MUGO TELECOM\nDOCUMENTO N 00{n}1234\nCLIENTE: ITACOLOMI\nEmitido em {day}\nVALIDADE\nate\n{due}\nV. TOTAL {v}\n2 itens 3,00",
        "MUGO TELECOM\nDoc ref 123456\nx 00{n}1234\nITACOLOMI\nData {day}\nVCTO {due}\nTOTAL: R$ {v}",
    ],
    "panel_slip": [
        "PRÓ - PAINEL LTDA\nBOLETO PIX\nPagador: CSC\nDOCUMENTO: {m}\nDATA {day}\nVENCIMENTO {due}\nVALOR DO DOCUMENTO {v}\njuros 0,10",
        "PRO PAINEL LTDA\nFATURA DE LOCAÇÃO\nEntrada N.O: {m}\nCliente\nx\nCSC GESTAO INTEGRADA\nEmitido {day}\nVcto {due}\nItem 1,00\nTOTAL {v}",
        "PROPAINEL\nCSC\nFATURA: {m} - MASTERCABO\nEMISSÃO\n{day}\nVENC\n{due}\nVALOR A PAGAR\nVALOR {v}",
    ],
}


def _supplier_texts(s: SparkSession, d: str, name: str) -> DataFrame:
    o, cents = S.load(s, d, "orders"), F.round(F.col("o_totalprice") * 100).cast("long")
    issued = F.add_months("o_orderdate", 360)
    parts = {"{v}": T.money_text(cents), "{c}": F.lpad(cents.cast("string"), 10, "0"), "{day}": F.date_format(issued, "dd/MM/yyyy"), "{due}": F.date_format(F.date_add(issued, 30), "dd/MM/yyyy"), "{iso}": F.date_format(issued, "yyyy-MM-dd"), "{n}": F.lpad((F.col("o_orderkey") % 100000 + 10000).cast("string"), 6, "1"), "{m}": (F.col("o_orderkey") % 9000 + 1000).cast("string")}
    text = F.coalesce(*[F.when(F.col("o_orderkey") % 3 == i, F.lit(t)) for i, t in enumerate(SUPPLIERS[name])])
    for k, v in parts.items():
        text = F.replace(text, F.lit(k), v)
    return o.select(F.col("o_orderkey").alias("doc_id"), text.alias("text"))


_SUPPLIER = f"SELECT o_orderkey AS doc_id, '{{}}' AS extractor, {{}} AS doc_type, {_CENTS} / 100.0::DOUBLE AS valor, strftime((o_orderdate + INTERVAL 30 YEAR)::DATE + 30, '%Y-%m-%d') AS vencimento, strftime(o_orderdate + INTERVAL 30 YEAR, '%Y-%m-%d') AS data_emissao, {{}} FROM orders"
_SN, _SM = "lpad((o_orderkey % 100000 + 10000)::VARCHAR, 6, '1')", "(o_orderkey % 9000 + 1000)::VARCHAR"
for _name, _type, _columns in (
    ("line_based_slip", "'BOLETO'", {"numero_documento": f"{_SM} || '-1'", "fornecedor_nome": "'REPROMAQ COM. E IND. LTDA'", "banco": "'Bradesco'", "nosso_numero": f"'09/000' || {_SM} || '103-2'", "cnpj": "CASE WHEN o_orderkey % 3 = 0 THEN '01.234.567/0001-89' END"}),
    ("rental_invoice", "'OUTRO'", {"numero_documento": _SN, "fornecedor_nome": "'EMC TECNOLOGIA LTDA'", "cnpj": "'22.261.093/0001-40'", "contrato": "'77'", "periodo_referencia": "strftime(o_orderdate + INTERVAL 30 YEAR, '%d/%m/%Y') || ' até ' || strftime((o_orderdate + INTERVAL 30 YEAR)::DATE + 30, '%d/%m/%Y')", "subtipo": "'FATURA_LOCACAO_EMC'"}),
    ("net_slip", "'BOLETO'", {"fornecedor_nome": "'NET CENTER UNAI PROVEDOR DE INTERNET LTDA'", "cnpj": "'05.382.200/0001-70'"}),
    ("montes_claros", "'NFSE'", {"numero_nota": f"'20250' || {_SM} || '0001505'", "cnpj": "'12.345.678/0001-90'", "valor_iss": "1.5::DOUBLE"}),
    ("vila_velha", "'NFSE'", {"numero_nota": f"'000' || {_SN}", "cnpj": "'12.345.678/0001-90'", "fornecedor_nome": "'BETA LTDA'"}),
    ("telecom_invoice", "'NFSE'", {"numero_nota": _SN, "cnpj": "'20.609.743/0004-13'", "serie_nf": "'1'"}),
    ("association_slip", "'BOLETO'", {"numero_documento": f"'401-' || {_SM}", "cnpj": "'22.677.702/0001-47'", "fornecedor_nome": "'ASSOCIAÇÃO COML. INDL. E SERVIÇOS DE MONTES CLAROS'", "empresa": "'MOC'"}),
    ("goods_invoice", "'NFSE'", {"numero_nota": f"'00' || {_SN} || '1234'", "cnpj": "'14.732.961/0001-03'", "fornecedor_nome": "'MUGO TELECOMUNICAÇÕES LTDA'", "empresa": "'ITACOLOMI'"}),
    ("panel_slip", "CASE WHEN o_orderkey % 3 = 0 THEN 'BOLETO' ELSE 'NFSE' END", {"numero_documento": _SM, "cnpj": "'23.129.448/0001-05'", "fornecedor_nome": "'PRÓ - PAINEL LTDA'", "empresa": "'CSC'"}),
):
    add(f"supplier_{_name}", lambda s, d, n=_name, c=tuple(_columns): X.extracted_all(_supplier_texts(s, d, n)).select("doc_id", "extractor", "doc_type", "valor", "vencimento", "data_emissao", *c), _SUPPLIER.format(_name, _type, ", ".join(f"{v} AS {k}" for k, v in _columns.items())))
add("text_incomplete", lambda s, d: X.incomplete(S.slip_texts(s, d)).select("doc_id", "incompleto"), "SELECT doc_id, length(text) < 300 AS incompleto FROM slip_texts", "slip_texts")


def _xmls(s: SparkSession, d: str) -> DataFrame:
    r = S.invoice_texts(s, d)
    n, day, cnpj = F.col("l_partkey").cast("string"), F.date_format("shipped", "yyyy-MM-dd"), F.concat(F.lpad(F.col("l_suppkey").cast("string"), 8, "0"), F.lit("000100"))
    v = F.concat(F.floor(F.col("cents") / 100).cast("string"), F.lit("."), F.lpad((F.col("cents") % 100).cast("string"), 2, "0"))
    nfe = F.concat(F.lit('<nfeProc xmlns="http://www.portalfiscal.inf.br/nfe"><NFe><infNFe><ide><serie>1</serie><nNF>'), n, F.lit("</nNF><dhEmi>"), day, F.lit("T10:00:00-03:00</dhEmi></ide><emit><CNPJ>"), cnpj, F.lit("</CNPJ><xNome>"), "s_name", F.lit("</xNome></emit><total><vNF>"), v, F.lit("</vNF></total></infNFe></NFe></nfeProc>"))
    abrasf = F.concat(F.lit("<CompNfse><Nfse><InfNfse><Numero>"), n, F.lit("</Numero><DataEmissao>"), day, F.lit("T08:00:00</DataEmissao><Servico><ValorServicos>"), v, F.lit("</ValorServicos></Servico><PrestadorServico><Cnpj>"), cnpj, F.lit("</Cnpj><RazaoSocial>"), "s_name", F.lit("</RazaoSocial></PrestadorServico></InfNfse></Nfse></CompNfse>"))
    sped = F.concat(F.lit('<NFSe><infNFSe Id="1"><nNFSe>'), n, F.lit("</nNFSe><emit><CNPJ>"), cnpj, F.lit("</CNPJ><xNome>"), "s_name", F.lit("</xNome></emit><valores><vLiq>"), v, F.lit('</vLiq></valores><DPS versao="1"><dhEmi>'), day, F.lit("T09:00:00-03:00</dhEmi></DPS></infNFSe></NFSe>"))
    sig = F.concat(F.lit("<NFe><ChaveNFe>x</ChaveNFe><NumeroNFe>"), n, F.lit("</NumeroNFe><DataEmissaoNFe>"), day, F.lit("</DataEmissaoNFe><CPFCNPJPrestador><CNPJ>"), cnpj, F.lit("</CNPJ></CPFCNPJPrestador><RazaoSocialPrestador>"), "s_name", F.lit("</RazaoSocialPrestador><StatusNFe>N</StatusNFe><ValorServicos>"), v, F.lit("</ValorServicos></NFe>"))
    m = F.col("ordinal") % 5
    return r.select("batch_id", "ordinal", F.when(m == 0, nfe).when(m == 1, abrasf).when(m == 2, sped).when(m == 3, sig).otherwise("<a><b></a>").alias("xml"))


add("xml_references", lambda s, d: XM.parsed(S.load(s, d, "part").select("p_partkey", F.concat(F.lit("<NFSe><infNFSe Id='1'><nNFSe>7</nNFSe><emit><xNome>"), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("A &amp; B &lt;"), F.col("p_partkey").cast("string"), F.lit("&gt;"))).otherwise(F.concat(F.lit("<![CDATA[A & B <"), F.col("p_partkey").cast("string"), F.lit(">]]>"))), F.lit("</xNome></emit></infNFSe></NFSe>")).alias("xml"))).select("p_partkey", "fornecedor_nome"), "SELECT p_partkey, 'A & B <' || p_partkey || '>' AS fornecedor_nome FROM part")
_X = lambda k: (lambda s, d: XM.parsed(_xmls(s, d).filter(F.col("ordinal") % 5 == k)).select("batch_id", "ordinal", "dialect", "doc_type", "numero_nota", "cnpj", "fornecedor_nome", "valor", "data_emissao"))
for _k, _name, _dialect, _type in ((0, "xml_nfe", "NFE", "DANFE"), (1, "xml_nfse", "NFSE", "NFSE"), (2, "xml_sped", "NFSE_SPED", "NFSE"), (3, "xml_sigiss", "NFSE_SIGISS", "NFSE")):
    add(_name, _X(_k), f"SELECT {_OK}, '{_dialect}' AS dialect, '{_type}' AS doc_type, l_partkey::VARCHAR AS numero_nota, lpad(l_suppkey::VARCHAR, 8, '0') || '000100' AS cnpj, s_name AS fornecedor_nome, {_VAL}, {_SHIP} FROM invoice_rows WHERE ordinal % 5 = {_k}", "invoice_rows")
add("xml_dialect", lambda s, d: XM.parsed(_xmls(s, d)).groupBy("dialect", "_error").agg(F.count("*").alias("n")).withColumnRenamed("_error", "erro"), "SELECT CASE ordinal % 5 WHEN 0 THEN 'NFE' WHEN 1 THEN 'NFSE' WHEN 2 THEN 'NFSE_SPED' WHEN 3 THEN 'NFSE_SIGISS' END AS dialect, CASE WHEN ordinal % 5 = 4 THEN 'unknown dialect' END AS erro, count(*) AS n FROM invoice_rows GROUP BY ALL", "invoice_rows")
add("payment_name", lambda s, d: S.load(s, d, "orders").select("o_orderkey", XM.payment_name(F.lpad((F.col("o_orderkey") % 20).cast("string"), 2, "0")).alias("forma")), "SELECT o_orderkey, coalesce(n, 'CODIGO_' || c) AS forma FROM (SELECT o_orderkey, lpad((o_orderkey % 20)::VARCHAR, 2, '0') AS c FROM orders) LEFT JOIN (VALUES ('01', 'DINHEIRO'), ('02', 'CHEQUE'), ('03', 'CARTAO CREDITO'), ('04', 'CARTAO DEBITO'), ('15', 'BOLETO'), ('16', 'DEPOSITO'), ('17', 'PIX'), ('18', 'TRANSFERENCIA'), ('90', 'SEM PAGAMENTO'), ('99', 'OUTROS')) p(k, n) ON c = k")

# ---- calendar and quality

# the days of the law, and the movable ones by the Gregorian rule for Easter
_HOLIDAYS = """yy AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM range(1990, 2011) r(y)),
  z AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM yy), l AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM z),
  e AS (SELECT *, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS n FROM l), easter AS (SELECT make_date(y, n // 31, n % 31 + 1) AS day FROM e),
  h AS (SELECT make_date(y, m, d) AS day FROM yy, (VALUES (1, 1), (1, 25), (4, 21), (5, 1), (9, 7), (10, 12), (11, 2), (11, 15), (11, 20), (12, 25)) f(m, d) UNION SELECT day + n FROM easter, (VALUES (-48), (-47), (-2), (60)) f(n))"""
_CAL = _HOLIDAYS + ", cal AS (SELECT day, sum(w) OVER (ORDER BY day) AS n FROM (SELECT d::DATE AS day, CASE WHEN isodow(d) < 6 AND d::DATE NOT IN (SELECT day FROM h) THEN 1 ELSE 0 END AS w FROM generate_series(DATE '1990-01-01', DATE '2010-12-31', INTERVAL 1 DAY) g(d)))"


def _terms(s: SparkSession, d: str) -> DataFrame:
    o = S.load(s, d, "orders")
    return o.select("o_orderkey", F.to_date("o_orderdate").alias("a"), F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 15 - 3).cast("int")).alias("b"), "o_totalprice")


_TERMS = "t AS (SELECT o_orderkey, o_orderdate::DATE AS a, (o_orderdate::DATE + (o_orderkey % 15 - 3)::INTEGER) AS b, o_totalprice FROM orders)"
add("working_days", lambda s, d: with_working_days(_terms(s, d), "a", "b").select("o_orderkey", "dias_uteis"), f"WITH {_CAL}, {_TERMS} SELECT o_orderkey, greatest(0, y.n - x.n)::INTEGER AS dias_uteis FROM t JOIN cal x ON x.day = a JOIN cal y ON y.day = b")
add("deadline_check", lambda s, d: C.with_deadline(_terms(s, d).select("o_orderkey", F.date_format("a", "yyyy-MM-dd").alias("dt_classificacao"), F.date_format("b", "yyyy-MM-dd").alias("vencimento"))).select("o_orderkey", "prazo_ok", "dias_uteis"), f"WITH {_CAL}, {_TERMS} SELECT o_orderkey, greatest(0, y.n - x.n)::INTEGER AS dias_uteis, greatest(0, y.n - x.n) >= 4 AS prazo_ok FROM t JOIN cal x ON x.day = a JOIN cal y ON y.day = b")
_NOW = "1998-06-15"


def _states(s: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    due = F.when(k % 6 != 0, F.date_format(F.date_add(F.lit(_NOW).cast("date"), (k % 20 - 8).cast("int")), "yyyy-MM-dd"))
    return S.load(s, d, "orders").select("o_orderkey", F.when(k % 7 != 0, k.cast("string")).alias("numero_nota"), F.when(k % 11 != 0, F.col("o_totalprice")).otherwise(0.0).alias("valor"), due.alias("vencimento"))


add("due_situation", lambda s, d: C.situation(_states(s, d), _NOW).select("o_orderkey", "situacao", "avisos"),
    f"""WITH {_CAL}, x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 0 THEN DATE '{_NOW}' + (o_orderkey % 20 - 8)::INTEGER END AS due, concat_ws(', ', CASE WHEN o_orderkey % 7 = 0 THEN 'NF' END, CASE WHEN o_orderkey % 11 = 0 THEN 'VALOR' END) AS missing FROM orders),
    y AS (SELECT x.*, greatest(0, b.n - a.n)::INTEGER AS days FROM x LEFT JOIN cal b ON b.day = due LEFT JOIN cal a ON a.day = DATE '{_NOW}')
    SELECT o_orderkey, CASE WHEN missing <> '' THEN 'DIVERGENTE' WHEN due IS NULL THEN 'CONFERIR' WHEN due < DATE '{_NOW}' THEN 'VENCIDO' WHEN days <= 4 THEN 'VENCIMENTO_PROXIMO' ELSE 'OK' END AS situacao,
      concat_ws(' | ', CASE WHEN missing <> '' THEN '[DIVERGENTE] Campos faltando: ' || missing END, CASE WHEN due < DATE '{_NOW}' THEN '[VENCIDO] Vencimento em ' || strftime(due, '%d/%m/%Y') WHEN days <= 4 AND due IS NOT NULL THEN '[URGENTE] Apenas ' || days || ' dias úteis até vencimento' WHEN due IS NULL THEN '[CONFERIR] Vencimento não informado' END) AS avisos FROM y""")  # fmt: skip


def _judged(s: SparkSession, d: str) -> DataFrame:
    docs = S.documents(s, d).withColumn("dt_classificacao", F.col("data_emissao")).withColumn("linha_digitavel", F.when(F.col("batch_id") % 2 == 0, F.lit("2379")))
    docs = docs.withColumn("cnpj", F.when(F.col("batch_id") % 9 != 0, F.col("cnpj"))).withColumn("fornecedor_nome", F.when(F.col("batch_id") % 13 != 0, F.col("fornecedor_nome")))
    return C.classified(docs)


def _why(kind: str) -> Query:
    return lambda s, d: _judged(s, d).filter(F.col("doc_type") == kind).select("batch_id", "ordinal", "sucesso", F.array_join("motivos", ",").alias("motivos"))


_V0, _SUP, _NOCNPJ, _NONUM = "CASE WHEN valor <= 0 THEN 'VALOR_ZERO' END", "CASE WHEN batch_id % 13 = 0 THEN 'SEM_RAZAO_SOCIAL' END", "CASE WHEN batch_id % 9 = 0 THEN 'SEM_CNPJ' END", "CASE WHEN numero_nota IS NULL THEN 'SEM_NUMERO' END"
_GOOD = "valor > 0 AND batch_id % 13 <> 0"
# every due date here is 30 days after the issue, which always leaves four working days
add("classify_nfse", _why("NFSE"), f"SELECT {_OK}, {_GOOD} AS sucesso, concat_ws(',', {_V0}, {_NOCNPJ}, {_SUP}) AS motivos FROM docs WHERE doc_type = 'NFSE'", "docs")
add("classify_slip", _why("BOLETO"), f"SELECT {_OK}, {_GOOD} AND (vencimento IS NOT NULL OR batch_id % 2 = 0) AS sucesso, concat_ws(',', {_V0}, CASE WHEN vencimento IS NULL THEN 'SEM_VENCIMENTO' END, CASE WHEN batch_id % 2 <> 0 THEN 'SEM_LINHA_DIGITAVEL' END, {_SUP}) AS motivos FROM docs WHERE doc_type = 'BOLETO'", "docs")
add("classify_danfe", _why("DANFE"), f"SELECT {_OK}, {_GOOD} AS sucesso, concat_ws(',', {_V0}, {_SUP}, {_NONUM}) AS motivos FROM docs WHERE doc_type = 'DANFE'", "docs")
add("classify_other", _why("OUTRO"), f"SELECT {_OK}, {_GOOD} AS sucesso, concat_ws(',', {_V0}, {_SUP}) AS motivos FROM docs WHERE doc_type = 'OUTRO'", "docs")
add("success_rates", lambda s, d: C.success_rates(_judged(s, d)), f"SELECT doc_type, count(*) AS total, count(*) FILTER (ok) AS sucessos, total - sucessos AS falhas, sucessos * 100 / total AS taxa FROM (SELECT doc_type, {_GOOD} AND (doc_type <> 'BOLETO' OR vencimento IS NOT NULL OR batch_id % 2 = 0) AS ok FROM docs) GROUP BY doc_type", "docs")
add("failure_type", lambda s, d: S.documents(s, d).withColumn("texto", F.when(F.col("ordinal") == 2, "contrato de Locação").otherwise("")).select("batch_id", "ordinal", C.failure_type().alias("falha")),
    f"SELECT {_OK}, CASE WHEN doc_type IN ('BOLETO', 'OUTRO') THEN 'BOLETO/RECIBO (Ignorar se não for NF).' WHEN ordinal = 2 THEN 'LOCAÇÃO (Layout atípico).' WHEN valor = 0 THEN 'Regex de VALOR falhou.' WHEN numero_nota IS NULL THEN 'Regex de NÚMERO DA NOTA falhou.' ELSE 'Falha genérica de extração.' END AS falha FROM docs", "docs")
_DUES = lambda: F.when(F.col("o_orderkey") % 4 == 0, "2024-02-30").when(F.col("o_orderkey") % 4 == 1, F.lit("2024-02-29")).when(F.col("o_orderkey") % 4 == 2, F.date_format("o_orderdate", "yyyy-MM-dd"))
add("validate_due_date", lambda s, d: S.load(s, d, "orders").select("o_orderkey", _DUES().alias("vencimento")).select("o_orderkey", F.array_join(C.due_date_problems(), ",").alias("problemas")), "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'INVALIDO' WHEN 1 THEN '' WHEN 2 THEN CASE WHEN year(o_orderdate) BETWEEN 2020 AND 2035 THEN '' ELSE 'ANO_FORA' END ELSE 'AUSENTE' END AS problemas FROM orders")
_NAMES = lambda: F.when(F.col("s_suppkey") % 5 == 0, "CNPJ:").when(F.col("s_suppkey") % 5 == 1, "X").when(F.col("s_suppkey") % 5 == 2, "123-45").when(F.col("s_suppkey") % 5 == 3, F.col("s_name"))
add("validate_supplier", lambda s, d: S.load(s, d, "supplier").select("s_suppkey", _NAMES().alias("fornecedor_nome")).select("s_suppkey", F.array_join(C.supplier_problems(), ",").alias("problemas"), C.severity(F.size(C.supplier_problems())).alias("severidade")), "SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'GENERICO' WHEN 1 THEN 'CURTO' WHEN 2 THEN 'SO_NUMEROS' WHEN 3 THEN '' ELSE 'AUSENTE' END AS problemas, CASE WHEN s_suppkey % 5 = 3 THEN 'BAIXA' ELSE 'MEDIA' END AS severidade FROM supplier")
add("severity", lambda s, d: S.load(s, d, "orders").groupBy(C.severity(F.col("o_orderkey") % 5).alias("severidade")).agg(F.count("*").alias("n")), "SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'BAIXA' WHEN o_orderkey % 5 <= 2 THEN 'MEDIA' ELSE 'ALTA' END AS severidade, count(*) AS n FROM orders GROUP BY 1")
add("withholdings", lambda s, d: S.load(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_tax").alias("a"), F.when(F.col("l_linenumber") > 2, F.col("l_discount")).alias("b")).groupBy("l_orderkey").agg(F.sum(C.withholdings("a", "b").cast("decimal(18,2)")).cast("double").alias("retencoes")), "SELECT l_orderkey, sum(l_tax::DECIMAL(18,2) + CASE WHEN l_linenumber > 2 THEN l_discount::DECIMAL(18,2) ELSE 0 END)::DOUBLE AS retencoes FROM lineitem GROUP BY l_orderkey")
add("problem_cases", lambda s, d: C.problem_cases(B.batch_summary(S.documents(s, d)).join(B.purchase_value(S.documents(s, d)), "batch_id")).select("batch_id", "outros", "nfses"), f"WITH {BUY}, c AS (SELECT batch_id, count(*) FILTER (doc_type = 'OUTRO') AS outros, count(*) FILTER (doc_type = 'NFSE') AS nfses FROM docs GROUP BY batch_id) SELECT batch_id, outros, nfses FROM c JOIN buy USING (batch_id) WHERE (outros > 0 OR nfses > 0) AND valor_compra = 0", "docs")
add("problem_types", lambda s, d: S.emails(s, d).groupBy(C.problem_type().alias("tipo")).agg(F.count("*").alias("n")), "SELECT CASE WHEN starts_with(subject, 'NF-e') THEN 'NOTA_FISCAL' WHEN starts_with(subject, 'Fatura') THEN 'FATURA' WHEN starts_with(subject, 'Boleto') THEN 'BOLETO' ELSE 'OUTRO' END AS tipo, count(*) AS n FROM emails GROUP BY 1", "emails")

# ---- reports

_TODAY = "2024-05-02"


def _sheets(s: SparkSession, d: str) -> DataFrame:
    return B.inherited(S.documents(s, d)).withColumn("empresa", F.lit("ACME")).withColumn("subject", F.concat(F.lit("Lote "), F.col("batch_id").cast("string"))).withColumn("situacao", F.lit("OK")).withColumn("avisos", F.lit(None).cast("string"))


def _plain(df: DataFrame) -> DataFrame:
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


_NUM = "CASE doc_type WHEN 'BOLETO' THEN coalesce(x, y, z, numero_documento) WHEN 'OUTRO' THEN coalesce(numero_documento, '') ELSE coalesce(numero_nota, '') END"
_SHEET = "sh AS (SELECT d.*, x, y, z, p, v FROM docs d JOIN (SELECT batch_id, " + ", ".join([_FIRST("numero_nota", "doc_type = 'DANFE'", "x"), _FIRST("numero_nota", "doc_type = 'NFSE'", "y"), _FIRST("numero_documento", "doc_type = 'OUTRO'", "z"), _FIRST("numero_pedido", "true", "p"), _FIRST("vencimento", "doc_type = 'BOLETO'", "v")]) + " FROM docs GROUP BY batch_id) b USING (batch_id))"
_BRD = lambda c: f"coalesce({c}[9:10] || '/' || {c}[6:7] || '/' || {c}[1:4], '')"
_VENC = "CASE WHEN doc_type IN ('DANFE', 'NFSE') THEN coalesce(vencimento, v) ELSE vencimento END"
add("sheet_row_18", lambda s, d: _plain(R.sheet_18(_sheets(s, d), _TODAY)), f"WITH {_SHEET} SELECT batch_id AS c0, ordinal::INTEGER AS c1, '02/05/2024' AS c2, '' AS c3, 'ACME' AS c4, fornecedor_nome AS c5, {_NUM} AS c6, {_BRD('data_emissao')} AS c7, valor AS c8, coalesce(numero_pedido, p, '') AS c9, {_BRD('(' + _VENC + ')')} AS c10, CASE WHEN doc_type = 'BOLETO' THEN 'BOLETO' ELSE '' END AS c11, '' AS c12, '02/05/2024' AS c13, CASE WHEN doc_type = 'BOLETO' THEN {_NUM} ELSE '' END AS c14, doc_type AS c15, 'PENDENTE' AS c16, 'PENDENTE' AS c17, '' AS c18, '' AS c19 FROM sh", "docs")
add("sheet_row_11", lambda s, d: _plain(R.sheet_11(_sheets(s, d), _TODAY)), f"WITH {_SHEET} SELECT batch_id AS c0, ordinal::INTEGER AS c1, '02/05/2024' AS c2, 'Lote ' || batch_id AS c3, coalesce(numero_pedido, p, '') AS c4, 'ACME' AS c5, {_BRD('(' + _VENC + ')')} AS c6, fornecedor_nome AS c7, {_NUM} AS c8, valor AS c9, 'OK' AS c10, '' AS c11, arquivo_origem AS c12 FROM sh", "docs")
add("sheet_row_9", lambda s, d: _plain(R.sheet_9(E.body_fields(_bodies(s, d)).select(F.col("o_orderkey").alias("email_id"), F.lit("Nota").alias("subject"), "numero_pedido", F.lit(None).cast("string").alias("empresa"), F.lit(None).cast("string").alias("fornecedor_nome"), "numero_nota", F.get(E.links(), F.lit(0)).alias("link"), "codigo"), _TODAY)), "SELECT o_orderkey AS c0, '02/05/2024' AS c1, 'Nota' AS c2, o_orderkey::VARCHAR AS c3, '' AS c4, '' AS c5, lpad(o_orderkey::VARCHAR, 6, '0') AS c6, 'https://nfe.cidade.gov.br/nota?nf=' || o_orderkey || '&cod=XYZ9' AS c7, 'AB' || lpad(o_orderkey::VARCHAR, 6, '0') AS c8, 'PENDENTE_DOWNLOAD' AS c9 FROM orders")
add("consolidated_union", lambda s, d: R.consolidated(S.invoices(s, d).select("batch_id", "ordinal", "numero_nota", "valor"), S.slips(s, d).select("batch_id", "ordinal", "numero_documento", "valor")), "SELECT batch_id, ordinal::INTEGER AS ordinal, numero_nota, valor, NULL::VARCHAR AS numero_documento FROM invoices UNION ALL SELECT batch_id, ordinal, NULL, valor, numero_documento FROM slips", "docs")
add("csv_dialect", lambda s, d: R.as_csv_columns(S.load(s, d, "orders").select("o_orderkey", F.floor("o_totalprice").cast("double").alias("valor"), F.array(F.col("o_orderstatus"), F.lit("x")).alias("lista"))), "SELECT o_orderkey::VARCHAR AS o_orderkey, floor(o_totalprice)::BIGINT || ',00' AS valor, o_orderstatus || ',x' AS lista FROM orders")


def _written(s: SparkSession, sink: Callable[[DataFrame, str], None], df: DataFrame) -> DataFrame:
    """What a sink has written, read back as a report: all columns text."""
    root = s.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="tributary-")
    path = f"{root}/{uuid.uuid4().hex}"
    sink(df, path)
    return RD.report_csv(s, path, ";")


add("route_sink_by_type", lambda s, d: _written(s, R.write_by_type, S.documents(s, d)).groupBy((F.col("tipo") == "BOLETO").alias("boleto"), F.col("tipo").alias("doc_type")).agg(F.count("*").alias("n"), F.sum(RD.br_number("valor").cast("decimal(18,2)")).cast("double").alias("total")), "SELECT doc_type = 'BOLETO' AS boleto, doc_type, count(*) AS n, sum(valor::DECIMAL(18,2))::DOUBLE AS total FROM docs GROUP BY doc_type", "docs")
add("csv_round_trip", lambda s, d: _written(s, R.write_csv, S.slips(s, d)).select(F.col("batch_id").cast("long").alias("batch_id"), RD.br_number("valor").alias("valor"), "fornecedor_nome"), "SELECT batch_id, valor, fornecedor_nome FROM slips", "slips")
add("consolidate_by_subject", lambda s, d: R.by_subject(S.load(s, d, "events").select(F.col("event_id").alias("batch_id"), F.concat(F.lit("  Fatura\t"), F.col("event_type"), F.lit("  "), (F.col("user_id") % 30).cast("string")).alias("subject"))).select("assunto", "n"), "SELECT 'fatura ' || event_type || ' ' || (user_id % 30) AS assunto, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 1")
add("retention_list", lambda s, d: R.expired(S.load(s, d, "orders").select(F.col("o_orderkey").alias("batch_id"), F.col("o_orderdate").alias("received")), "1998-06-15 00:00:00", 48).select("batch_id"), "SELECT o_orderkey AS batch_id FROM orders WHERE o_orderdate < TIMESTAMP '1998-06-13'")
add("quality_text", lambda s, d: R.quality_text(C.success_rates(_judged(s, d))), f"SELECT doc_type, rpad(doc_type, 8, ' ') || ' | total ' || count(*) || ' | sucesso ' || count(*) FILTER (ok) || ' | falha ' || (count(*) - count(*) FILTER (ok)) AS line FROM (SELECT doc_type, {_GOOD} AND (doc_type <> 'BOLETO' OR vencimento IS NOT NULL OR batch_id % 2 = 0) AS ok FROM docs) GROUP BY doc_type", "docs")

# ---- metrics, logs, streams

add("histogram", lambda s, d: M.histogram(S.load(s, d, "events").withColumn("seconds", F.col("value") / 10), "event_type").drop("media"), "SELECT event_type, " + ", ".join(f"count(*) FILTER (value / 10 <= {b}) AS le_{str(b).replace('.', '_')}" for b in M.BUCKETS) + ", count(*) AS le_inf, sum((value / 10)::DECIMAL(24,6))::DOUBLE AS total FROM events GROUP BY event_type")
add("counters", lambda s, d: M.counters(S.load(s, d, "events"), "event_type", "user_id"), "SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL")
add("gauges", lambda s, d: M.gauges(S.load(s, d, "events"), "event_type"), "SELECT event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, value DESC) AS n FROM events) WHERE n = 1")
add("session_summary", lambda s, d: M.session_summary(M.counters(S.load(s, d, "events").withColumn("name", F.when(F.col("event_type") == "error", "errors_total").when(F.col("event_type") == "view", "documents_total").otherwise("emails_total")), "name")), "SELECT count(*) FILTER (event_type NOT IN ('error', 'view')) AS emails, count(*) FILTER (event_type = 'view') AS documentos, count(*) FILTER (event_type = 'error') AS erros, count(*) AS total FROM events")
add("prometheus_text", lambda s, d: M.as_prometheus(M.counters(S.load(s, d, "events"), "event_type").select(F.lit("events_total").alias("name"), F.col("event_type").alias("label"), F.col("n").alias("value"))), """SELECT 'events_total{label="' || event_type || '"} ' || count(*) AS line FROM events GROUP BY event_type""")
add("log_levels", lambda s, d: L.level_counts(L.entries(S.log_lines(s, d))), "SELECT CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'WARNING' ELSE 'INFO' END AS level, 'module' || user_id % 5 AS module, count(*) AS n FROM events GROUP BY ALL")
add("log_top_messages", lambda s, d: L.top_messages(L.entries(S.log_lines(s, d))), "SELECT CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'WARNING' ELSE 'INFO' END AS level, 'Lote processado: <lote> em <tempo>' AS mensagem, count(*) AS vezes FROM events GROUP BY 1")
add("log_slow_batches", lambda s, d: L.batches(L.entries(S.log_lines(s, d))), "SELECT 'email_20240101_' || (user_id % 20) AS batch_id, arg_max(event_id + 0.5, strftime(ts, '%Y-%m-%d %H:%M:%S') || lpad(event_id::VARCHAR, 12, '0'))::DOUBLE AS duracao, arg_max(event_id + 0.5, strftime(ts, '%Y-%m-%d %H:%M:%S') || lpad(event_id::VARCHAR, 12, '0')) > 20 AS lenta FROM events GROUP BY 1")
add("log_sessions", lambda s, d: L.sessions(L.entries(S.log_lines(s, d)), r"em \d*00\.5s", r"em \d*99\.5s").groupBy("module").agg(F.count("*").alias("sessoes"), F.sum("linhas").alias("linhas"), F.count_if("completa").alias("completas")),
    r"""WITH l AS (SELECT 'module' || user_id % 5 AS module, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t, 'Lote processado: email_20240101_' || user_id % 20 || ' em ' || event_id || '.5s' AS m FROM events),
    n AS (SELECT *, sum(regexp_matches(m, 'em \d*00\.5s')::INTEGER) OVER (PARTITION BY module ORDER BY t, m RANGE UNBOUNDED PRECEDING) AS k FROM l), g AS (SELECT module, k, count(*) AS c, max(regexp_matches(m, 'em \d*99\.5s')::INTEGER) AS f FROM n WHERE k > 0 GROUP BY ALL)
    SELECT module, count(*) AS sessoes, sum(c)::BIGINT AS linhas, count(*) FILTER (f = 1) AS completas FROM g GROUP BY module""")  # fmt: skip
add("inbox_top_senders", lambda s, d: S.emails(s, d).groupBy("sender_address").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "sender_address").limit(15), "SELECT sender_address, count(*) AS n FROM emails GROUP BY 1 ORDER BY n DESC, sender_address LIMIT 15", "emails")
add("inbox_top_keywords", lambda s, d: S.emails(s, d).select(F.explode(E.all_hits("subject", E.SUBJECT_WHITELIST)).alias("k")).groupBy(F.lower("k").alias("palavra")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "palavra").limit(20), "SELECT lower(regexp_extract(subject, '(?i)nf-e|fatura|boleto', 0)) AS palavra, count(*) AS n FROM emails WHERE regexp_matches(subject, '(?i)nf-e|fatura|boleto') GROUP BY 1 ORDER BY n DESC, palavra LIMIT 20", "emails")
add("stream_windows", lambda s, d: V.windowed(S.load(s, d, "events"), late=None), "SELECT date_trunc('hour', ts)::TIMESTAMP AS inicio, event_type, count(*) AS n, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY ALL")
add("stream_sessions", lambda s, d: V.sessions(S.load(s, d, "events"), "6 hours", None), """WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR <= ts THEN 1 ELSE 0 END AS b FROM events),
    n AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, min(ts) AS inicio, count(*) AS n FROM n GROUP BY user_id, k""")  # fmt: skip
add("stream_dedup", lambda s, d: V.distinct(S.load(s, d, "events").select("user_id", "event_type"), ["user_id", "event_type"], None), "SELECT DISTINCT user_id, event_type FROM events")
add("merge_partial_history", lambda s, d: V.with_history(*(S.load(s, d, "orders").filter(f"o_orderkey % 3 {op}").select("o_orderkey", F.lit(n).alias("origem")) for op, n in (("= 0", "agora"), ("< 2", "antes"))), "o_orderkey"), "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'agora' ELSE 'antes' END AS origem FROM orders WHERE o_orderkey % 3 < 2")
add("processed_skip", lambda s, d: V.without_processed(S.emails(s, d).select("email_id"), S.emails(s, d).filter("email_id % 2 = 0")), "SELECT email_id FROM emails WHERE email_id % 2 <> 0", "emails")
add("timeout_retries", lambda s, d: V.retries(S.load(s, d, "orders").select(F.col("o_orderkey").alias("batch_id"), (F.col("o_totalprice") / 1000).alias("seconds"))), "SELECT o_orderkey AS batch_id, 600.0::DOUBLE AS limite FROM orders WHERE o_totalprice / 1000 > 300")
add("pdf_passwords", lambda s, d: _passwords(s, d), "WITH c AS (SELECT lpad(s_suppkey::VARCHAR, 8, '0') || '000100' AS c FROM supplier) SELECT DISTINCT unnest([c, c[1:8], c[1:5], c[1:4]]) AS senha FROM c")


def _passwords(s: SparkSession, d: str) -> DataFrame:
    from tributary.sources.readers import passwords

    return passwords(S.load(s, d, "supplier").select(T.cnpj_format(_14()).alias("cnpj")))


# ---- single values

_WORDING = lambda: F.when(F.col("o_orderkey") % 3 == 0, "Nota Fiscal do prestador").when(F.col("o_orderkey") % 3 == 1, "Contrato e comunicado: nota fiscal").otherwise("xyz")
add("text_class", lambda s, d: S.load(s, d, "orders").withColumn("text", _WORDING()).select("o_orderkey", C.text_class().alias("c")).select("o_orderkey", "c.classe", F.round("c.confianca", 6).alias("confianca")),
    "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'NFSE' WHEN 1 THEN 'ADMIN' ELSE 'DESCONHECIDO' END AS classe, CASE o_orderkey % 3 WHEN 0 THEN 1.0 WHEN 1 THEN round(2 / 3.0::DOUBLE, 6) ELSE 0.0 END::DOUBLE AS confianca FROM orders")
add("supplier_repair", lambda s, d: _mentions(s, d).select("doc_id", K.supplier_repair().alias("r")).select("doc_id", "r.sugestao", "r.confianca"), "SELECT s_suppkey AS doc_id, 'PRESTADOR Alfa LTDA' AS sugestao, 0.6::DOUBLE AS confianca FROM supplier")
add("sender_parts", lambda s, d: S.emails(s, d).withColumn("sender", F.concat(F.lit('"Nome '), F.col("email_id").cast("string"), F.lit('" <'), "sender_address", F.lit(">"))).select("email_id", E.sender_parts().alias("p")).select("email_id", "p.name", "p.address"), "SELECT email_id, 'Nome ' || email_id AS name, sender_address AS address FROM emails", "emails")
add("number_from_file_name", lambda s, d: S.documents(s, d).select("batch_id", "ordinal", T.number_in_file_name("arquivo_origem").alias("numero")), r"SELECT batch_id, ordinal::INTEGER AS ordinal, CASE WHEN starts_with(arquivo_origem, 'NF ') THEN regexp_extract(arquivo_origem, 'NF (\d+)', 1) END AS numero FROM docs", "docs")
add("due_date_to_iso", lambda s, d: S.load(s, d, "orders").select("o_orderkey", T.iso_date(F.date_format("o_orderdate", "d.M.yyyy")).alias("data"), T.iso_date(F.lit("amanhã")).alias("outra")), f"SELECT o_orderkey, {_ISO} AS data, 'amanhã' AS outra FROM orders")
add("email_key", lambda s, d: _email_keys(s, d), "SELECT event_id, event_id || '@host_' || event_type AS chave FROM events")
add("metrics_json", lambda s, d: M.as_json(M.counters(S.load(s, d, "events"), "event_type")), """SELECT '{"event_type":"' || event_type || '","n":' || count(*) || '}' AS line FROM events GROUP BY event_type""")
add("run_totals", lambda s, d: M.run_totals(S.load(s, d, "orders").select(F.when(F.col("o_orderstatus") == "F", "OK").when(F.col("o_orderstatus") == "O", "TIMEOUT").otherwise("ERROR").alias("status"))), "SELECT count(*) AS lotes, count(*) FILTER (o_orderstatus = 'F') AS ok, count(*) FILTER (o_orderstatus = 'O') AS timeout, count(*) FILTER (o_orderstatus = 'P') AS erro FROM orders")


def _email_keys(s: SparkSession, d: str) -> DataFrame:
    from tributary.sources.readers import email_key

    return S.load(s, d, "events").withColumn("email_id", F.concat(F.col("event_id").cast("string"), F.lit("@host/"), "event_type")).select("event_id", email_key().alias("chave"))

# ---- correlation, audits and what runs keep

add("correlated", lambda s, d: B.correlated(S.documents(s, d), _metadata(s, d)).select(*_KEYS, "numero_nota", "vencimento", "numero_pedido", "status_conciliacao", "valor_compra", "sem_vencimento", "duplicados"),
    "WITH m AS (SELECT o_orderkey AS batch_id, CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS ev, 'E' || o_orderkey AS ep, o_orderkey::VARCHAR AS en FROM orders), b AS (SELECT batch_id, "
    + ", ".join([_FIRST("numero_nota", "doc_type IN ('DANFE', 'NFSE')", "x"), _FIRST("numero_documento", "doc_type = 'OUTRO'", "z"), _FIRST("vencimento", "doc_type = 'BOLETO'", "v"), _FIRST("numero_pedido", "true", "p")])
    + f""" FROM docs GROUP BY batch_id), full_ AS (SELECT d.batch_id, d.ordinal, doc_type, valor, CASE WHEN v IS NULL THEN coalesce(vencimento, ev) WHEN doc_type IN ('DANFE', 'NFSE') THEN coalesce(vencimento, v) ELSE vencimento END AS vencimento,
    coalesce(numero_pedido, p, ep) AS numero_pedido, CASE WHEN coalesce(x, z) IS NULL AND doc_type IN ('DANFE', 'NFSE') THEN coalesce(numero_nota, en) ELSE numero_nota END AS numero_nota FROM docs d JOIN b USING (batch_id) LEFT JOIN m USING (batch_id)),
    twice AS (SELECT batch_id, string_agg(numero_nota, ',' ORDER BY numero_nota) AS duplicados FROM (SELECT batch_id, numero_nota FROM full_ WHERE doc_type IN ('NFSE', 'DANFE') AND numero_nota IS NOT NULL GROUP BY ALL HAVING count(*) > 1) GROUP BY batch_id),
    due AS (SELECT batch_id, count(vencimento) = 0 AS sem_vencimento FROM full_ GROUP BY batch_id), {RECONCILED}
    SELECT f.batch_id, f.ordinal::INTEGER AS ordinal, numero_nota, f.vencimento, numero_pedido, status AS status_conciliacao, bought::DOUBLE AS valor_compra, sem_vencimento, duplicados
    FROM full_ f JOIN rec USING (batch_id) JOIN due USING (batch_id) LEFT JOIN twice USING (batch_id)""", "docs")  # fmt: skip
add("note_with_value", lambda s, d: B.has_note_with_value(S.documents(s, d)), "SELECT batch_id, bool_or(doc_type <> 'BOLETO' AND valor > 0) AS nota_com_valor FROM docs GROUP BY batch_id", "docs")
add("subject_by_batch", lambda s, d: B.with_subject(S.slips(s, d).select("batch_id", "valor"), S.load(s, d, "orders").filter("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("batch_id"), F.concat(F.lit("Lote "), F.col("o_orderkey").cast("string")).alias("email_subject"))), "SELECT batch_id, valor, CASE WHEN batch_id % 3 = 0 THEN 'Lote ' || batch_id END AS assunto FROM slips", "slips")
add("batch_ids", lambda s, d: S.load(s, d, "events").select("event_id", "ts", F.col("event_id").cast("string").alias("m")).withColumn("b", B.batch_key("ts", "m")).select("event_id", F.col("b").alias("lote"), B.batch_day("b").cast("string").alias("dia"), B.batch_day("m").cast("string").alias("sem_dia")),
    "SELECT event_id, 'email_' || strftime(ts, '%Y%m%d_%H%M%S') || '_' || sha256(event_id::VARCHAR)[1:8] AS lote, strftime(ts, '%Y-%m-%d') AS dia, NULL::VARCHAR AS sem_dia FROM events")
add("batch_of_path", lambda s, d: S.load(s, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("C:\\\\mail\\email_"), F.col("o_orderkey").cast("string"))).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("/tmp/email_"), F.col("o_orderkey").cast("string"))).otherwise("").alias("p")).select("o_orderkey", B.batch_of_path("p").alias("lote")), "SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN 'email_' || o_orderkey ELSE 'DESCONHECIDO' END AS lote FROM orders")
add("content_type_parsed", lambda s, d: S.load(s, d, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, "LINK_CODE").otherwise(F.col("event_type")).alias("t")).select("event_id", E.parsed_content_type("t").alias("tipo")), "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'LINK_CODE' END AS tipo FROM events")
_URLS = ["https://nfe.cidade.br/1", "http://x.com/nota-fiscal/2", "https://app.omie.com.br/3", "https://portal.com/consulta/nf4", "https://x.com/2VIA", "https://click.mkt.com/track/5", "https://loja.com/produto", "texto sem link", "https://x.gov.br/6", "https://a.com/download/nota.xml"]


def _linked(s: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    url = F.element_at(F.array(*map(F.lit, _URLS)), (k % 10 + 1).cast("int"))
    return S.load(s, d, "orders").select(k.alias("email_id"), F.when(k % 4 == 0, F.lit("Nota Fiscal")).otherwise("Oi").alias("subject"), F.lit("x@y.com").alias("sender_address"), F.concat(F.lit("veja "), url, F.when(k % 5 == 0, " código de verificação: AB12CD").otherwise("")).alias("body"), F.when(k % 7 == 0, F.array(F.lit("a.pdf"))).otherwise(F.array().cast("array<string>")).alias("attachments"))


_LINKED = "x AS (SELECT o_orderkey AS email_id, o_orderkey % 10 NOT IN (6, 7) AS has_links_nfe, o_orderkey % 5 = 0 AS has_verification_code, [" + ", ".join(f"'{u}'" for u in _URLS) + "][o_orderkey % 10 + 1] AS url FROM orders)"
add("filter_inputs", lambda s, d: E.with_filter_inputs(_linked(s, d)).select("email_id", "has_links_nfe", "has_verification_code"), f"WITH {_LINKED} SELECT email_id, has_links_nfe, has_verification_code FROM x")
add("notices", lambda s, d: E.notices(_linked(s, d), _firms(s, d)).select("email_id", "subject", "link", "codigo", "empresa"),
    f"WITH {_LINKED} SELECT email_id, 'Nota Fiscal' AS subject, CASE WHEN has_links_nfe THEN url END AS link, CASE WHEN has_verification_code THEN 'AB12CD' END AS codigo, NULL::VARCHAR AS empresa FROM x WHERE email_id % 4 = 0 AND email_id % 7 <> 0 AND (has_links_nfe OR has_verification_code)")
add("inbox_statistics", lambda s, d: E.inbox_statistics(S.emails(s, d), 3, 2, 2).select("grupo", "valor", "n", F.array_join("exemplos", "|").alias("exemplos")),
    """WITH w AS (SELECT email_id, subject, 'palavra' AS grupo, unnest(list_filter(['nota fiscal', 'nf-e', 'nfs-e', 'boleto', 'fatura'], lambda k: contains(lower(subject), k))) AS valor FROM emails
      UNION ALL SELECT email_id, subject, 'remetente', split_part(sender_address, '@', 2) FROM emails),
    g AS (SELECT grupo, valor, count(*) AS n, list(subject ORDER BY email_id)[1:2] AS e, row_number() OVER (PARTITION BY grupo ORDER BY count(*) DESC, valor) AS r FROM w GROUP BY grupo, valor)
    SELECT grupo, valor, n, array_to_string(e, '|') AS exemplos FROM g WHERE r <= CASE grupo WHEN 'palavra' THEN 3 ELSE 2 END""", "emails")  # fmt: skip
add("stream_windows_live", lambda s, d: V.run_once(V.windowed(V.read(s, d), late=None), f"windows_{uuid.uuid4().hex[:8]}", "complete"), "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS inicio, event_type, count(*) AS n, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY 1, 2")
add("skip_reasons", lambda s, d: M.skipped(E.decided(S.emails(s, d))), f"WITH {_DECIDED} SELECT lower(decision[6:]) AS motivo, count(*) AS n FROM final WHERE starts_with(decision, 'SKIP_') GROUP BY 1", "emails")


def _cases(s: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return S.load(s, d, "orders").select(
        k.alias("batch_id"), F.when(k % 5 == 0, "CNPJ:").when(k % 5 == 1, "").otherwise("ACME LTDA").alias("fornecedor"), F.when(k % 3 == 0, F.lit("2024-02-10")).when(k % 3 == 1, F.lit("2024-02-30")).alias("vencimento"),
        F.when(k % 2 == 0, 0.0).otherwise(F.col("o_totalprice")).alias("valor_compra"), (k % 2 + 1).cast("int").alias("outros"), F.when(k % 4 == 0, 1).otherwise(0).alias("nfses"), F.lit(None).cast("string").alias("numero_nota"),
        F.when(k % 6 == 0, "Boleto de maio").when(k % 6 == 1, "NF 12").otherwise("oi").alias("email_subject"),
    )


_CASES = """q AS (SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN 'GENERICO' WHEN 1 THEN 'AUSENTE' ELSE '' END AS fornecedor,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Valor zero com 1 outros e ' || CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END || ' NFSEs' ELSE '' END AS valor,
  CASE WHEN o_orderkey % 3 = 1 THEN 'INVALIDO' WHEN o_orderkey % 3 = 2 AND o_orderkey % 4 <> 0 THEN 'Vencimento não extraído (' || CASE WHEN o_orderkey % 6 = 0 THEN 'assunto sugere boleto/fatura)' ELSE 'pode ser boleto)' END ELSE '' END AS vencimento,
  CASE WHEN o_orderkey % 4 = 0 THEN 'Número da nota não extraído (para NFSE)' ELSE '' END AS numero_nota, CASE o_orderkey % 6 WHEN 0 THEN 'Assunto sugere boleto/fatura' WHEN 1 THEN 'Assunto sugere nota fiscal' ELSE '' END AS extrator,
  CASE WHEN o_orderkey % 3 = 1 THEN 'Data de vencimento inválida' WHEN o_orderkey % 3 = 2 AND o_orderkey % 4 <> 0 THEN 'Data de vencimento faltante' ELSE '' END AS data FROM orders),
  c AS (SELECT *, (fornecedor <> '')::INTEGER + (valor <> '')::INTEGER + (vencimento <> '')::INTEGER + (numero_nota <> '')::INTEGER + (data <> '')::INTEGER AS n FROM q)"""
_SEVERITY = "CASE WHEN n = 0 THEN 'BAIXA' WHEN n <= 2 THEN 'MEDIA' ELSE 'ALTA' END"
add("case_quality", lambda s, d: A.quality(_cases(s, d)).select("batch_id", *[F.array_join(f"{k}_issues", ";").alias(k) for k in A.ISSUES], "severidade"), f"WITH {_CASES} SELECT k AS batch_id, fornecedor, valor, vencimento, numero_nota, extrator, data, {_SEVERITY} AS severidade FROM c")
add("case_report", lambda s, d: A.report(A.quality(_cases(s, d))), f"WITH {_CASES} SELECT k AS batch_id, concat_ws(chr(10), 'Caso ' || k || ' | severidade: ' || {_SEVERITY} || ' | problemas: ' || n, " + ", ".join(f"CASE WHEN {k} <> '' THEN '  {k}: ' || {k} END" for k in ("fornecedor", "valor", "vencimento", "numero_nota", "extrator", "data")) + ") AS text FROM c")


def _found(s: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    return S.load(s, d, "orders").select(F.when(k % 9 != 0, k).alias("id"), F.when(k % 2 == 0, "ALTA").otherwise("BAIXA").alias("severity"), F.when(k % 3 == 0, "NFSE").otherwise("ADMIN").alias("classification"), F.when(k % 5 == 0, F.array(F.lit("Valor"), F.lit("data"))).otherwise(F.array(F.lit("data"))).alias("issues"))


add("case_filter", lambda s, d: A.filtered(_found(s, d), "alta", "nfse", "VALOR", 10, 1000).select("id"), "SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 9 <> 0 AND o_orderkey % 30 = 0 AND o_orderkey BETWEEN 10 AND 1000")
add("case_counts", lambda s, d: A.counts(_found(s, d), "severity", "classification", "issues"),
    "SELECT 'severity' AS coluna, CASE WHEN o_orderkey % 2 = 0 THEN 'ALTA' ELSE 'BAIXA' END AS valor, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'classification', CASE WHEN o_orderkey % 3 = 0 THEN 'NFSE' ELSE 'ADMIN' END, count(*) FROM orders GROUP BY 2 UNION ALL SELECT 'issues', 'data', count(*) FROM orders UNION ALL SELECT 'issues', 'Valor', count(*) FROM orders WHERE o_orderkey % 5 = 0")
_PDFS = lambda s, d: S.load(s, d, "lineitem").select(F.col("l_orderkey").alias("batch_id"), F.when(F.col("l_returnflag") == "A", "Nota fiscal, prestador X, R$ 10,00").when(F.col("l_returnflag") == "R", "Contrato e proposta").otherwise("nada").alias("text"), F.lit(1).alias("outros"))
add("batch_class", lambda s, d: A.batch_class(_PDFS(s, d)),
    """WITH g AS (SELECT l_orderkey AS batch_id, count(*) AS total, count(*) FILTER (l_returnflag = 'A') AS nfse, count(*) FILTER (l_returnflag = 'R') AS admin FROM lineitem GROUP BY 1)
    SELECT batch_id, total, nfse, admin, nfse AS com_valor, CASE WHEN nfse > 0 AND admin > 0 THEN 'MISTO' WHEN nfse > 0 THEN 'NFSE' WHEN admin > 0 THEN 'ADMIN' ELSE 'DESCONHECIDO' END AS classe,
    CASE WHEN nfse > 0 THEN 'REVISAR_CLASSIFICACAO' WHEN admin > 0 THEN 'DOCUMENTO_ADMIN_OK' ELSE 'INVESTIGAR_MANUALMENTE' END AS acao FROM g""")  # fmt: skip
add("processed_names", lambda s, d: A.processed(S.load(s, d, "part").select(F.when(F.col("p_partkey") % 2 == 0, F.upper("p_brand")).otherwise(F.col("p_brand")).alias("name"))), "SELECT DISTINCT CASE WHEN p_partkey % 2 = 0 THEN upper(p_brand) ELSE p_brand END AS name FROM part")
add("partial_flattened", lambda s, d: W.flattened(S.documents(s, d).filter("ordinal <= 2").groupBy("batch_id").agg(F.lit("OK").alias("status"), F.array_sort(F.collect_list(F.struct(F.col("arquivo_origem"), "valor"))).alias("documents"))).select("batch_id", "status", "ordinal", "arquivo_origem", "valor"),
    "SELECT batch_id, 'OK' AS status, (row_number() OVER (PARTITION BY batch_id ORDER BY arquivo_origem, valor))::INTEGER AS ordinal, arquivo_origem, valor FROM docs WHERE ordinal <= 2", "docs")
add("log_report", lambda s, d: L.report(L.entries(S.log_lines(s, d))).filter("secao = 'niveis'"), "SELECT 'niveis' AS secao, level || ': ' || count(*) AS linha FROM (SELECT CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'WARNING' ELSE 'INFO' END AS level FROM events) GROUP BY level")
