"""Pairing of the invoices of a batch with its bank slips: the exact fold, and a relational form for distinct numbers.

The fold depends on the order of a batch's documents and can't be expressed as a join, so the batches, each of which is one e-mail,
pass through Python as Arrow lists, many in a call. Everything around it is native.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions import text as T
from tributary.operators.batches import TOLERANCE

# File names of papers that accompany an invoice.
AUXILIARY = ["demonstrativo", "atestado", "recibo", "comprovante", "declaracao", "declaração", "termo", "contrato", "recs", "recebimento"]


def is_auxiliary(supplier="fornecedor_nome", text: str | Column = "texto", value="valor", file="arquivo_origem") -> Column:
    """Whether a document is no invoice: it attests something, or has no value and a name that says so."""
    text = F.col(text) if isinstance(text, str) else text
    s, t = F.lower(F.trim(F.coalesce(F.col(supplier), F.lit("")))), F.lower(F.substring(F.coalesce(text, F.lit("")), 1, 200))
    name = F.lower(F.coalesce(F.col(file), F.lit("")))
    says = s.rlike("^(atestamos|declaramos)") | t.rlike("atestamos|declaramos")
    return F.when(says, True).when(F.coalesce(F.col(value), F.lit(0.0)) > 0, False).otherwise(name.rlike("|".join(AUXILIARY)))


def status(invoice: Column, slip: Column, forced: Column | None = None) -> Column:
    """CONCILIADO, DIVERGENTE, CONFERIR or, for a pair that was forced, PAREADO_FORCADO or DIVERGENTE_VALOR."""
    forced = F.lit(False) if forced is None else forced
    return (
        F.when((invoice > 0) & (slip > 0), F.when(F.abs(F.round(invoice - slip, 2)) <= TOLERANCE, "CONCILIADO").when(forced, "DIVERGENTE_VALOR").otherwise("DIVERGENTE"))
        .when((slip > 0) & forced, "PAREADO_FORCADO")
        .otherwise("CONFERIR")
    )


def keyed(docs: DataFrame) -> DataFrame:
    """Candidates with side (invoice or slip), cents and number: slips by file name, then number; invoices by number, then file name."""
    slip = F.col("doc_type") == "BOLETO"
    own = T.blank_to_null(F.coalesce("numero_nota", "numero_documento"))
    name = T.number_in_file_name("arquivo_origem")
    number = F.when(slip, F.coalesce(name, T.blank_to_null("numero_documento"))).otherwise(F.coalesce(own, name))
    out = docs.withColumn("side", F.when(slip, "slip").otherwise("invoice")).withColumn("cents", F.round(F.coalesce(F.col("valor"), F.lit(0.0)) * 100).cast("long"))
    text = F.col("texto") if "texto" in docs.columns else F.lit("")
    return out.filter((slip & (F.col("valor") > 0)) | (~slip & ~is_auxiliary(text=text))).withColumn("number", T.normalized_number(number))


#: What a pair takes from the first of its documents that has it, invoices before slips.
TAKEN = ["fornecedor_nome", "cnpj", "vencimento", "data_emissao", "numero_pedido", "empresa"]
PAIR = [
    ("batch_id", pa.int64()), ("pair_id", pa.string()), ("numero_nota", pa.string()), ("nf", pa.int64()), ("slip", pa.int64()), ("forcado", pa.bool_()), ("notas", pa.list_(pa.string())), ("boletos", pa.list_(pa.string())),
    *((c, pa.string()) for c in TAKEN),
]


def _same(a: str, b: str) -> bool:
    if not a or not b:
        return False
    x, y = a.lstrip("0") or "0", b.lstrip("0") or "0"
    return x.endswith(y) or y.endswith(x)


def fold(rows: list[dict]) -> list[dict]:
    """The pairs of one batch: rows with side, cents, number and arquivo_origem, in the order of its files."""
    invoices, slips = [r for r in rows if r["side"] == "invoice"], [r for r in rows if r["side"] == "slip"]
    pair = lambda suffix, number, a, b, notes, papers, forced=False: {"suffix": suffix, "number": number, "nf": a, "slip": b, "notes": notes, "papers": papers, "forced": forced}
    if not invoices and not slips:
        return [pair("", None, 0, 0, [], [])]
    if len(invoices) == 1 and len(slips) == 1 and not invoices[0]["cents"]:
        return [pair("", invoices[0]["number"] or slips[0]["number"], 0, slips[0]["cents"], [invoices[0]], slips, True)]
    groups: list[dict] = []
    for r in invoices:
        if r["cents"] <= 0:
            continue
        g = next((g for g in groups if abs(g["cents"] - r["cents"]) <= 1 or _same(g["number"], r["number"])), None)
        if g is None:
            groups.append({"cents": r["cents"], "number": r["number"], "rows": [r]})
        else:
            g["rows"].append(r)
            if r["number"] and (not g["number"] or len(r["number"]) < len(g["number"])):
                g["number"] = r["number"]
    papers: list[dict] = []
    for r in slips:
        g = next((g for g in papers if _same(g["number"], r["number"])), None)
        if g is None:
            papers.append({"cents": r["cents"], "number": r["number"], "rows": [r], "used": False})
        else:
            g["cents"] += r["cents"]
            g["rows"].append(r)
    out = []
    for g in groups:
        p = next((p for p in papers if not p["used"] and (_same(g["number"], p["number"]) or abs(g["cents"] - p["cents"]) <= 1)), None)
        if p:
            p["used"] = True
        suffix = f"_{g['number']}" if len(groups) > 1 and g["number"] else ""
        out.append(pair(suffix, g["number"] or (p or {}).get("number"), g["cents"], p["cents"] if p else 0, g["rows"], p["rows"] if p else []))
    for p in papers:
        if not p["used"]:
            out.append(pair(f"_bol_{p['number']}" if p["number"] else "_bol", p["number"], 0, p["cents"], [], p["rows"]))
    lone = [r for r in invoices if not r["cents"]]
    open_ = [o for o in out if not o["nf"]]
    if len(lone) == 1 and len(open_) == 1 and len(open_[0]["papers"]) == 1:
        out = [o for o in out if o["nf"] and o["slip"]] + [pair("", lone[0]["number"] or open_[0]["number"], 0, open_[0]["slip"], lone, open_[0]["papers"], True)]
    if not out:
        out = [pair("", next((r["number"] for r in invoices if r["number"]), None), max((r["cents"] for r in invoices), default=0), sum(r["cents"] for r in slips), invoices, slips)]
    return out


def paired(docs: DataFrame) -> DataFrame:
    """One row for each pair: number, values, status, difference, files, and supplier, dates, order number and company of its documents.

    One grouping by batch gives each batch's candidates as a list, in the order of its files; a batch without any gives an empty pair.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for batch, rows in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for p in fold(rows):
                    both = [*p["notes"], *p["papers"]]
                    taken = [next((r[c] for r in both if r[c]), None) for c in TAKEN]
                    out.append((batch, f"{batch}{p['suffix']}", p["number"] or None, p["nf"], p["slip"], p["forced"], [r["arquivo_origem"] for r in p["notes"]], [r["arquivo_origem"] for r in p["papers"]], *taken))
            columns = zip(*out, strict=True) if out else [()] * len(PAIR)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, PAIR, strict=True)], [n for n, _ in PAIR])

    have = set(docs.columns)
    more = [(F.col(c) if c in have else F.lit(None)).cast("string").alias(c) for c in TAKEN]
    k = keyed(docs).select("batch_id", F.struct(F.col("ordinal").cast("int").alias("ordinal"), "arquivo_origem", "side", "cents", "number", *more).alias("row"))
    every = k.unionByName(docs.select("batch_id").distinct(), allowMissingColumns=True)
    lists = every.groupBy(F.col("batch_id").cast("long").alias("batch_id")).agg(F.array_sort(F.collect_list("row")).alias("rows"))
    kinds = ", ".join(f"{n} {'array<string>' if t == pa.list_(pa.string()) else {'int64': 'long', 'bool': 'boolean'}.get(str(t), str(t))}" for n, t in PAIR)
    pairs = lists.mapInArrow(run, kinds).withColumn("valor_nf", F.col("nf") / 100.0).withColumn("valor_boleto", F.col("slip") / 100.0).drop("nf", "slip")
    pairs = pairs.withColumn("fornecedor_nome", T.supplier_name("fornecedor_nome"))
    state = status(F.col("valor_nf"), F.col("valor_boleto"), F.col("forcado"))
    note = F.when(T.blank_to_null("vencimento").isNull(), "[VENCIMENTO NÃO ENCONTRADO - verificar urgente]")
    return pairs.withColumn("diferenca", F.round(F.col("valor_nf") - F.col("valor_boleto"), 2)).withColumn("status", state).withColumn("aviso", note)


def paired_by_number(docs: DataFrame) -> DataFrame:
    """The relational form: the n-th invoice of a number with the n-th slip of that number. Exact where numbers are distinct and none ends in another."""
    k = keyed(docs).filter("number <> ''")
    place = Window.partitionBy("batch_id", "number", "side").orderBy("ordinal")
    k = k.withColumn("n", F.row_number().over(place)).filter("side = 'slip' or cents > 0")
    cents = lambda side: F.coalesce(F.max(F.when(F.col("side") == side, F.col("cents"))), F.lit(0))
    both = k.groupBy("batch_id", "number", "n").agg(cents("invoice").alias("nf"), cents("slip").alias("slip"))
    return both.select("batch_id", "number", F.col("n").cast("int").alias("n"), (F.col("nf") / 100.0).alias("valor_nf"), (F.col("slip") / 100.0).alias("valor_boleto"), status(F.col("nf") / 100.0, F.col("slip") / 100.0).alias("status"))


def forced(docs: DataFrame) -> DataFrame:
    """Batches with exactly one invoice, without a value, and one slip."""
    k = keyed(docs).groupBy("batch_id").agg(F.count_if(F.col("side") == "invoice").alias("a"), F.count_if(F.col("side") == "slip").alias("b"), F.sum(F.when(F.col("side") == "invoice", F.col("cents")).otherwise(0)).alias("nf"), F.sum(F.when(F.col("side") == "slip", F.col("cents")).otherwise(0)).alias("slip"))
    return k.filter("a = 1 and b = 1 and nf = 0").select("batch_id", (F.col("slip") / 100.0).alias("valor_boleto"), (-F.col("slip") / 100.0).alias("diferenca"), F.lit("PAREADO_FORCADO").alias("status"))
