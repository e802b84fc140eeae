"""Documents of a batch: merge of XML and PDF rows, inheritance, duplicates, reconciliation, summaries.

All take the columns batch_id, ordinal, doc_type, numero_nota, numero_documento, numero_pedido, fornecedor_nome, cnpj, valor,
data_emissao, vencimento and arquivo_origem. "First" is by ordinal, the order of a batch's files. A batch is one e-mail; every
operator groups by its id, and windows over it hold a batch's few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions import text as T

# The tolerance of comparisons, and the order in which types are asked.
TOLERANCE = 0.01
FOR_VALUE = ["NFSE", "DANFE", "OUTRO", "BOLETO"]
FOR_DUE_DATE = ["NFSE", "DANFE", "BOLETO", "OUTRO"]
SOURCE_NAMES = {"OUTRO": "OUTROS"}


def cents(c: str | Column) -> Column:
    """An amount as a decimal, whose sums don't depend on their order; null counts as 0."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0.0)).cast("decimal(18,2)")


def _rank(order: list[str]) -> Column:
    return F.coalesce(*[F.when(F.col("doc_type") == t, i) for i, t in enumerate(order)])


def _first(value: Column, order: list[str], where: Column) -> Column:
    """The value of the first row that qualifies, by type, then ordinal."""
    return F.min_by(F.when(where, value), F.when(where, F.struct(_rank(order), F.col("ordinal"))))


def purchase_value(docs: DataFrame) -> DataFrame:
    """(batch_id, valor_compra, fonte): the first positive value by NFSE, DANFE, OUTRO, BOLETO; else 0 and null."""
    source = F.coalesce(*[F.when(F.col("doc_type") == t, SOURCE_NAMES.get(t, t)) for t in FOR_VALUE])
    got = docs.groupBy("batch_id").agg(_first(F.struct("valor", source.alias("fonte")), FOR_VALUE, F.col("valor") > 0).alias("x"))
    return got.select("batch_id", F.coalesce("x.valor", F.lit(0.0)).alias("valor_compra"), F.col("x.fonte").alias("fonte"))


def first_supplier(docs: DataFrame) -> DataFrame:
    name = T.blank_to_null("fornecedor_nome")
    return docs.groupBy("batch_id").agg(_first(T.supplier_name("fornecedor_nome"), FOR_VALUE, name.isNotNull()).alias("fornecedor"))


def first_due_date(docs: DataFrame) -> DataFrame:
    return docs.groupBy("batch_id").agg(_first(F.col("vencimento"), FOR_DUE_DATE, T.blank_to_null("vencimento").isNotNull()).alias("vencimento"))


def first_number(docs: DataFrame) -> DataFrame:
    """The first of: an NFSE's number, a DANFE's, an order number of an NFSE or a DANFE, an OUTRO's number, a slip's number."""
    levels = [("NFSE", "numero_nota"), ("DANFE", "numero_nota"), ("NFSE", "numero_pedido"), ("DANFE", "numero_pedido"), ("OUTRO", "numero_documento"), ("BOLETO", "numero_documento")]
    tries = [F.min_by(F.when(c := (F.col("doc_type") == t) & T.blank_to_null(n).isNotNull(), F.col(n)), F.when(c, F.col("ordinal"))) for t, n in levels]
    return docs.groupBy("batch_id").agg(F.coalesce(*tries).alias("numero_nota"))


def has_multiple_invoices(docs: DataFrame) -> DataFrame:
    return docs.groupBy("batch_id").agg((F.count_if(F.col("doc_type").isin("NFSE", "DANFE")) > 1).alias("multiplas"))


def batch_summary(docs: DataFrame) -> DataFrame:
    """Counts, totals and flags of each batch, in one aggregation."""
    n = lambda t: F.count_if(F.col("doc_type") == t)
    total = lambda t: F.sum(F.when(F.col("doc_type") == t, cents("valor")).otherwise(0)).cast("double")
    return docs.groupBy("batch_id").agg(
        F.count("*").alias("total_documentos"), n("DANFE").alias("danfes"), n("BOLETO").alias("boletos"), n("NFSE").alias("nfses"), n("OUTRO").alias("outros"),
        total("DANFE").alias("valor_danfes"), total("BOLETO").alias("valor_boletos"), total("NFSE").alias("valor_nfses"), (n("BOLETO") > 0).alias("tem_boleto"),
        F.count_if(T.blank_to_null("vencimento").isNull()).alias("sem_vencimento"),
    )


def reconciled(docs: DataFrame) -> DataFrame:
    """(batch_id, status, fonte, valor_compra, valor_boleto, diferenca, divergencia) of each batch.

    The purchase value falls back to the first slip, so a batch with one slip and no invoice is CONCILIADO here; pairing says CONFERIR.
    """
    slips = docs.groupBy("batch_id").agg(F.sum(F.when(F.col("doc_type") == "BOLETO", cents("valor")).otherwise(0)).alias("slip"), F.count_if(T.blank_to_null("vencimento").isNotNull()).alias("dated"))
    both = purchase_value(docs).join(slips, "batch_id").withColumn("buy", cents("valor_compra"))
    diff = F.col("buy") - F.col("slip")
    status = F.when((F.col("buy") > 0) & (F.col("slip") > 0), F.when(F.abs(diff) <= TOLERANCE, "CONCILIADO").otherwise("DIVERGENTE")).otherwise("CONFERIR")
    money = lambda c: F.concat(F.lit("R$ "), F.col(c).cast("decimal(18,2)").cast("string"))
    told = (
        F.when(status == "DIVERGENTE", F.concat(F.lit("Valor compra: "), money("buy"), F.lit(" | Valor boleto: "), money("slip"), F.lit(" | Diferença: R$ "), diff.cast("decimal(18,2)").cast("string")))
        .when((status == "CONFERIR") & (F.col("slip") > 0), F.concat(F.lit("Conferir boleto ("), money("slip"), F.lit(")")))
        .when(status == "CONFERIR", F.concat(F.lit("Conferir valor ("), money("buy"), F.lit(") - sem boleto para comparação")))
    )
    notes = F.concat_ws(" ", told, F.when(F.col("fonte") == "OUTROS", "[VALOR DE OUTROS]"), F.when(F.col("dated") == 0, "[VENCIMENTO NÃO ENCONTRADO]"))
    return both.select("batch_id", status.alias("status"), "fonte", F.col("buy").cast("double").alias("valor_compra"), F.col("slip").cast("double").alias("valor_boleto"), diff.cast("double").alias("diferenca"), F.nullif(notes, F.lit("")).alias("divergencia"))


def duplicates_by_number(docs: DataFrame) -> DataFrame:
    """(batch_id, numero, vezes, arquivos): numbers that several invoices of a batch bear."""
    use = docs.filter(F.col("doc_type").isin("NFSE", "DANFE") & T.blank_to_null("numero_nota").isNotNull())
    files = F.array_sort(F.collect_list(F.struct("ordinal", "arquivo_origem")))
    found = use.groupBy("batch_id", F.col("numero_nota").alias("numero")).agg(F.count("*").alias("vezes"), files.alias("f")).filter("vezes > 1")
    return found.select("batch_id", "numero", "vezes", F.array_join(F.transform("f", lambda x: x["arquivo_origem"]), ",").alias("arquivos"))


def duplicates_by_supplier_value(docs: DataFrame) -> DataFrame:
    """(batch_id, fornecedor, valor, vezes): equal values of suppliers that agree in 30 upper-case characters."""
    use = docs.filter((F.col("valor") > 0) & T.blank_to_null("fornecedor_nome").isNotNull())
    key = F.substring(F.upper("fornecedor_nome"), 1, 30)
    return use.groupBy("batch_id", key.alias("fornecedor"), F.col("valor").cast("decimal(18,2)").cast("double").alias("valor")).agg(F.count("*").alias("vezes")).filter("vezes > 1")


def _of_batch(value: Column, where: Column) -> Column:
    """The value of a batch's first row that qualifies, on every row of the batch."""
    return F.min_by(F.when(where, value), F.when(where, F.col("ordinal"))).over(Window.partitionBy("batch_id"))


def inherited(docs: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """docs with empty fields filled from the other documents of the batch, then from its e-mail.

    A slip takes its reference from the first DANFE, NFSE or OUTRO with a number; an invoice takes its due date from the first slip;
    the first order number goes to every row. metadata: (batch_id, email_vencimento, email_pedido, email_nota); its due date is used
    only in a batch that has none from a slip, its number only in one without any.
    """
    has = lambda c: T.blank_to_null(c).isNotNull()
    is_ = lambda t: F.col("doc_type") == t
    number = F.coalesce(*[_of_batch(F.col(c), is_(t) & has(c)) for t, c in (("DANFE", "numero_nota"), ("NFSE", "numero_nota"), ("OUTRO", "numero_documento"))])
    out = docs.withColumn("_n", number).withColumn("_v", _of_batch(F.col("vencimento"), is_("BOLETO") & has("vencimento"))).withColumn("_p", _of_batch(F.col("numero_pedido"), has("numero_pedido")))
    due = F.when(F.col("doc_type").isin("DANFE", "NFSE"), F.coalesce(T.blank_to_null("vencimento"), "_v")).otherwise(T.blank_to_null("vencimento"))
    out = out.withColumn("vencimento", due).withColumn("referencia_nfse", F.when(is_("BOLETO"), F.col("_n"))).withColumn("numero_pedido", F.coalesce(T.blank_to_null("numero_pedido"), "_p"))
    if metadata is not None:
        out = out.join(metadata, "batch_id", "left")
        out = out.withColumn("vencimento", F.when(F.col("_v").isNull(), F.coalesce("vencimento", "email_vencimento")).otherwise(F.col("vencimento")))
        out = out.withColumn("numero_pedido", F.coalesce("numero_pedido", "email_pedido"))
        out = out.withColumn("numero_nota", F.when(F.col("_n").isNull() & F.col("doc_type").isin("DANFE", "NFSE"), F.coalesce(T.blank_to_null("numero_nota"), "email_nota")).otherwise(F.col("numero_nota")))
        out = out.drop("email_vencimento", "email_pedido", "email_nota")
    return out.drop("_n", "_v", "_p")


def with_context(docs: DataFrame) -> DataFrame:
    """docs with the status and purchase value of their batch."""
    return docs.join(reconciled(docs).select("batch_id", F.col("status").alias("status_conciliacao"), "valor_compra"), "batch_id")


# What a complete XML invoice has.
REQUIRED = {"fornecedor_nome": "fornecedor_nome", "vencimento": "vencimento", "numero_nota": "numero_nota"}


def missing_fields(extra: str = "valor") -> Column:
    """The names of the required fields that are empty, the value among them if it isn't positive."""
    return F.array_compact(F.array(*[F.when(T.blank_to_null(c).isNull(), n) for c, n in REQUIRED.items()], F.when(F.coalesce(F.col(extra), F.lit(0.0)) <= 0, extra)))


def is_complete() -> Column:
    return F.col("doc_type").isin("NFSE", "DANFE") & (F.size(missing_fields()) == 0)


FILLED = ["fornecedor_nome", "vencimento", "numero_nota", "numero_pedido", "cnpj", "data_emissao", "valor"]


def merged(xml: DataFrame, pdf: DataFrame) -> DataFrame:
    """XML rows, filled from the PDF of the same document, and the PDF rows that no complete XML row covers.

    A PDF is an XML row's if the numbers are equal, or the suppliers and, within the tolerance, the values; the first one counts.
    """
    key = lambda: T.supplier_name("fornecedor_nome", upper=True)
    x = xml.withColumn("_s", F.nullif(key(), F.lit(""))).withColumn("_c", F.round(F.col("valor") * 100).cast("long"))
    p = pdf.select("batch_id", F.col("ordinal").alias("_o"), F.struct(*FILLED).alias("_pdf"), T.blank_to_null("numero_nota").alias("_n"), F.nullif(key(), F.lit("")).alias("_ps"), F.round(F.col("valor") * 100).cast("long").alias("_pc"))
    rows = x.select("batch_id", "ordinal", "numero_nota", "_s", "_c")
    by_number = rows.join(p, (rows["batch_id"] == p["batch_id"]) & (rows["numero_nota"] == p["_n"])).select(rows["batch_id"], rows["ordinal"], "_o", "_pdf")
    near = p.withColumn("_pc", F.explode(F.array(F.col("_pc") - 1, F.col("_pc"), F.col("_pc") + 1)))
    by_value = rows.filter("_c > 0").join(near, (rows["batch_id"] == near["batch_id"]) & (rows["_s"] == near["_ps"]) & (rows["_c"] == near["_pc"])).select(rows["batch_id"], rows["ordinal"], "_o", "_pdf")
    found = by_number.union(by_value).groupBy("batch_id", "ordinal").agg(F.min_by("_pdf", "_o").alias("_pdf"))
    full = xml.join(found, ["batch_id", "ordinal"], "left")
    for c in FILLED:
        own = T.blank_to_null(c) if c != "valor" else F.when(F.col("valor") > 0, F.col("valor"))
        full = full.withColumn(c, F.coalesce(own, F.col(f"_pdf.{c}"), F.col(c)))
    full = full.drop("_pdf").select(xml.columns)
    covered = full.filter(is_complete()).select("batch_id", F.col("numero_nota").alias("covered")).distinct()
    left = pdf.join(covered, (pdf["batch_id"] == covered["batch_id"]) & (pdf["numero_nota"] == covered["covered"]), "left_anti")
    return full.unionByName(left.select(xml.columns))


def has_note_with_value(docs: DataFrame) -> DataFrame:
    """(batch_id, nota_com_valor): whether any document that isn't a slip has a value."""
    return docs.groupBy("batch_id").agg(F.coalesce(F.bool_or((F.col("doc_type") != "BOLETO") & (F.col("valor") > 0)), F.lit(False)).alias("nota_com_valor"))


def with_subject(rows: DataFrame, metadata: DataFrame) -> DataFrame:
    """Adds assunto, the subject of the batch's e-mail. metadata: (batch_id, email_subject)."""
    return rows.join(metadata.select("batch_id", F.col("email_subject").alias("assunto")).dropDuplicates(["batch_id"]), "batch_id", "left")


def correlated(docs: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """The whole correlation: fields from the e-mail and the other documents, then the batch's status on every row.

    Adds referencia_nfse, status_conciliacao, valor_compra, divergencia, duplicados and sem_vencimento. One shuffle by batch serves
    the windows; the status is an aggregate of the same key.
    """
    full = inherited(docs, metadata)
    twice = duplicates_by_number(full).groupBy("batch_id").agg(F.array_join(F.array_sort(F.collect_list("numero")), ",").alias("duplicados"))
    state = reconciled(full).select("batch_id", F.col("status").alias("status_conciliacao"), "valor_compra", "divergencia")
    due = first_due_date(full).select("batch_id", F.col("vencimento").isNull().alias("sem_vencimento"))
    return full.join(state.join(twice, "batch_id", "left").join(due, "batch_id", "left"), "batch_id")


def batch_key(received: str, message: str) -> Column:
    """An id for a batch, email_yyyyMMdd_HHmmss_ and eight digits of the message's digest: the same message always gets the same."""
    return F.concat(F.lit("email_"), F.date_format(received, "yyyyMMdd_HHmmss"), F.lit("_"), F.substring(F.sha2(F.coalesce(F.col(message), F.lit("")).cast("binary"), 256), 1, 8))


def batch_day(batch: str) -> Column:
    """The day in a batch's id; null for an id of another form."""
    return F.try_to_date(F.get(F.split(F.col(batch), "_"), F.lit(1)), "yyyyMMdd")


def batch_of_path(path: str) -> Column:
    """The last folder of a path with either separator; DESCONHECIDO without one."""
    return F.coalesce(T.blank_to_null(F.element_at(F.split(F.replace(F.col(path), F.lit("\\"), F.lit("/")), "/"), -1)), F.when(T.blank_to_null(path).isNotNull(), F.lit("")), F.lit("DESCONHECIDO"))
