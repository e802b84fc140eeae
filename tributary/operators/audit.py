"""Audits of what was extracted: issue lists, cases, classes of batches, validation exports and text reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import text as T
from tributary.operators import classify as C

#: The issue lists of a case, in their order.
ISSUES = ["fornecedor", "valor", "vencimento", "numero_nota", "extrator", "data"]


def _list(*issues: Column) -> Column:
    return F.array_compact(F.array(*issues))


def quality(cases: DataFrame) -> DataFrame:
    """Adds an array of issues for each of ISSUES, their number and severidade.

    cases: fornecedor, vencimento (yyyy-MM-dd), valor_compra, outros, nfses, numero_nota, email_subject.
    """
    subject = F.upper(F.coalesce(F.col("email_subject"), F.lit("")))
    due, has_due = C.due_date_problems("vencimento"), T.blank_to_null("vencimento").isNotNull()
    slipish, late = subject.rlike("BOLETO|FATURA"), subject.rlike("VENCIMENTO|VENCE")
    missing = ~has_due & (F.col("outros") > 0) & (F.col("nfses") == 0)
    told = F.concat(F.lit("Vencimento não extraído"), F.when(slipish | late, " (assunto sugere boleto/fatura)").otherwise(" (pode ser boleto)"))
    found = {
        "fornecedor": C.supplier_problems("fornecedor"),
        "valor": _list(F.when((F.coalesce(F.col("valor_compra"), F.lit(0.0)) == 0) & ((F.col("outros") > 0) | (F.col("nfses") > 0)), F.concat(F.lit("Valor zero com "), F.col("outros").cast("string"), F.lit(" outros e "), F.col("nfses").cast("string"), F.lit(" NFSEs")))),
        "vencimento": F.concat(F.filter(due, lambda p: p != "AUSENTE"), _list(F.when(missing, told))),
        "numero_nota": _list(F.when((F.col("nfses") > 0) & T.blank_to_null("numero_nota").isNull(), F.lit("Número da nota não extraído (para NFSE)"))),
        "extrator": _list(F.when(slipish, "Assunto sugere boleto/fatura").when(subject.rlike("NF|NOTA"), "Assunto sugere nota fiscal")),
        "data": _list(F.when(has_due & (F.size(due) > 0), "Data de vencimento inválida"), F.when(missing, "Data de vencimento faltante")),
    }
    out = cases.withColumns({f"{k}_issues": v for k, v in found.items()})
    n = sum((F.size(f"{k}_issues") for k in ISSUES if k != "extrator"), F.lit(0))
    return out.withColumn("n_issues", n).withColumn("severidade", C.severity(F.col("n_issues")))


def filtered(cases: DataFrame, severity: str | None = None, classification: str | None = None, issue: str | None = None, first: int | None = None, last: int | None = None) -> DataFrame:
    """The cases that meet every condition given. cases: id, severity, classification, issues array; a case without an id has no place in a range."""
    for value, rule in (
        (severity, lambda v: F.col("severity") == v.upper()), (classification, lambda v: F.col("classification") == v.upper()),
        (issue, lambda v: F.exists("issues", lambda i: F.upper(i) == v.upper())), (first, lambda v: F.col("id") >= v), (last, lambda v: F.col("id") <= v),
    ):
        if value is not None:
            cases = cases.filter(rule(value))
    return cases


def batch_class(pdfs: DataFrame, key: str = "batch_id") -> DataFrame:
    """(key, total, nfse, admin, com_valor, classe, acao) of a batch's texts. pdfs: key, text, outros, the batch's number of other documents."""
    each = pdfs.select(key, "outros", C.text_class("text")["classe"].alias("_c"), (T.money_max("text") > 0).alias("_v"))
    got = each.groupBy(key).agg(F.count("*").alias("total"), F.count_if(F.col("_c") == "NFSE").alias("nfse"), F.count_if(F.col("_c") == "ADMIN").alias("admin"), F.count_if("_v").alias("com_valor"), F.max("outros").alias("_o"))
    kind = F.when((F.col("nfse") > 0) & (F.col("admin") > 0), "MISTO").when(F.col("nfse") > 0, "NFSE").when(F.col("admin") > 0, "ADMIN").otherwise("DESCONHECIDO")
    todo = F.when((F.col("nfse") > 0) & (F.col("_o") > 0), "REVISAR_CLASSIFICACAO").when(F.col("com_valor") > 0, "MELHORAR_EXTRACAO").when(F.col("admin") > 0, "DOCUMENTO_ADMIN_OK").otherwise("INVESTIGAR_MANUALMENTE")
    return got.withColumn("classe", kind).withColumn("acao", todo).drop("_o")


def counts(cases: DataFrame, *columns: str) -> DataFrame:
    """(coluna, valor, n): how often each value of each column occurs, in one pass; arrays count by their elements."""
    kinds = dict(cases.dtypes)
    each = F.flatten(F.array(*[_pairs(c, kinds[c]) for c in columns]))
    return cases.select(F.inline(each)).groupBy("coluna", "valor").agg(F.count("*").alias("n"))


def _pairs(c: str, kind: str) -> Column:
    values = F.coalesce(F.col(c), F.array().cast(kind)) if kind.startswith("array") else F.array(c)
    return F.transform(values, lambda v: F.struct(F.lit(c).alias("coluna"), v.cast("string").alias("valor")))


def report(cases: DataFrame) -> DataFrame:
    """(batch_id, text): a text block for each case of quality(), its issue lists by name."""
    part = lambda k: F.when(F.size(f"{k}_issues") > 0, F.concat(F.lit(f"  {k}: "), F.array_join(f"{k}_issues", "; ")))
    head = F.concat(F.lit("Caso "), F.col("batch_id").cast("string"), F.lit(" | severidade: "), F.col("severidade"), F.lit(" | problemas: "), F.col("n_issues").cast("string"))
    return cases.select("batch_id", F.concat_ws("\n", head, *[part(k) for k in ISSUES]).alias("text"))


def write_validation(docs: DataFrame, path: str) -> None:
    """Classified documents as CSV in folders by type and success: four types in two outcomes."""
    from tributary.operators.reports import as_csv_columns

    out = as_csv_columns(docs).withColumn("tipo", F.col("doc_type")).withColumn("ok", F.col("sucesso"))
    out.write.mode("overwrite").partitionBy("tipo", "ok").option("header", True).option("sep", ";").csv(path)


def processed(names: DataFrame, column: str = "name") -> DataFrame:
    """The distinct names, sorted without regard to case."""
    return names.select(column).dropna().distinct().orderBy(F.lower(column), column)
