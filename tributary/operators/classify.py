"""Quality of extracted documents: success and its reasons, situation of a due date, validity, severity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import text as T
from tributary.functions.calendar import with_working_days

#: Working days that a document must leave until it is due.
DEADLINE = 4


def _has(c: str) -> Column:
    return T.blank_to_null(c).isNotNull()


def _positive(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0.0)) > 0


def with_deadline(docs: DataFrame, start: str = "dt_classificacao") -> DataFrame:
    """Adds dias_uteis from the classification to the due date, and prazo_ok; a document without a due date passes."""
    dated = docs.withColumn("_from", F.try_to_date(start, "yyyy-MM-dd")).withColumn("_to", F.try_to_date("vencimento", "yyyy-MM-dd"))
    out = with_working_days(dated, "_from", "_to")
    return out.withColumn("prazo_ok", F.coalesce(F.col("dias_uteis") >= DEADLINE, F.lit(True))).drop("_from", "_to")


def situation(docs: DataFrame, as_of: str, number: str = "numero_nota", value: str = "valor") -> DataFrame:
    """Adds situacao and avisos: DIVERGENTE for missing fields, VENCIDO, VENCIMENTO_PROXIMO, CONFERIR or OK, as of a day."""
    dated = docs.withColumn("_now", F.to_date(F.lit(as_of))).withColumn("_due", F.try_to_date("vencimento", "yyyy-MM-dd"))
    dated = with_working_days(dated, "_now", "_due", "_days")
    missing = F.array_compact(F.array(F.when(~_has(number), "NF"), F.when(~_positive(value), "VALOR")))
    late, soon = F.col("_due") < F.col("_now"), F.col("_days") <= DEADLINE
    state = F.when(F.size(missing) > 0, "DIVERGENTE").when(F.col("_due").isNull(), F.when(_has("vencimento"), "OK").otherwise("CONFERIR")).when(late, "VENCIDO").when(soon, "VENCIMENTO_PROXIMO").otherwise("OK")
    told = F.concat_ws(
        " | ", F.when(F.size(missing) > 0, F.concat(F.lit("[DIVERGENTE] Campos faltando: "), F.array_join(missing, ", "))),
        F.when(late, F.concat(F.lit("[VENCIDO] Vencimento em "), F.date_format("_due", "dd/MM/yyyy"))).when(soon, F.concat(F.lit("[URGENTE] Apenas "), F.col("_days").cast("string"), F.lit(" dias úteis até vencimento"))).when(~_has("vencimento"), "[CONFERIR] Vencimento não informado"),
    )
    return dated.withColumn("situacao", state).withColumn("avisos", told).drop("_now", "_due", "_days")


def _late() -> Column:
    return F.when(~F.col("prazo_ok"), F.concat(F.lit("PRAZO_INSUFICIENTE_"), F.col("dias_uteis").cast("string"), F.lit("d")))


def service_invoice(need_number: bool = False) -> tuple[Column, Column]:
    """(sucesso, motivos) of an NFSE. A missing CNPJ is a reason, but doesn't fail it; the number counts if it is needed."""
    number = [F.when(~_has("numero_nota"), "SEM_NUMERO")] if need_number else []
    why = F.array_compact(F.array(*number, F.when(~_positive("valor"), "VALOR_ZERO"), F.when(~_has("cnpj"), "SEM_CNPJ"), F.when(~_has("fornecedor_nome"), "SEM_RAZAO_SOCIAL"), _late()))
    ok = _positive("valor") & _has("fornecedor_nome") & F.col("prazo_ok")
    return (ok & _has("numero_nota") if need_number else ok), why


def slip() -> tuple[Column, Column]:
    """(sucesso, motivos) of a BOLETO: a value, a supplier, and a due date or the digits of its line."""
    why = F.array_compact(F.array(F.when(~_positive("valor"), "VALOR_ZERO"), F.when(~_has("vencimento"), "SEM_VENCIMENTO"), F.when(~_has("linha_digitavel"), "SEM_LINHA_DIGITAVEL"), F.when(~_has("fornecedor_nome"), "SEM_RAZAO_SOCIAL"), _late()))
    return _positive("valor") & (_has("vencimento") | _has("linha_digitavel")) & _has("fornecedor_nome") & F.col("prazo_ok"), why


def product_invoice() -> tuple[Column, Column]:
    """(sucesso, motivos) of a DANFE."""
    return _positive("valor") & _has("fornecedor_nome"), F.array_compact(F.array(F.when(~_positive("valor"), "VALOR_ZERO"), F.when(~_has("fornecedor_nome"), "SEM_RAZAO_SOCIAL"), F.when(~_has("numero_nota"), "SEM_NUMERO")))


def other() -> tuple[Column, Column]:
    """(sucesso, motivos) of an OUTRO."""
    return _positive("valor") & _has("fornecedor_nome"), F.array_compact(F.array(F.when(~_positive("valor"), "VALOR_ZERO"), F.when(~_has("fornecedor_nome"), "SEM_RAZAO_SOCIAL")))


def classified(docs: DataFrame) -> DataFrame:
    """Adds sucesso and motivos by type; docs has dt_classificacao and linha_digitavel besides the usual columns."""
    out, rules = with_deadline(docs), {"NFSE": service_invoice(), "BOLETO": slip(), "DANFE": product_invoice(), "OUTRO": other()}
    pick = lambda i: F.coalesce(*[F.when(F.col("doc_type") == t, r[i]) for t, r in rules.items()])
    return out.withColumn("sucesso", pick(0)).withColumn("motivos", pick(1))


def success_rates(docs: DataFrame) -> DataFrame:
    """Documents, successes, failures and the rate in percent, by type."""
    got = docs.groupBy("doc_type").agg(F.count("*").alias("total"), F.count_if("sucesso").alias("sucessos"))
    return got.withColumn("falhas", F.col("total") - F.col("sucessos")).withColumn("taxa", F.try_divide(F.col("sucessos") * 100, F.col("total")))


def failure_type(file="arquivo_origem", text="texto", number="numero_nota", value="valor") -> Column:
    """What probably went wrong with an extraction."""
    f, t = F.lower(F.coalesce(F.col(file), F.lit(""))), F.lower(F.coalesce(F.col(text), F.lit("")))
    return (
        F.when(f.contains("boleto") | f.contains("recibo"), "BOLETO/RECIBO (Ignorar se não for NF).")
        .when(t.contains("locação") | t.contains("locacao"), "LOCAÇÃO (Layout atípico).")
        .when(F.coalesce(F.col(value), F.lit(0.0)) == 0, "Regex de VALOR falhou.")
        .when(~_has(number) | (F.col(number) == "VAZIO"), "Regex de NÚMERO DA NOTA falhou.")
        .otherwise("Falha genérica de extração.")
    )


# Years that a due date can have, and labels that are no supplier.
YEARS = (2020, 2035)
NOT_A_SUPPLIER = ["CNPJ", "CPF", "FORNECEDOR", "BENEFICIÁRIO", "BENEFICIARIO", "CEDENTE", "PRESTADOR", "RAZÃO SOCIAL", "RAZAO SOCIAL", "NOME", "EMITENTE", "PAGADOR"]


def due_date_problems(x="vencimento") -> Column:
    """The problems of a due date: AUSENTE, INVALIDO or ANO_FORA."""
    day = F.try_to_date(F.col(x), "yyyy-MM-dd")
    return F.array_compact(F.array(F.when(~_has(x), "AUSENTE"), F.when(_has(x) & day.isNull(), "INVALIDO"), F.when(~F.year(day).between(*YEARS), "ANO_FORA")))


def supplier_problems(x="fornecedor_nome") -> Column:
    """The problems of a supplier's name: AUSENTE, GENERICO, CURTO or SO_NUMEROS."""
    t = F.upper(F.trim(F.col(x)))
    bare = F.regexp_replace(t, r"[\s:\-]+$", "")
    return F.array_compact(F.array(F.when(~_has(x), "AUSENTE"), F.when(bare.isin(NOT_A_SUPPLIER), "GENERICO"), F.when(_has(x) & (F.length(t) < 3), "CURTO"), F.when(t.rlike(r"^[\d\s.\-/]+$") & _has(x), "SO_NUMEROS")))


def severity(n: Column) -> Column:
    """BAIXA without problems, MEDIA with up to two, ALTA beyond."""
    return F.when(n == 0, "BAIXA").when(n <= 2, "MEDIA").otherwise("ALTA")


# Words that tell service invoices from administrative papers.
INVOICE_WORDS = ["nota fiscal", "nfs-e", "nfse", "prestador", "tomador", "iss", "valor dos serviços", "código de verificação"]
ADMIN_WORDS = ["contrato", "distrato", "ordem de serviço", "agendamento", "proposta", "relatório", "comunicado", "notificação"]


def text_class(x="text") -> Column:
    """(classe, confianca): NFSE or ADMIN by which has more words in the text, and its share of them; DESCONHECIDO without any."""
    t = F.lower(F.coalesce(F.col(x), F.lit("")))
    count = lambda ws: sum((t.contains(w).cast("int") for w in ws), F.lit(0))
    a, b = count(INVOICE_WORDS), count(ADMIN_WORDS)
    return F.struct(F.when(a + b == 0, "DESCONHECIDO").when(a >= b, "NFSE").otherwise("ADMIN").alias("classe"), F.coalesce(F.try_divide(F.greatest(a, b), a + b), F.lit(0.0)).alias("confianca"))


def withholdings(*names: str) -> Column:
    """The sum of taxes, nulls as 0, in exact cents."""
    return sum((F.coalesce(F.col(c), F.lit(0.0)).cast("decimal(18,2)") for c in names), F.lit(0).cast("decimal(18,2)")).cast("double")


def problem_cases(batches: DataFrame) -> DataFrame:
    """Batches with other documents or service invoices, but no purchase value."""
    return batches.filter(((F.col("outros") > 0) | (F.col("nfses") > 0)) & (F.col("valor_compra") == 0))


def problem_type(x="subject") -> Column:
    """What a batch without a value is about, by its subject."""
    t = F.lower(F.coalesce(F.col(x), F.lit("")))
    return F.when(t.contains("nf-e") | t.contains("nota"), "NOTA_FISCAL").when(t.contains("fatura"), "FATURA").when(t.contains("boleto"), "BOLETO").when(t.contains("contrato"), "CONTRATO").otherwise("OUTRO")
