"""Row forms of the reports and their sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import text as T

# The columns of the reports, in their order.
SHEET_18 = ["DATA", "SETOR", "EMPRESA", "FORNECEDOR", "NF", "EMISSÃO", "VALOR", "Nº PEDIDO", "VENCIMENTO", "FORMA PAGTO", "INDICE", "DT CLASS", "Nº FAT", "TP DOC", "TRAT PAF", "LANC SISTEMA", "OBSERVAÇÕES", "OBS INTERNA"]
SHEET_11 = ["DATA", "ASSUNTO", "N_PEDIDO", "EMPRESA", "VENCIMENTO", "FORNECEDOR", "NF", "VALOR", "SITUACAO", "AVISOS", "ARQUIVO"]
SHEET_9 = ["DATA", "ASSUNTO", "N_PEDIDO", "EMPRESA", "FORNECEDOR", "NF", "LINK", "CODIGO", "OBSERVACAO"]


def br_date(x: str | Column) -> Column:
    """yyyy-MM-dd as dd/MM/yyyy; empty for anything else."""
    return F.coalesce(F.date_format(F.try_to_date(F.col(x) if isinstance(x, str) else x, "yyyy-MM-dd"), "dd/MM/yyyy"), F.lit(""))


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def _number() -> Column:
    return F.when(F.col("doc_type") == "BOLETO", F.coalesce("referencia_nfse", "numero_documento")).when(F.col("doc_type") == "OUTRO", F.col("numero_documento")).otherwise(F.col("numero_nota"))


def sheet_18(docs: DataFrame, as_of: str) -> DataFrame:
    """One row of 18 columns for each document."""
    number, kind = F.coalesce(_number(), F.lit("")), F.col("doc_type")
    values = [
        br_date(F.lit(as_of)), F.lit(""), _text("empresa"), T.supplier_name("fornecedor_nome"), number, br_date("data_emissao"), F.coalesce("valor", F.lit(0.0)), _text("numero_pedido"), br_date("vencimento"),
        F.when(kind == "BOLETO", "BOLETO").otherwise(""), F.lit(""), br_date(F.lit(as_of)), F.when(kind == "BOLETO", number).otherwise(""), kind, F.lit("PENDENTE"), F.lit("PENDENTE"), F.lit(""), F.lit(""),
    ]
    return docs.select("batch_id", "ordinal", *[v.alias(n) for v, n in zip(values, SHEET_18, strict=True)])


def sheet_11(docs: DataFrame, as_of: str) -> DataFrame:
    """One row of 11 columns for each document with a file; docs has subject, situacao and avisos."""
    values = [br_date(F.lit(as_of)), _text("subject"), _text("numero_pedido"), _text("empresa"), br_date("vencimento"), T.supplier_name("fornecedor_nome"), F.coalesce(_number(), F.lit("")), F.coalesce("valor", F.lit(0.0)), _text("situacao"), _text("avisos"), _text("arquivo_origem")]
    return docs.select("batch_id", "ordinal", *[v.alias(n) for v, n in zip(values, SHEET_11, strict=True)])


def sheet_9(notices: DataFrame, as_of: str) -> DataFrame:
    """One row of 9 columns for each notice (email_id, subject, numero_pedido, empresa, fornecedor_nome, numero_nota, link, codigo)."""
    values = [br_date(F.lit(as_of)), _text("subject"), _text("numero_pedido"), _text("empresa"), _text("fornecedor_nome"), _text("numero_nota"), F.substring(_text("link"), 1, 80), _text("codigo"), F.lit("PENDENTE_DOWNLOAD")]
    return notices.select("email_id", *[v.alias(n) for v, n in zip(values, SHEET_9, strict=True)])


def consolidated(*parts: DataFrame) -> DataFrame:
    """The union of rows of different types, with the columns that any has."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def as_csv_columns(df: DataFrame) -> DataFrame:
    """Doubles with a decimal comma, arrays joined, the rest as text."""
    def form(name: str, kind: str) -> Column:
        if kind in ("double", "float"):
            return F.replace(F.format_string("%.2f", F.col(name)), F.lit("."), F.lit(",")).alias(name)
        if kind.startswith("array"):
            return F.array_join(F.transform(name, lambda x: x.cast("string")), ",").alias(name)
        return F.col(name).cast("string").alias(name)

    return df.select(*[form(n, k) for n, k in df.dtypes])


def write_csv(df: DataFrame, path: str, bom: bool = True) -> None:
    """One CSV dialect for all reports: semicolons, decimal commas, a header that begins with a byte order mark. Files stay partitioned."""
    out = as_csv_columns(df)
    if bom:
        out = out.withColumnRenamed(out.columns[0], "﻿" + out.columns[0])
    out.write.mode("overwrite").option("header", True).option("sep", ";").csv(path)


def write_by_type(docs: DataFrame, path: str) -> None:
    """A folder for each document type, so that readers of one type skip the others."""
    as_csv_columns(docs.withColumn("tipo", F.col("doc_type"))).write.mode("overwrite").partitionBy("tipo").option("header", True).option("sep", ";").csv(path)


def write_partial(df: DataFrame, path: str) -> None:
    """Appends rows as JSON lines."""
    df.write.mode("append").json(path)


def by_subject(batches: DataFrame) -> DataFrame:
    """(assunto, lotes, n): batches whose subjects agree but for case and white space, where there are several."""
    key = F.lower(T.spaces(F.regexp_replace("subject", r"\s+", " ")))
    return batches.groupBy(key.alias("assunto")).agg(F.array_sort(F.collect_list("batch_id")).alias("lotes"), F.count("*").alias("n")).filter("n > 1")


def expired(batches: DataFrame, as_of: str, hours: int) -> DataFrame:
    """The batches older than so many hours; deleting them is the caller's decision."""
    return batches.filter(F.col("received") < F.to_timestamp(F.lit(as_of)) - F.make_interval(hours=F.lit(hours)))


def quality_text(rates: DataFrame) -> DataFrame:
    """(line) of a text report on success rates, a line for each type."""
    return rates.select("doc_type", F.concat_ws(" | ", F.rpad("doc_type", 8, " "), F.concat(F.lit("total "), F.col("total")), F.concat(F.lit("sucesso "), F.col("sucessos")), F.concat(F.lit("falha "), F.col("falhas"))).alias("line"))


def commands(cases: DataFrame, size: int = 5) -> DataFrame:
    """(grupo, lotes): batch ids in groups of `size`, in order. cases is an audit's list of problem batches."""
    from pyspark.sql import Window

    n = F.floor((F.row_number().over(Window.orderBy("batch_id")) - 1) / size)
    return cases.withColumn("grupo", n).groupBy("grupo").agg(F.array_sort(F.collect_list("batch_id")).alias("lotes"))
