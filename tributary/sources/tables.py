"""Fiscal views of the driver's tables: batches of invoices and slips, e-mails, log lines and document texts.

Each view comes twice: as a DataFrame, and as the text of a DuckDB view of the same rows for the checks (FIXTURE).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.functions import text as T


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _iso(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd")


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoices of a batch, in the order of their files: doc_type NFSE, DANFE or OUTRO, from lineitem and supplier."""
    line, supplier = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    place = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    kind = F.when(F.col("l_returnflag") == "A", "NFSE").when(F.col("l_returnflag") == "R", "DANFE").otherwise("OUTRO")
    number = F.when(F.col("l_partkey") % 7 != 0, (F.col("l_partkey") % 50).cast("string"))
    return (
        line.withColumn("ordinal", F.row_number().over(place))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("l_orderkey").alias("batch_id"), "ordinal", kind.alias("doc_type"),
            F.when(kind != "OUTRO", number).alias("numero_nota"), F.when(kind == "OUTRO", number).alias("numero_documento"),
            F.when(F.col("l_suppkey") % 5 == 0, F.concat(F.lit("PED-"), F.col("l_suppkey").cast("string"))).alias("numero_pedido"),
            F.col("s_name").alias("fornecedor_nome"), F.concat(F.lpad(F.col("l_suppkey").cast("string"), 8, "0"), F.lit("000100")).alias("cnpj"),
            F.when(F.col("l_linenumber") % 5 != 0, F.col("l_extendedprice")).otherwise(0.0).alias("valor"), _iso("l_shipdate").alias("data_emissao"),
            F.when(F.col("l_linestatus") != "F", _iso(F.col("l_shipdate") + F.expr("INTERVAL 30 DAYS"))).alias("vencimento"),
            F.concat(F.when(kind == "OUTRO", "recibo_").otherwise("NF "), F.col("l_linenumber").cast("string"), F.lit(".pdf")).alias("arquivo_origem"),
        )
    )


def slips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bank slip for each order that isn't open; a third repeat the value of the batch's first invoice with one."""
    orders = load(spark, sf_dir, "orders").filter("o_orderstatus <> 'O'")
    first = invoices(spark, sf_dir).filter("valor > 0").groupBy("batch_id").agg(F.min_by("valor", "ordinal").alias("first"))
    return orders.join(first, F.col("o_orderkey") == F.col("batch_id"), "left").select(
        F.col("o_orderkey").alias("batch_id"), F.lit(1000).alias("ordinal"), F.lit("BOLETO").alias("doc_type"), F.lit(None).cast("string").alias("numero_nota"),
        (F.col("o_orderkey") % 50).cast("string").alias("numero_documento"), F.lit(None).cast("string").alias("numero_pedido"),
        F.concat(F.lit("Beneficiário: Customer "), F.col("o_custkey").cast("string")).alias("fornecedor_nome"), F.concat(F.lpad(F.col("o_custkey").cast("string"), 8, "0"), F.lit("000200")).alias("cnpj"),
        F.when((F.col("o_orderkey") % 3 == 0) & F.col("first").isNotNull(), F.col("first")).otherwise(F.col("o_totalprice")).alias("valor"), _iso("o_orderdate").alias("data_emissao"),
        F.when(F.col("o_orderkey") % 4 != 0, _iso(F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"))).alias("vencimento"), F.concat(F.lit("BOLETO "), F.col("o_orderkey").cast("string"), F.lit(".pdf")).alias("arquivo_origem"),
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents of all batches."""
    return invoices(spark, sf_dir).unionByName(slips(spark, sf_dir))


# The subjects that event types stand for.
SUBJECTS = {"purchase": "Fatura {}", "signup": "Comunicado {}", "error": "NF-e {}", "click": "Re: Re: {}", "view": "Boleto {}"}
SENDERS = ["cobranca@fornecedor{}.com.br", "newsletter@loja.com", "joao@cliente.com.br", "noreply@github.com"]


def emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An e-mail for each event."""
    e = load(spark, sf_dir, "events")
    key = F.col("event_id").cast("string")
    subject = F.coalesce(*[F.when(F.col("event_type") == k, F.replace(F.lit(v), F.lit("{}"), key)) for k, v in SUBJECTS.items()])
    sender = F.coalesce(*[F.when(F.col("user_id") % 4 == i, F.replace(F.lit(v), F.lit("{}"), F.col("user_id").cast("string"))) for i, v in enumerate(SENDERS)])
    attached = F.when(F.col("event_id") % 2 == 0, F.array(F.concat(F.lit("nota"), key, F.when(F.col("event_id") % 4 == 0, ".pdf").otherwise(".png"))))
    return e.select(F.col("event_id").alias("email_id"), "ts", subject.alias("subject"), sender.alias("sender_address"), attached.alias("attachments"), (F.col("event_id") % 7 == 0).alias("has_attachment"), (F.col("event_id") % 3 == 0).alias("has_links_nfe"), (F.col("event_id") % 5 == 0).alias("has_verification_code"))


def slip_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of a bank slip for each order, thirty years later, with its value, due date and 47-digit line."""
    o = load(spark, sf_dir, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    key, issued = F.col("o_orderkey").cast("string"), F.add_months("o_orderdate", 360)
    line = F.concat(F.lit("23793.38128 60000.000003 00000.000405 1 8434"), F.lpad(cents.cast("string"), 10, "0"))
    body = F.concat(
        F.lit("Banco Bradesco S.A.\nBeneficiário: COMERCIAL "), F.col("o_custkey").cast("string"), F.lit(" LTDA CNPJ "), T.cnpj_format(F.concat(F.lpad(F.col("o_custkey").cast("string"), 8, "0"), F.lit("000200"))),
        F.lit("\nNosso Número: 09/"), F.lpad(key, 11, "0"), F.lit("-4\nNúmero do Documento: "), key, F.lit("\nData do Documento: "), F.date_format(issued, "dd/MM/yyyy"),
        F.lit("\nVENCIMENTO: "), F.date_format(F.date_add(issued, 30), "dd/MM/yyyy"), F.lit("\nVALOR DO DOCUMENTO: R$ "), T.money_text(cents), F.lit("\n"), line,
    )
    return o.select(F.col("o_orderkey").alias("doc_id"), body.alias("text"))


def invoice_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of an invoice for each line: a service invoice, a product invoice with its 44-digit key, a rental invoice or an energy bill."""
    line, supplier = load(spark, sf_dir, "lineitem"), load(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    place = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    cnpj = T.cnpj_format(F.concat(F.lpad(F.col("l_suppkey").cast("string"), 8, "0"), F.lit("000100")))
    shipped, due = F.date_format("l_shipdate", "dd/MM/yyyy"), F.date_format(F.col("l_shipdate") + F.expr("INTERVAL 30 DAYS"), "dd/MM/yyyy")
    part, value = F.col("l_partkey").cast("string"), T.money_text(cents)
    service = F.concat(F.lit("PREFEITURA MUNICIPAL\nNOTA FISCAL DE SERVIÇOS ELETRÔNICA - NFS-e\nNúmero da Nota: "), part, F.lit("\nData e Hora de Emissão: "), shipped, F.lit(" 10:30:00\nPRESTADOR DE SERVIÇOS\nRazão Social: "), F.col("s_name"), F.lit("\nCNPJ: "), cnpj, F.lit("\nVALOR TOTAL DO SERVIÇO = R$ "), value, F.lit("\nISS R$ "), T.money_text(F.floor(cents / 20)), F.lit("\nVencimento: "), due)
    key = F.concat(F.lit("3525"), F.lpad(F.col("l_suppkey").cast("string"), 16, "0"), F.lpad(part, 24, "0"))
    product = F.concat(F.lit("DANFE\nDOCUMENTO AUXILIAR DA NOTA FISCAL ELETRÔNICA\nEmitente: "), F.col("s_name"), F.lit("\nCNPJ "), cnpj, F.lit("\nNº "), part, F.lit(" SÉRIE 1\nCHAVE DE ACESSO\n"), key, F.lit("\nDATA DA EMISSÃO "), shipped, F.lit("\nFATURA/DUPLICATAS 001 "), due, F.lit(" "), value, F.lit("\nVALOR TOTAL DA NOTA "), value)
    rental = F.concat(F.lit("FATURA DE LOCAÇÃO\nDEMONSTRATIVO DE LOCAÇÃO Nº "), part, F.lit("\nLocador: "), F.col("s_name"), F.lit("\nCNPJ "), cnpj, F.lit("\nEmissão: "), shipped, F.lit("\nVencimento: "), due, F.lit("\nTOTAL R$ "), value)
    energy = F.concat(F.lit("COMPANHIA DE ENERGIA ELÉTRICA\nCONTA DE ENERGIA\nConsumo 120 kWh\nInstalação: "), part, F.lit("\nCNPJ "), cnpj, F.lit("\nData de Emissão: "), shipped, F.lit("\nVencimento "), due, F.lit("\nTOTAL A PAGAR R$ "), value)
    kind = F.when(F.col("l_linenumber") % 6 == 0, "energy").when(F.col("l_returnflag") == "A", "service").when(F.col("l_returnflag") == "R", "product").otherwise("rental")
    text = F.when(kind == "energy", energy).when(kind == "service", service).when(kind == "product", product).otherwise(rental)
    return line.withColumn("ordinal", F.row_number().over(place)).join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_orderkey").alias("batch_id"), "ordinal", kind.alias("kind"), text.alias("text"), "l_partkey", "l_suppkey", "s_name", cents.alias("cents"), F.col("l_shipdate").alias("shipped"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log line for each event."""
    e = load(spark, sf_dir, "events")
    level = F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "click", "WARNING").otherwise("INFO")
    return e.select(F.col("event_id"), F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" - module"), (F.col("user_id") % 5).cast("string"), F.lit(" - "), level, F.lit(" - Lote processado: email_20240101_"), (F.col("user_id") % 20).cast("string"), F.lit(" em "), F.col("event_id").cast("string"), F.lit(".5s")).alias("line"))


#: The same views for DuckDB; a query's SQL begins with WITH and those that it names.
FIXTURE = {
    "invoices": r"""invoices AS (
  SELECT l_orderkey AS batch_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ordinal,
    CASE l_returnflag WHEN 'A' THEN 'NFSE' WHEN 'R' THEN 'DANFE' ELSE 'OUTRO' END AS doc_type,
    CASE WHEN l_returnflag IN ('A', 'R') AND l_partkey % 7 <> 0 THEN (l_partkey % 50)::VARCHAR END AS numero_nota,
    CASE WHEN l_returnflag NOT IN ('A', 'R') AND l_partkey % 7 <> 0 THEN (l_partkey % 50)::VARCHAR END AS numero_documento,
    CASE WHEN l_suppkey % 5 = 0 THEN 'PED-' || l_suppkey END AS numero_pedido, s_name AS fornecedor_nome, lpad(l_suppkey::VARCHAR, 8, '0') || '000100' AS cnpj,
    CASE WHEN l_linenumber % 5 <> 0 THEN l_extendedprice ELSE 0.0 END AS valor, strftime(l_shipdate, '%Y-%m-%d') AS data_emissao,
    CASE WHEN l_linestatus <> 'F' THEN strftime(l_shipdate + INTERVAL 30 DAY, '%Y-%m-%d') END AS vencimento,
    CASE WHEN l_returnflag IN ('A', 'R') THEN 'NF ' ELSE 'recibo_' END || l_linenumber || '.pdf' AS arquivo_origem
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)""",
    "slips": r"""slips AS (
  SELECT o_orderkey AS batch_id, 1000 AS ordinal, 'BOLETO' AS doc_type, NULL::VARCHAR AS numero_nota, (o_orderkey % 50)::VARCHAR AS numero_documento, NULL::VARCHAR AS numero_pedido,
    'Beneficiário: Customer ' || o_custkey AS fornecedor_nome, lpad(o_custkey::VARCHAR, 8, '0') || '000200' AS cnpj,
    CASE WHEN o_orderkey % 3 = 0 AND f.first IS NOT NULL THEN f.first ELSE o_totalprice END AS valor, strftime(o_orderdate, '%Y-%m-%d') AS data_emissao,
    CASE WHEN o_orderkey % 4 <> 0 THEN strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') END AS vencimento, 'BOLETO ' || o_orderkey || '.pdf' AS arquivo_origem
  FROM orders LEFT JOIN (SELECT batch_id, arg_min(valor, ordinal) AS first FROM invoices WHERE valor > 0 GROUP BY batch_id) f ON f.batch_id = o_orderkey
  WHERE o_orderstatus <> 'O')""",
    "docs": "docs AS (SELECT * FROM invoices UNION ALL BY NAME SELECT * FROM slips)",
    "emails": r"""emails AS (
  SELECT event_id AS email_id, ts,
    CASE event_type WHEN 'purchase' THEN 'Fatura ' WHEN 'signup' THEN 'Comunicado ' WHEN 'error' THEN 'NF-e ' WHEN 'click' THEN 'Re: Re: ' WHEN 'view' THEN 'Boleto ' END || event_id AS subject,
    CASE user_id % 4 WHEN 0 THEN 'cobranca@fornecedor' || user_id || '.com.br' WHEN 1 THEN 'newsletter@loja.com' WHEN 2 THEN 'joao@cliente.com.br' ELSE 'noreply@github.com' END AS sender_address,
    CASE WHEN event_id % 2 = 0 THEN 'nota' || event_id || CASE WHEN event_id % 4 = 0 THEN '.pdf' ELSE '.png' END END AS attachment,
    event_id % 7 = 0 AS has_attachment, event_id % 3 = 0 AS has_links_nfe, event_id % 5 = 0 AS has_verification_code FROM events)""",
    "slip_texts": r"""slip_texts AS (
  SELECT o_orderkey AS doc_id, o_custkey, (o_orderdate + INTERVAL 30 YEAR)::DATE AS o_orderdate, round(o_totalprice * 100)::BIGINT AS cents,
    'Banco Bradesco S.A.' || chr(10) || 'Beneficiário: COMERCIAL ' || o_custkey || ' LTDA CNPJ ' ||
    regexp_replace(lpad(o_custkey::VARCHAR, 8, '0') || '000200', '^(\d{2})(\d{3})(\d{3})(\d{4})(\d{2})$', '\1.\2.\3/\4-\5') || chr(10) ||
    'Nosso Número: 09/' || lpad(o_orderkey::VARCHAR, 11, '0') || '-4' || chr(10) || 'Número do Documento: ' || o_orderkey || chr(10) ||
    'Data do Documento: ' || strftime(o_orderdate + INTERVAL 30 YEAR, '%d/%m/%Y') || chr(10) || 'VENCIMENTO: ' || strftime((o_orderdate + INTERVAL 30 YEAR)::DATE + 30, '%d/%m/%Y') || chr(10) ||
    'VALOR DO DOCUMENTO: R$ ' || replace(format('{:,}', round(o_totalprice * 100)::BIGINT // 100), ',', '.') || ',' || lpad((round(o_totalprice * 100)::BIGINT % 100)::VARCHAR, 2, '0') || chr(10) ||
    '23793.38128 60000.000003 00000.000405 1 8434' || lpad(round(o_totalprice * 100)::BIGINT::VARCHAR, 10, '0') AS text FROM orders)""",
    "invoice_rows": r"""invoice_rows AS (
  SELECT l_orderkey AS batch_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ordinal,
    CASE WHEN l_linenumber % 6 = 0 THEN 'energy' WHEN l_returnflag = 'A' THEN 'service' WHEN l_returnflag = 'R' THEN 'product' ELSE 'rental' END AS kind,
    l_partkey, l_suppkey, s_name, round(l_extendedprice * 100)::BIGINT AS cents, l_shipdate,
    regexp_replace(lpad(l_suppkey::VARCHAR, 8, '0') || '000100', '^(\d{2})(\d{3})(\d{3})(\d{4})(\d{2})$', '\1.\2.\3/\4-\5') AS cnpj
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)""",
}

_NEEDS = {"slips": ["invoices"], "docs": ["invoices", "slips"]}


def sql(query: str, *views: str) -> str:
    """query with the named views, and those they need, before it. A query that begins with WITH goes on with its own."""
    order: list[str] = []
    for v in views:
        for x in [*_NEEDS.get(v, []), v]:
            if x not in order:
                order.append(x)
    head = ",\n".join(FIXTURE[v] for v in order)
    query = query.strip()
    return f"WITH {head}{',' if query.startswith('WITH ') else ''}\n{query.removeprefix('WITH ')}" if head else query
