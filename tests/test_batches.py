"""Pairing, inheritance, readers, sinks and streams."""

import json

from pyspark.sql import functions as F

from tributary.operators import batches, logs, pairing, reports
from tributary.sources import readers
from tributary.streaming import events

COLUMNS = "batch_id long, ordinal int, doc_type string, numero_nota string, numero_documento string, numero_pedido string, fornecedor_nome string, cnpj string, valor double, data_emissao string, vencimento string, arquivo_origem string"


def docs(spark, *rows):
    return spark.createDataFrame([(1, i, t, n if t != "BOLETO" and t != "OUTRO" else None, n if t in ("BOLETO", "OUTRO") else None, None, f, None, v, None, d, a) for i, (t, n, f, v, d, a) in enumerate(rows)], COLUMNS)


def pairs(spark, *rows):
    got = pairing.paired(docs(spark, *rows)).collect()
    return sorted((r.pair_id, r.valor_nf, r.valor_boleto, r.status) for r in got)


def invoice(number, value, name=None, kind="NFSE"):
    return (kind, number, "A", value, None, name or f"nota{number}.pdf")


def slip(number, value, name=None):
    return ("BOLETO", number, "A", value, "2025-01-10", name or "x.pdf")


def test_pairs(spark):
    assert pairs(spark, invoice("119", 10.0), slip("119", 10.0)) == [("1", 10.0, 10.0, "CONCILIADO")]
    assert pairs(spark, invoice("119", 10.0), slip("119", 12.0)) == [("1", 10.0, 12.0, "DIVERGENTE")]
    assert pairs(spark, invoice("119", 10.0)) == [("1", 10.0, 0.0, "CONFERIR")]
    assert pairs(spark, slip("7", 3.0)) == [("1_bol_7", 0.0, 3.0, "CONFERIR")]
    assert pairs(spark, invoice("119", 0.0), slip("7", 3.0)) == [("1", 0.0, 3.0, "PAREADO_FORCADO")]
    two = [invoice("2025/119", 10.0), invoice("2025/122", 20.0), slip(None, 20.0, "BOLETO NF 2025.122.pdf"), slip(None, 10.0, "BOLETO NF 2025.119.pdf")]
    assert pairs(spark, *two) == [("1_119", 10.0, 10.0, "CONCILIADO"), ("1_122", 20.0, 20.0, "CONCILIADO")]
    assert pairs(spark, invoice("1", 10.0), invoice("2", 20.0), slip("50", 20.005), slip("60", 10.0)) == [("1_1", 10.0, 10.0, "CONCILIADO"), ("1_2", 20.0, 20.01, "CONCILIADO")]
    assert pairs(spark, invoice("5", 10.0), slip("5", 4.0), slip("05", 6.0)) == [("1", 10.0, 10.0, "CONCILIADO")]
    assert pairs(spark, ("OUTRO", None, "Atestamos que", 0.0, None, "a.pdf")) == [("1", 0.0, 0.0, "CONFERIR")]
    assert pairs(spark, invoice("9", 30.0), invoice("4", 0.0), slip("9", 30.0), slip("77", 8.0)) == [("1", 0.0, 8.0, "PAREADO_FORCADO"), ("1", 30.0, 30.0, "CONCILIADO")]


def test_inheritance(spark):
    d = docs(spark, invoice("7", 10.0, kind="DANFE"), invoice(None, 5.0), slip(None, 10.0))
    got = {r.ordinal: r for r in batches.inherited(d).collect()}
    assert got[2].referencia_nfse == "7" and got[0].vencimento == got[1].vencimento == "2025-01-10"
    r = batches.reconciled(docs(spark, slip("1", 5.0))).first()
    assert (r.status, r.fonte, r.divergencia) == ("CONCILIADO", "BOLETO", None)


def test_merge(spark):
    xml, pdf = docs(spark, ("NFSE", "7", "Alfa", 10.0, None, "a.xml")), docs(spark, ("NFSE", "7", "Alfa", 10.0, "2025-02-01", "a.pdf"), ("NFSE", "8", "Beta", 1.0, None, "b.pdf"))
    got = sorted((r.arquivo_origem, r.vencimento) for r in batches.merged(xml, pdf).collect())
    assert got == [("a.xml", "2025-02-01"), ("b.pdf", None)]


def test_sinks_and_readers(spark, tmp_path):
    d = docs(spark, invoice("7", 1234.5), slip("7", 2.0))
    reports.write_csv(d.coalesce(1), f"{tmp_path}/csv")
    back = readers.report_csv(spark, f"{tmp_path}/csv")
    assert back.columns == d.columns and sorted(r.v for r in back.select(readers.br_number("valor").alias("v")).collect()) == [2.0, 1234.5]
    reports.write_by_type(d, f"{tmp_path}/types")
    assert spark.read.option("header", True).option("sep", ";").csv(f"{tmp_path}/types/tipo=BOLETO").count() == 1
    for n, text in (("b1", json.dumps({"batch_id": "b1", "email_subject": "s", "attachments": ["a"], "extra": {"k": "v"}})), ("b2", "{broken")):
        (tmp_path / "mail" / n).mkdir(parents=True)
        (tmp_path / "mail" / n / "metadata.json").write_text(text)
        (tmp_path / "mail" / n / "2.pdf").write_bytes(b"x")
        (tmp_path / "mail" / n / "9.xml").write_bytes(b"x")
        (tmp_path / "mail" / n / ".hidden.pdf").write_bytes(b"x")
    assert sorted((r.batch_id, r.email_subject) for r in readers.metadata(spark, f"{tmp_path}/mail").collect()) == [("b1", "s"), ("b2", None)]
    assert [(r.name, r.ordinal) for r in readers.batch_files(spark, f"{tmp_path}/mail").filter("batch_id = 'b1'").orderBy("ordinal").collect()] == [("9.xml", 1), ("2.pdf", 2)]


RAW = b"From: =?utf-8?q?Jo=C3=A3o?= <a@b.com>\r\nSubject: =?iso-8859-1?q?Cobran=E7a?=\r\nMessage-ID: <1@x>\r\nDate: Mon, 24 Mar 2025 10:00:00 -0300\r\nMIME-Version: 1.0\r\nContent-Type: multipart/mixed; boundary=B\r\n\r\n--B\r\nContent-Type: text/plain; charset=utf-8\r\n\r\nol\xc3\xa1\r\n--B\r\nContent-Type: text/html\r\n\r\n<b>x</b>\r\n--B\r\nContent-Type: application/pdf\r\nContent-Disposition: attachment; filename=n.pdf\r\n\r\nPDF\r\n--B--\r\n"


def test_messages(spark, tmp_path):
    (tmp_path / "a.eml").write_bytes(RAW)
    (tmp_path / "b.eml").write_bytes(b"Subject: none\r\n\r\nbody")
    m = readers.by_email(readers.messages(spark, str(tmp_path)))
    a = m.filter("email_id = '1@x'").first()
    assert (a.subject, a.sender_name, a.sender_address, a.attachments[0].filename) == ("Cobrança", "João", "a@b.com", "n.pdf") and "HTML CONTENT" in a.body
    assert readers.without_attachments(m).count() == 1
    files = spark.createDataFrame([("p", bytearray(b"long text"))], "path string, content binary")
    got = readers.texts(files, [("fails", lambda b: 1 / 0), ("short", lambda b: "x"), ("plain", lambda b: b.decode())], 5).first()
    assert (got.text, got.strategy) == ("long text", "plain")


def test_logs(spark):
    rows = [("f", 1, "2024-01-01 10:00:00 - m - ERROR - first"), ("f", 2, "  more"), ("f", 3, "2024-01-01 10:00:01 - m - INFO - Lote email_20240101_a em 25.5s"), ("f", 0, "no head")]
    got = logs.joined_entries(spark.createDataFrame(rows, "file string, ordinal int, line string")).orderBy("entry").collect()
    assert [r.message for r in got] == ["first\n  more", "Lote email_20240101_a em 25.5s"]
    df = spark.createDataFrame(rows, "file string, ordinal int, line string")
    assert logs.batches(logs.entries(df)).first().lenta and logs.entries(df).select(logs.masked().alias("m")).collect()[1].m == "Lote <lote> em <tempo>"


def test_streams(spark, tmp_path):
    rows = spark.range(100).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 60).alias("ts"), (F.col("id") % 3).alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.5).alias("value"))
    rows.write.parquet(f"{tmp_path}/events.parquet")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/events.parquet")
    want = {(r.inicio, r.n) for r in events.windowed(rows, late=None).collect()}
    got = {(r.inicio, r.n) for r in events.run_once(events.windowed(stream), "w", "complete").collect()}
    assert got == want and sum(n for _, n in got) == 100
    mails = rows.select(F.col("event_id").alias("email_id"), F.lit("Fatura").alias("subject"), F.lit("a@b").alias("sender_address"), F.array(F.lit("a.pdf")).alias("attachments"), F.lit(True).alias("has_attachment"), F.lit(False).alias("has_links_nfe"), F.lit(False).alias("has_verification_code"))
    mails.write.parquet(f"{tmp_path}/mail")
    read = lambda: spark.readStream.schema(mails.schema).parquet(f"{tmp_path}/mail")
    for _ in range(2):  # the second run finds nothing new
        events.ingest(read(), f"{tmp_path}/out", f"{tmp_path}/ck")
    assert spark.read.json(f"{tmp_path}/out").count() == 100
    mails.limit(5).withColumn("email_id", F.col("email_id") + 1000).write.mode("append").parquet(f"{tmp_path}/mail")
    events.ingest(read(), f"{tmp_path}/out", f"{tmp_path}/ck")
    assert spark.read.json(f"{tmp_path}/out").count() == 105
