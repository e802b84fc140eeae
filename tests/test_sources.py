"""Mailbox, PDF texts, sinks, the run over both phases, and measures."""

import json

import pytest
from pyspark.sql import functions as F

from tributary.operators import audit, classify, companies, extract, metrics
from tributary.sources import mailbox, pdf, readers, sinks
from tributary.streaming import events

MAIL = "From: A <a@b.com>\r\nSubject: {}\r\nMessage-ID: <{}@x>\r\nDate: Mon, 24 Mar 2025 10:00:00 -0300\r\n\r\nbody"


def test_mailbox_folder(spark, tmp_path):
    for i in range(7):
        (tmp_path / f"{i}.eml").write_text(MAIL.format("Nota 1" if i % 2 else "Boleto", i))
    mailbox.register(spark)
    df = spark.read.format("mailbox").option("partitionSize", "2").load(str(tmp_path))
    assert df.count() == 7 and df.filter(F.col("subject").contains("Nota")).count() == 3
    assert {r.email_id for r in df.filter("subject = 'Boleto'").collect()} == {f"{i}@x" for i in (0, 2, 4, 6)}


class FakeServer:
    asked: list = []

    def __init__(self, host):
        self.host = host

    def login(self, user, password):
        assert (user, password) == ("u", "p")

    def select(self, folder, readonly):
        assert folder == "INBOX" and readonly

    def uid(self, command, *args):
        if command == "SEARCH":
            FakeServer.asked.append(args[1:])
            return "OK", [b"1 2 3"]
        raw = b"\xff broken" if args[0] == "2" else MAIL.format("Nota", args[0]).encode()
        return "OK", [(b"x", raw), b")"]

    def logout(self):
        pass


def test_mailbox_server_pushes_the_subject():
    reader = mailbox.Reader(mailbox.Imap({"host": "h", "user": "u", "password": "p"}, FakeServer), 2)
    left = list(reader.pushFilters([mailbox.StringContains(("subject",), 'No"ta'), mailbox.StringContains(("body",), "x")]))
    assert len(left) == 2 and reader.subject == 'No"ta'
    parts = reader.partitions()
    assert [p.names for p in parts] == [["1", "2"], ["3"]] and FakeServer.asked[-1] == ("SUBJECT", '"No\\"ta"')
    rows = [dict(zip(mailbox.FIELDS, r, strict=True)) for p in parts for r in reader.read(p)]
    assert [r["path"] for r in rows] == ["1", "2", "3"] and rows[0]["subject"] == "Nota"
    assert mailbox.Reader(mailbox.Imap({"host": "h", "user": "u", "password": "p"}, FakeServer), 2).partitions() and FakeServer.asked[-1] == ("ALL",)


class Page:
    def __init__(self, text, layout="", tables=()):
        self.text, self.layout, self.tables = text, layout, tables

    def extract_text(self, layout=False):
        return self.layout if layout else self.text

    def extract_tables(self):
        return self.tables


def test_pdf_texts(spark):
    assert pdf.native(b"", pages=lambda raw, word: [Page("x" * 40)]) == ""
    assert pdf.native(b"", pages=lambda raw, word: [Page("x" * 60, "y" * 150)]) == "x" * 60
    assert pdf.native(b"", pages=lambda raw, word: [Page("x" * 60, "y" * 161)]) == "y" * 161
    assert pdf.native(b"", pages=lambda raw, word: [Page("x" * 300, "y" * 900)]) == "x" * 300

    def locked(raw, word):
        if word != "1234":
            raise ValueError("password")
        return [Page("z" * 300)]

    assert pdf.native(b"", ["12", "1234"], locked) == "z" * 300 and pdf.native(b"", ["12"], locked) == ""
    table = Page("x" * 60, tables=[[["Nota", "Valor"], ["7", "1,00"], [None, "2,00"]]])
    assert pdf.tables(b"", lambda raw: [table]).splitlines()[1:] == ["Nota: 7", "Valor: 1,00", "Valor: 2,00"]
    files = spark.createDataFrame([("p", bytearray(b"raw"))], "path string, content binary")
    chain = pdf.chain(pages=lambda raw, word=None: [], image=lambda raw: raw, recognize=lambda image: "read " * 80)
    assert readers.texts(files, chain).first().strategy == "ocr"
    assert pdf.completed("short", b"", lambda t: len(t) < 300, image=lambda raw: raw, recognize=lambda i: "more ") == "short\nmore"
    assert pdf.completed("short", b"", lambda t: False) == "short"


def test_sinks(spark, tmp_path):
    docs = spark.createDataFrame([("b1", 1, "NFSE", 1.5), ("b1", 2, "BOLETO", 2.0)], "batch_id string, ordinal int, doc_type string, valor double")
    sinks.write_run(docs, docs.select("batch_id", F.lit("p").alias("pair_id")), str(tmp_path))
    assert spark.read.option("header", True).option("sep", ";").csv(f"{tmp_path}/consolidado").count() == 2
    sinks.export(docs, "jsonl", f"{tmp_path}/partial")
    sinks.export(docs, "jsonl", f"{tmp_path}/partial")
    assert spark.read.json(f"{tmp_path}/partial").count() == 4
    with pytest.raises(ValueError):
        sinks.export(docs.limit(0), "csv", f"{tmp_path}/none")
    with pytest.raises(ValueError):
        sinks.export(docs, "fax", f"{tmp_path}/none")
    nested = spark.createDataFrame([("a", "OK", [(1.0,), (2.0,)]), ("b", "ERROR", [])], "batch_id string, status string, documents array<struct<valor double>>")
    assert sorted((r.batch_id, r.ordinal, r.valor) for r in sinks.flattened(nested).collect() if r.ordinal) == [("a", 1, 1.0), ("a", 2, 2.0)] and sinks.flattened(nested).count() == 3


def test_rows_are_appended_in_chunks_and_tried_again(spark, tmp_path):
    root = str(tmp_path)

    def append(rows):
        import os

        mark = f"{root}/{rows[0][0]}"
        if not os.path.exists(mark):
            open(mark, "w").close()
            raise OSError("busy")
        with open(f"{mark}.done", "w") as f:
            f.write(str(len(rows)))

    got = sinks.append_rows(spark.range(250).coalesce(1), append, wait=(0.0, 0.0)).collect()
    assert [(r.linhas, r.tentativas) for r in got] == [(100, 2), (100, 2), (50, 2)]
    with pytest.raises(Exception, match="never"):
        sinks.append_rows(spark.range(1), lambda rows: (_ for _ in ()).throw(OSError("never")), tries=2, wait=(0.0, 0.0)).collect()


def test_batch_folders_are_written_and_deleted(spark, tmp_path):
    rows = [("b:1", "s", "n", "a@b", "t", [("x.pdf", bytearray(b"1")), ("x.pdf", bytearray(b"2")), ("logo.png", bytearray(b"3"))]), ("b2", None, None, None, None, None)]
    mails = spark.createDataFrame(rows, "batch_id string, subject string, sender_name string, sender_address string, body string, attachments array<struct<filename string, content binary>>")
    for _ in range(2):
        got = {r.batch_id: (r.arquivos, r.ignorados) for r in sinks.write_batches(mails, f"file://{tmp_path}/in").collect()}
    assert got == {"b:1": (["01_x.pdf", "02_x.pdf"], 1), "b2": ([], 0)}
    folder = tmp_path / "in" / "b_1"
    assert (folder / "02_x.pdf").read_bytes() == b"2" and (folder / "ignored" / "01_logo.png").exists() and json.loads((folder / "metadata.json").read_text())["email_subject"] == "s"
    assert [(r.batch_id, r.ordinal) for r in readers.batch_files(spark, f"{tmp_path}/in").orderBy("ordinal").collect()] == [("b_1", 1), ("b_1", 2)]
    assert [r.apagado for r in sinks.delete_batches(mails.limit(1), f"file://{tmp_path}/in").collect()] == [True] and not folder.exists()
    assert [r.apagado for r in sinks.delete_batches(mails.limit(1), f"file://{tmp_path}/in").collect()] == [False]


def test_run_of_both_phases(spark, tmp_path):
    rows = [(i, "Nota Fiscal", "x@y.com", "https://nfe.cidade.br/1" if i % 2 else "oi", ["a.pdf"] if i % 3 == 0 else []) for i in range(12)]
    mails = spark.createDataFrame(rows, "email_id long, subject string, sender_address string, body string, attachments array<string>").withColumn("has_attachment", F.lit(False))
    mails.write.parquet(f"{tmp_path}/mail")
    firms = spark.createDataFrame([("1" * 14, "ACME LTDA", 1)], "cnpj string, razao_social string, ordinal int")
    read = lambda: spark.readStream.schema(mails.schema).parquet(f"{tmp_path}/mail")
    told = []
    first = events.run(read(), firms, f"{tmp_path}/out", f"{tmp_path}/ck", links_first=True, tell=lambda name, p: told.append(name))
    assert list(first) == ["notices", "attachments"] and set(first.values()) == {12} and set(told) == {"notices", "attachments"}
    again = events.run(read(), firms, f"{tmp_path}/out", f"{tmp_path}/ck")
    assert set(again.values()) == {0}
    assert {(r.fase, r.emails) for r in events.status(spark, f"{tmp_path}/out").collect()} == {("attachments", 4), ("notices", 4)}
    assert events.status(spark, f"{tmp_path}/none").count() == 0
    events.clear(spark, f"{tmp_path}/ck")
    assert events.run(read(), firms, f"{tmp_path}/out", f"{tmp_path}/ck", notices=False) == {"attachments": 12}


def test_measures(spark):
    with metrics.measured("m") as m:
        assert m.rows(spark.range(7)).collect() and m.rows(spark.range(3)).collect()
    assert m.counts == [7, 3] and m.seconds > 0 and m.name == "m"


def test_all_banks_have_names(spark):
    banks = spark.range(1000).selectExpr("lpad(cast(id as string), 3, '0') as codigo", "concat('B', id) as nome")
    df = spark.range(1000).selectExpr("lpad(cast(id as string), 3, '0') as codigo_banco")
    assert companies.bank_names(df, banks).filter("banco like 'BANCO%'").count() == 0
    with pytest.raises(ValueError):
        companies.bank_names(df, banks.union(banks.limit(500)))


def test_validation_export(spark, tmp_path):
    rows = spark.createDataFrame([("NFSE", True, 1.0), ("NFSE", False, 2.0), ("BOLETO", True, 3.0)], "doc_type string, sucesso boolean, valor double")
    audit.write_validation(rows, f"{tmp_path}/v")
    assert spark.read.option("header", True).option("sep", ";").csv(f"{tmp_path}/v/tipo=NFSE/ok=false").first().valor == "2,00"
    assert classify.due_date_problems is not None


@pytest.mark.parametrize(("text", "name"), [
    ("EDP SAO PAULO\nCONSUMO 12", "energy"), ("ENEL\nFATURA ELETRÔNICA", "energy"), ("REPROMAO e Bradesco", "line_based_slip"), ("Beneficiário X", "slip"), ("DOCUMENTO AUXILIAR da NFS Beneficiário", "service"),
    ("SICOOB\nvencimento 1", "service"), ("LIGHT conta de luz", "energy"), ("MUGO TELECOM", "goods_invoice"), ("", None), (None, None),
])
def test_routes(spark, text, name):
    assert extract.routed(spark.createDataFrame([(text,)], "text string")).first().extractor == name


@pytest.mark.parametrize(("text", "due"), [
    ("Data do processamento 01/02/2024 Vencimento 05/02/2024\nVENCIMENTO\n10/03/2024", "2024-03-10"), ("Emissão Vencimento\n01/01/2024 15/01/2024", "2024-01-15"), ("Vencimento: 10/03/1999", None),
    ("Data de emissão 09/09/2024\npagar ate 01/05/2024", "2024-05-01"), ("emissão 09/09/2024", "2024-09-09"), ("sem data", None),
])
def test_slip_due_dates(spark, text, due):
    df = extract.prepared(spark.createDataFrame([(text,)], "text string"), "text")
    assert df.select(extract.slip_due("text").alias("d")).first().d == due
