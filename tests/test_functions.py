"""Scalar functions, calendar and rules on single values."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tributary.functions import calendar as Cal
from tributary.functions import text as T
from tributary.operators import classify, emails, extract, xmls


def one(spark, column, x=None):
    return spark.createDataFrame([(x,)], "x string").select(column.alias("y")).first()["y"]


@pytest.mark.parametrize(("x", "y"), [("1.234,56", 1234.56), ("352,08", 352.08), ("", 0.0), (None, 0.0), ("abc", 0.0), ("1.234.567,89", 1234567.89)])
def test_money(spark, x, y):
    assert one(spark, T.money("x"), x) == y


def test_money_in_text(spark):
    assert one(spark, T.money_all("x"), "Total: R$ 1.234,56 + R$ 100,00 e 0,00 ou 12,345") == [1234.56, 100.0]
    assert one(spark, T.money_max("x"), "0,00 0,00 4.800,00") == 4800.0 and one(spark, T.money_max("x"), None) == 0.0


@pytest.mark.parametrize(("x", "y"), [("24/03/2025", "2025-03-24"), ("24-03-2025", "2025-03-24"), ("24/03/25", "2025-03-24"), ("24/03/70", "1970-03-24"), ("31/02/2025", None), ("x", None), (None, None)])
def test_date_br(spark, x, y):
    assert one(spark, T.date_br("x"), x) == y


@pytest.mark.parametrize(("x", "y"), [("Mon, 24 Mar 2025 23:59:01 -0300", "2025-03-24"), ("4 mar 2025 08:00:00 +0000", "2025-03-04"), ("2025-03-24T10:00:00Z", "2025-03-24"), ("24/03/2025 10:00", "2025-03-24"), ("2025-03-24", "2025-03-24"), ("ontem", None), (None, None)])
def test_email_date(spark, x, y):
    assert one(spark, T.email_date("x"), x) == y


@pytest.mark.parametrize(("x", "y"), [("202500000000119", "119"), ("2025/119", "119"), ("2025.119", "119"), ("NF-119", "119"), ("000", "0"), (None, ""), ("S1-A", "S1-A"), ("NFSE 2025-007", "7"), ("123456789", "123456789")])
def test_normalized_number(spark, x, y):
    assert one(spark, T.normalized_number("x"), x) == y


@pytest.mark.parametrize(("a", "b", "same"), [("119", "0119", True), ("119", "9", True), ("119", "8", False), ("", "9", False), (None, "9", False)])
def test_same_number(spark, a, b, same):
    assert one(spark, T.same_number("x", F.lit(b)), a) is same


def test_names(spark):
    assert one(spark, T.entity_name("x"), "EMPRESA XYZ LTDA   12.345.678/0001-90  ") == "EMPRESA XYZ LTDA"
    assert one(spark, T.supplier_name("x"), "CNPJ: Alfa\n Beta") == "Alfa Beta" and one(spark, T.supplier_name("x"), None) == ""
    assert one(spark, T.strip_accents("x"), "Código Eletrônico") == "Codigo Eletronico"
    assert one(spark, T.file_name("x", 12), 'a<b>:"c".pdf_long.pdf') == "a_b___c_.pdf" and len(one(spark, T.file_name("x"), "y" * 300 + ".xml")) == 200
    assert one(spark, T.domains_all("x"), "a@B.com.br https://www.b.com.br/x http://c.io a@b.com.br") == ["b.com.br", "c.io"]
    assert one(spark, T.number_in_file_name("x"), "BOLETO NF 2025.119.pdf") == "2025.119" and one(spark, T.number_in_file_name("x"), "nfse_202500000000119.xml") == "202500000000119"


def test_calendar(spark):
    assert [Cal.is_working(date(*d)) for d in ((2025, 1, 25), (2025, 11, 20), (2025, 12, 22), (2025, 12, 20), (2025, 3, 4), (2025, 6, 19), (2025, 4, 18))] == [False, False, True, False, False, False, False]
    assert Cal.easter(2025) == date(2025, 4, 20) and Cal.easter(2024) == date(2024, 3, 31)
    df = spark.createDataFrame([(date(2025, 12, 19), date(2025, 12, 26)), (date(2025, 12, 26), date(2025, 12, 19)), (None, date(2025, 1, 1)), (date(2025, 12, 19), date(2025, 12, 19))], "a date, b date")
    assert [r.dias_uteis for r in Cal.with_working_days(df, "a", "b").collect()] == [4, 0, None, 0]


def test_situation(spark):
    rows = [("1", 10.0, "2025-12-10"), ("1", 10.0, "2025-12-24"), ("1", 10.0, "2026-02-20"), (None, 0.0, "2025-12-10"), ("1", 10.0, None), ("1", 10.0, "abc")]
    out = classify.situation(spark.createDataFrame(rows, "numero_nota string, valor double, vencimento string"), "2025-12-19").collect()
    assert [r.situacao for r in out] == ["VENCIDO", "VENCIMENTO_PROXIMO", "OK", "DIVERGENTE", "CONFERIR", "OK"]
    assert out[3].avisos == "[DIVERGENTE] Campos faltando: NF, VALOR | [VENCIDO] Vencimento em 10/12/2025"


CASES = [
    ("Boleto", "x@y.com", ["a.pdf"], False, False, False, "PROCESS"), ("Feliz Natal", "x@y.com", ["a.PDF"], False, False, False, "PROCESS"), ("Nota fiscal", "newsletter@y.com", None, False, True, False, "SKIP_SENDER_BLACKLIST"),
    ("PRÉ COBRANÇA", "x@y.com", None, False, True, False, "SKIP_BLACKLIST"), ("Re: RES: nota", "x@y.com", [], True, True, False, "SKIP_BLACKLIST"), ("Fatura", "x@y.com", ["a.png"], True, False, False, "SKIP_NO_CONTENT"),
    ("Fatura de luz", "x@y.com", None, False, False, True, "PROCESS"), ("Olá", "nfe@y.com", None, False, True, False, "PROCESS"), ("Olá", "x@y.com", None, False, True, False, "SKIP_NO_SUBJECT_MATCH"), (None, None, None, None, None, None, "SKIP_NO_CONTENT"),
]


def test_email_decisions(spark):
    df = spark.createDataFrame([(i, *c[:6]) for i, c in enumerate(CASES)], "email_id int, subject string, sender_address string, attachments array<string>, has_attachment boolean, has_links_nfe boolean, has_verification_code boolean")
    got = {r.email_id: r.decision for r in emails.decided(df).collect()}
    assert [got[i] for i in range(len(CASES))] == [c[-1] for c in CASES]
    assert emails.decided(df, blacklist=("olá",)).filter("email_id = 8").first().decision == "SKIP_BLACKLIST"


TEXTS = {
    "slip": "Banco Itaú 341-7\n34191.79001 01043.510047 91020.150008 5 84410000026000\nBeneficiário: ALFA SERVICOS LTDA CNPJ 11.222.333/0001-44\nVencimento 20/02/2025\nNosso Número 109/00012345-6\nValor do Documento R$ 260,00",
    "service": "PREFEITURA MUNICIPAL DE TESTE\nNota Fiscal de Serviço Eletrônica - NFS-e\nNúmero da Nota: 00000321\nCNPJ 11.222.333/0001-44\nValor Total R$ 1.500,00\nISS R$ 75,00",
    "product": "RECEBEMOS DE BETA COMERCIO LTDA OS PRODUTOS\nDANFE\nNº 000.123 SÉRIE 2\nVALOR TOTAL DA NOTA 99,90",
    "energy": "CEMIG DISTRIBUICAO\nCONSUMO 100 KWH\nTOTAL A PAGAR R$ 369, 4 0\nVENCIMENTO 10/03/2025",
    "other": "FATURA DE LOCACAO\nTOTAL A PAGAR R$ 700,00",
    "admin": "ORDEM DE SERVIÇO 12\nsem cobrança",
}


def test_router_and_fields(spark):
    df = spark.createDataFrame([*TEXTS.items(), ("none", "")], "name string, text string")
    got = {r.name: r for r in extract.extracted_all(df).collect()}
    assert {k: r.extractor for k, r in got.items()} == {k: k for k in TEXTS} | {"none": None}
    s = got["slip"]
    assert (s.valor, s.vencimento, s.cnpj, s.fornecedor_nome, s.nosso_numero, s.banco) == (260.0, "2025-02-20", "11.222.333/0001-44", "ALFA SERVICOS LTDA", "109/00012345-6", "ITAU")
    assert (got["service"].numero_nota, got["service"].valor, got["service"].valor_iss, got["service"].valor_ir) == ("00000321", 1500.0, 75.0, None)
    assert (got["product"].numero_nota, got["product"].serie_nf, got["product"].valor, got["product"].fornecedor_nome) == ("000123", "2", 99.9, "BETA COMERCIO LTDA")
    assert (got["energy"].valor, got["energy"].vencimento, got["other"].valor, got["other"].subtipo, got["admin"].subtipo) == (369.4, "2025-03-10", 700.0, "LOCACAO", "ORDEM_SERVICO")


def test_custom_extractor(spark):
    mine = extract.Extractor("mine", "OUTRO", lambda x: F.col(x).contains("XPTO"), {"valor": lambda x: T.money_max(x)})
    extract.register(mine, before="energy")
    try:
        df = spark.createDataFrame([("XPTO 5,00",)], "text string")
        assert [(r.extractor, r.valor) for r in extract.extracted_all(df).collect()] == [("mine", 5.0)]
    finally:
        extract.REGISTRY.remove(mine)


def test_xml_errors(spark):
    df = spark.createDataFrame([("<nfeProc><nNF>1</nNF>",), ("not xml",), (None,), ('<a:nfeProc xmlns:a="http://www.portalfiscal.inf.br/nfe"><a:nNF>7</a:nNF><a:vNF>1.50</a:vNF></a:nfeProc>',)], "xml string")
    assert [(r.numero_nota, r.valor, r._error) for r in xmls.parsed(df).collect()] == [("1", None, "malformed document"), (None, None, "unknown dialect"), (None, None, "unknown dialect"), ("7", 1.5, None)]
