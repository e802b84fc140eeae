"""Extractors for the layouts of single suppliers, in front of the generic ones.

A layout says what it differs in: the words that show it, constants, and fields. Scans by lines count no blank lines. Importing the
registry's module registers them all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions import text as T
from tributary.operators import extract as X
from tributary.operators.extract import AMOUNT, DAY, SLIP_LINE, Extractor, all_digits, any_in, compact, compacted, count_in, first_of, has, lines, near, register, slip_line_cents, upper

GENERIC = {e.name: e for e in X.REGISTRY}

# A formatted registration number, one with any separators, and a day with one or two digits.
CNPJ_GROUP = r"(\d{2}\.\d{3}\.\d{3}/\d{4}-\d{2})"
DAY_LOOSE = r"(\d{1,2}/\d{1,2}/\d{4})"


def constant(value: str) -> Callable[[str], Column]:
    return lambda x: F.lit(value)


def day(pattern: str) -> Callable[[Column], Column]:
    """A pick: the day in a line."""
    return lambda s: T.date_br(T.group(s, pattern))


def loose_day(s: Column) -> Column:
    """A pick: d/M/yyyy or yyyy-MM-dd in a line."""
    return F.coalesce(T.group(s, r"(\d{4}-\d{2}-\d{2})"), T.date_loose(T.group(s, DAY_LOOSE)))


def dates(x: Column | str, patterns: list[str]) -> Column:
    """The first pattern's day that is valid."""
    return F.coalesce(*[T.date_br(T.group(x, p)) for p in patterns])


def plain(f: Callable[[Column], Column]) -> Callable[[str], Column]:
    """A field of the text in the form that extraction wants, prepared once."""
    return lambda x: T.let(T.ready(x), f)


def named(x: str, label: Callable[[Column], Column], names: list[str]) -> Column:
    """The first of the names on a line; a line with the label also asks the two after it."""
    rows = lines(x)
    pick = lambda s: T.let(F.upper(s), lambda u: F.coalesce(*[F.when(u.contains(n.upper()), F.lit(n)) for n in names]))
    return T.entity_name(T.blank_to_null(F.get(F.array_compact(F.transform(rows, lambda s, i: F.when(label(s), first_of(F.slice(rows, i + 1, 3), pick)).otherwise(pick(s)))), F.lit(0))))


def size_bonus(v: Column) -> Column:
    """Large amounts are likelier totals."""
    return F.when(v > 1000, 3).when(v > 100, 2).when(v > 10, 1).otherwise(0)


# Amounts without thousands' points, too.
AMOUNT_LOOSE = r"(\d{1,3}(?:\.\d{3})*,\d{2}|\d+,\d{2})"

# ---- a slip read by lines

# The supplier, and the labels before its fields.
LINE_SUPPLIER, LINE_BANK = "REPROMAQ COM. E IND. LTDA", "Bradesco"
LINE_VALUE = [(r"\bValor\s{0,3}do\s{0,3}Documento\b", 5), (r"\bValor\s{0,3}(?:Cobrado|Nominal)\b", 3)]
LINE_ISSUED = [r"\bData\s{0,3}do\s{0,3}Documento\b", r"\bData\s{0,3}de\s{0,3}Emiss[aã]o\b", r"\bEmiss[aã]o\b", r"\bData\s{0,3}Processamento\b", r"\bProcessamento\b"]
LINE_NUMBER = r"\b(?:N[úu]mero|N[ºo\.])?\s*(?:do\s+)?Documento\b"


def line_number(x: str) -> Column:
    """Digits, a hyphen and one or two more, below the label, else on any line without a day; never on a line with a registration number."""
    bare = lambda s: ~s.rlike(CNPJ_GROUP)
    below = lambda s: T.let(T.group(s, r"\b(\d{4,}-\d{1,2})\b"), lambda g: F.when(bare(s) & ~F.startswith(g, F.lit("0001-")), g))
    return F.coalesce(near(x, has(LINE_NUMBER), below, 4, begin=1), first_of(lines(x), lambda s: F.when(bare(s) & ~s.rlike(DAY), T.group(s, r"\b(\d{4,6}-\d{1,2})\b"))))


def line_supplier(x: str) -> Column:
    """The supplier's name near the beneficiary's label, without numbers, else the known one."""
    pick = lambda s: F.when(F.upper(s).contains("REPROMAQ"), T.blank_to_null(T.entity_name(F.regexp_replace(F.regexp_replace(s, r"\s*[-–]?\s*(?:CNPJ\s*[:/]?\s*)?(?:CPF\s*[:/]?\s*)?\d{2}[\.\d/\-]+", ""), r"(?iu)\s*CNPJ/CPF\s*:?\s*$", ""))))
    return F.coalesce(near(x, has(r"\bBenefici[aá]rio\b"), pick, 3), F.lit(LINE_SUPPLIER))


def long_line(x: str) -> Column:
    """The slip's digits as they stand, else 47 digits put into groups."""
    groups = r"^(\d{5})(\d{5})(\d{5})(\d{6})(\d{5})(\d{6})(\d)(\d{14})$"
    run = T.group(F.regexp_replace(F.col(x), r"[\s.]", ""), r"(\d{47})")
    return F.coalesce(T.group(x, rf"({SLIP_LINE})"), F.regexp_replace(run, groups, "$1.$2 $3.$4 $5.$6 $7 $8"))


LINE_BASED = Extractor("line_based_slip", "BOLETO", lambda x: any_in(compact(x), ["REPROMAQ", "REPROMAO"]) & compact(x).contains("BRADESCO"), {
    "valor": lambda x: F.coalesce(*[near(x, has(p), lambda s: T.positive(T.group(s, AMOUNT)), n) for p, n in LINE_VALUE], slip_line_cents(x) / F.lit(100.0), F.lit(0.0)),
    "vencimento": lambda x: near(x, has(r"\bVencimento\b"), day(DAY), 3),
    "data_emissao": lambda x: F.coalesce(*[near(x, has(p), day(DAY), 4) for p in LINE_ISSUED], F.array_min(T.dates_all(x))),
    "numero_documento": line_number, "linha_digitavel": long_line, "banco": constant(LINE_BANK), "fornecedor_nome": line_supplier,
    "cnpj": lambda x: F.coalesce(near(x, has("BENEFICI|REPROMAQ"), lambda s: T.group(s, CNPJ_GROUP), 3), T.cnpj(x)),
    "nosso_numero": lambda x: near(x, has(r"\bNosso\s{0,3}N[úu]mero\b"), lambda s: T.group(s, r"(\d{2}/\d{6,12}-?\d?)(?!\d)"), 3),
})

# ---- a rental invoice of several pages

# The supplier, its number, and the labels of its fields.
RENTAL_SUPPLIER, RENTAL_CNPJ = "EMC TECNOLOGIA LTDA", "22.261.093/0001-40"
RENTAL_TOTAL = [rf"(?iu)\bTOTAL\s+R\$\s*{AMOUNT}", rf"(?iu)\bTOTAL\b[^\d\n]*{AMOUNT}"]
RENTAL_PERIOD = [r"(?iu)PERIODO\s+(\d{2}/\d{2}/\d{4})\s+AT[ÉE]\s+(\d{2}/\d{2}/\d{4})", r"(?iu)per[ií]odo\s+(?:entre\s+)?(\d{2}/\d{2}/\d{4})\s+(?:at[ée]|e)\s+(\d{2}/\d{2}/\d{4})"]


def is_rental(x: str) -> Column:
    t = upper(x)
    rented = t.contains("FATURA") & any_in(t, ["LOCAÇÃO", "LOCACAO"])
    equipment = any_in(t, ["NOTEBOOK", "COMPUTADOR", "MONITOR", "SERVIDOR"]) & any_in(t, ["DELL", "LENOVO"])
    return t.contains("EMC TECNOLOGIA") & (rented | equipment)


def rental_total(x: str) -> Column:
    """The labelled total, whatever it is; without one the largest amount in reais."""
    labelled = F.coalesce(*[T.let(T.group(x, p), lambda g: F.when(g.isNotNull(), T.money(g))) for p in RENTAL_TOTAL])
    marked = F.transform(F.regexp_extract_all(F.col(x), F.lit(rf"R\$\s*{AMOUNT}"), F.lit(1)), T.money)
    return F.coalesce(labelled, F.array_max(marked), F.lit(0.0))


RENTAL = Extractor("rental_invoice", "OUTRO", is_rental, {
    "subtipo": constant("FATURA_LOCACAO_EMC"), "valor": rental_total,
    "fornecedor_nome": lambda x: F.coalesce(T.blank_to_null(F.regexp_replace(T.group(x, r"(?iu)EMPRESA[:\s]*([^\n]*EMC\s+TECNOLOGIA[^\n]*LTDA)"), r"(?iu)\s*TELEFONE.*", "")), F.lit(RENTAL_SUPPLIER)),
    "cnpj": lambda x: F.coalesce(F.when(F.contains(F.col(x), F.lit(RENTAL_CNPJ)), F.lit(RENTAL_CNPJ)), T.group(x, rf"(?iu)(?:EMC|EMPRESA)[^\n]*CNPJ[:\s]*{CNPJ_GROUP}"), T.cnpj(x)),
    "vencimento": lambda x: T.date_br(T.first_group(x, [rf"(?iu)\bVENCIMENTO\s*[:\-]?\s*{DAY}", rf"(?iu)CONTRATO[:\s]*\d+[^\n]*VENCIMENTO[:\s]*{DAY}"])),
    "data_emissao": lambda x: T.date_br(T.group(x, rf"(?iu)\bEmiss[ãa]o\s*[:\-]?\s*{DAY}")),
    "numero_documento": lambda x: T.first_group(x, [r"(?iu)FATURA\s+(?:DE\s+)?LOCA[ÇC][ÃA]O\s+N[º°]?\s*[:\-]?\s*(\d+)", r"(?iu)N[º°]\s*[:\-]?\s*(\d{4,})"]),
    "contrato": lambda x: T.group(x, r"(?iu)\bCONTRATO\s*[:\-]?\s*(\d+)"),
    "periodo_referencia": lambda x: F.coalesce(*[F.concat(T.group(x, p, 1), F.lit(" até "), T.group(x, p, 2)) for p in RENTAL_PERIOD]),
})

# ---- an internet provider's slip

# The supplier, its number, and the words of its slips.
NET_SUPPLIER, NET_DIGITS = "NET CENTER UNAI PROVEDOR DE INTERNET LTDA", "05382200000170"
NET_WORDS = ["LINHA DIGITAVEL", "LINHA DIGITÁVEL", "BENEFICI", "VENCIMENTO", "VALOR DO DOCUMENTO", "CODIGO DE BARRAS", "CÓDIGO DE BARRAS"]


def is_net(x: str) -> Column:
    c = compact(x)
    vendor = c.contains("NETCENTER") | (c.contains("UNAI") & c.contains("NET") & c.contains("CENTER"))
    line = F.coalesce(F.col(x).rlike(r"\d{5}[\.\s]\d{5}\s+\d{5}[\.\s]\d{6}\s+\d{5}[\.\s]\d{6}"), F.lit(False))
    return all_digits(x).contains(NET_DIGITS) | (vendor & (any_in(c, compacted(NET_WORDS)) | line))


def net_value(x: str) -> Column:
    """A labelled value, else the slip's; raised to the largest amount of the text."""
    labelled = T.first_positive(x, [r"(?iu)\bValor\s+documento\b\s*[\n\r]*\s*R?\$?\s*([\d\.,]+)", r"(?isu)\bValor\s+total\s+a\s+pagar\b\s*:?\s*(?:R\$\s*)?([\d\.,]+)"])
    return F.greatest(F.coalesce(labelled, X.slip_value(x)), T.money_max(x))


_NET_HEADS = r"(?isu)\bEmiss[aã]o\b\s+Vencim\s*ento\b.*?(\d{2}/\d{2}/\d{4})\s+(\d{2}/\d{2}/\d{4})"

NET = Extractor("net_slip", "BOLETO", is_net, GENERIC["slip"].fields | {
    "fornecedor_nome": constant(NET_SUPPLIER), "valor": net_value,
    "cnpj": lambda x: F.coalesce(GENERIC["slip"].fields["cnpj"](x), T.let(T.group(F.regexp_replace(F.col(x), r"\D+", " "), r"\b(\d{14})\b"), lambda d: F.when(d.isNotNull(), T.cnpj_format(d)))),
    "vencimento": lambda x: F.coalesce(T.date_br(T.group(x, rf"(?isu)\bLocal\s+de\s+pagamento\s+Vencimento\b.*?{DAY}")), T.date_br(T.group(x, _NET_HEADS, 2)), X.slip_due(x)),
    "data_emissao": lambda x: F.coalesce(T.date_br(T.group(x, _NET_HEADS, 1)), X.slip_issued(x)),
})

# ---- service invoices of two cities

# Labels of the first city's invoices.
CITY_NUMBER = [r"(?iu)N[º°o]?\s*NFSe\s*[:\-]?\s*([0-9]{12,20})", r"(?iu)N[º°o]?\s*NFSe[:\s]*N[º°o]?\s*[:\s]*([0-9]{12,20})", r"(?iu)\bNFSE\b[^0-9]{0,10}([0-9]{12,20})", r"\b([0-9]{12,20})\b", r"(\d{4}[/\-]\d{1,6})"]
CITY_VALUE = [r"(?iu)Valor\s+dos\s+Serviços:\s*([\d\.,]+)", r"(?iu)Valor\s+líquido\s+da\s+nota:\s*([\d\.,]+)", r"(?iu)ValorLiquidoNfse[:\s]*R?\$?\s*([\d\.\,]{4,})", r"(?iu)Valor\s+Liquido[:\s]*R?\$?\s*([\d\.\,]{4,})", r"(?iu)ValorServicos[:\s]*R?\$?\s*([\d\.\,]{4,})", r"(?iu)Valor\s*[:\s]*R\$\s*([\d\.\,]{1,})", r"(?iu)Valor\s+Total[:\s]*R?\$?\s*([\d\.\,]{1,})", r"(?iu)\bR\$\s*([\d\.\,]{1,})\b"]
CITY_TAXES = {"valor_iss": ["ValorIss", r"Valor\s+ISS", "ISS", r"Total\s+Aprox"], "valor_ir": [r"Valor\s+IR", "ValorIR"], "valor_inss": [r"Valor\s+INSS", "ValorINSS"], "valor_csll": [r"Valor\s+CSLL", "ValorCSLL"], "valor_icms": [r"Valor\s+ICMS", "ICMS"], "base_icms": ["BaseCalculo", r"Base\s+de\s+C[aá]lculo"]}
CITY_NAME = [r"(?iu)Raz[ãa]o\s+Social[:\s\-]*([A-ZÀ-ÿ0-9\-\.\&\s\/]{4,120})", r"(?iu)(?:PrestadorServico|Prestador)[^\n\r]{0,80}\n?\s*([A-ZÀ-ÿ0-9\-\.\&\s\/]{4,120})", r"(?iu)([A-ZÀ-ÿ0-9\-\.\&\s\/]{5,120})\s+(?:CNPJ|CPF)\s*[:\-\s]*\d"]


def city_tax(labels: list[str]) -> Callable[[str], Column]:
    """The number after the first label that has one; 0 without."""
    return plain(lambda t: F.coalesce(T.let(T.first_group(t, [rf"(?iu){p}[:\s]*R?\$?\s*([\d\.\,]{{1,}})" for p in labels]), lambda g: F.when(g.isNotNull(), T.money(g))), F.lit(0.0)))


def is_first_city(x: str) -> Column:
    t = upper(x)
    return any_in(t, ["MONTES CLAROS", "NOTA.MONTESCLAROS"]) & ~F.col(f"{x}__line") & any_in(t, ["NFSE", "NOTA FISCAL DE SERVIÇO", "NFS-E", "CÓDIGO DE VERIFICAÇÃO"])


FIRST_CITY = Extractor("montes_claros", "NFSE", is_first_city, {
    "cnpj": plain(lambda t: F.coalesce(T.let(T.digits(T.group(t, r"(?isu)(?:CNPJ|CPF)\s*[:\-\s]*([0-9\.\-/\s]{14,20})")), lambda d: F.when(F.length(d) == 14, T.cnpj_format(d))), T.cnpj_flexible(t))),
    "fornecedor_nome": plain(lambda t: T.blank_to_null(F.regexp_replace(T.first_group(t, CITY_NAME), r"\s+", " "))),
    "numero_nota": plain(lambda t: T.first_group(t, CITY_NUMBER)), "valor": plain(lambda t: F.coalesce(T.first_positive(t, CITY_VALUE), F.lit(0.0))),
    "data_emissao": plain(lambda t: F.coalesce(T.group(t, r"(\d{4}-\d{2}-\d{2})T\d{2}:\d{2}:\d{2}"), T.group(t, r"(\d{4}-\d{2}-\d{2})"), T.date_br(T.group(t, DAY)))),
    "vencimento": plain(lambda t: T.date_br(T.group(t, rf"(?iu)Vencimento[:\s]+{DAY}"))),
} | {k: city_tax(v) for k, v in CITY_TAXES.items()})

# Labels of the second city's invoices.
CITY2_NUMBER = [r"\d{2}/\d{2}/\d{4}\s+\d{2}:\d{2}:\d{2}\s+\d{2}/\d{2}/\d{4}\s+\d{2}:\d{2}:\d{2}\s+(\d+)", r"(?iu)N[úu]mero[:\s]+(\d+)"]
CITY2_VALUE = [rf"(?iu)Valor\s+dos\s+servi[çc]os\s+R\$\s*{AMOUNT}", rf"(?iu)Valor\s+L[íi]quido\s+R\$\s*{AMOUNT}", rf"(?iu)Valor\s+Total\s+R\$\s*{AMOUNT}"]
CITY2_ISSUED = [rf"(?iu)Emitida\s+em[:\s]+[^\d]*{DAY}", rf"(?iu)Data\s+de\s+Emiss[ãa]o[:\s]+{DAY}", rf"(?iu)Emiss[ãa]o[:\s]+{DAY}"]
_SERVICE = GENERIC["service"].fields
_OWN = lambda x: T.first_group(x, CITY2_NUMBER).isNotNull() & T.first_positive(x, CITY2_VALUE).isNotNull()

#: Fields that the layout doesn't name are the generic ones; those of ICMS only where number or value is missing.
SECOND_CITY = Extractor("vila_velha", "NFSE", lambda x: upper(x).contains("VILA VELHA") & upper(x).contains("PREFEITURA"), _SERVICE | {
    "numero_nota": lambda x: F.coalesce(T.first_group(x, CITY2_NUMBER), _SERVICE["numero_nota"](x)),
    "valor": lambda x: F.coalesce(T.first_positive(x, CITY2_VALUE), _SERVICE["valor"](x)),
    "vencimento": lambda x: F.coalesce(T.date_br(T.group(x, rf"(?iu)Vencimento[:\s]+{DAY}")), T.date_br(T.first_group(x, CITY2_ISSUED))),
    "valor_icms": lambda x: F.when(~_OWN(x), _SERVICE["valor_icms"](x)), "base_icms": lambda x: F.when(~_OWN(x), _SERVICE["base_icms"](x)),
})

# ---- a telecom company's communication invoice

# The supplier, its number, what shows its invoices, and the labels of their fields.
TELECOM_SUPPLIER, TELECOM_CNPJ, TELECOM_DIGITS = "TELCABLES BRASIL LTDA", "20.609.743/0004-13", "20609743000413"
TELECOM_MARKS = [r"TELCABLES\s+BRASIL\s+LTDA", r"DOCUMENTO\s+AUXILIAR\s+DA\s+NOTA\s+FISCAL\s+FATURA\s+DE\s+SERVI[ÇC]OS\s+DE\s+COMUNICA[ÇC][AÃ]O\s+ELETR[ÔO]NICA", r"NOTA\s+FISCAL\s+FATURA\s*:\s*\d+", r"S[ÉE]RIE\s*:\s*1\s+VENCIMENTO"]
TELECOM_NUMBER = [r"(?iu)NOTA\s+FISCAL\s+FATURA\s*[:\-]?\s*(\d+)", r"(?iu)NOTA\s+FATURA\s*[:\-]?\s*(\d+)", r"(?iu)NF\s+FATURA\s*[:\-]?\s*(\d+)", r"(?iu)FATURA\s*[:\-]?\s*(\d+)"]
TELECOM_VALUE = [rf"(?iu)TOTAL\s+A\s+PAGAR\s*[:\-]?\s*R\$\s*{AMOUNT}", rf"(?iu)VALOR\s+TOTAL\s*[:\-]?\s*R\$\s*{AMOUNT}", rf"(?iu)TOTAL\s*[:\-]?\s*R\$\s*{AMOUNT}"]
TELECOM_DUE = [rf"(?iu)S[ÉE]RIE\s*[:\-]?\s*1\s+VENCIMENTO\s*[:\-]?\s*{DAY}", rf"(?iu)VENCIMENTO\s*[:\-]?\s*{DAY}", rf"(?iu)VENC\.?\s*[:\-]?\s*{DAY}"]
TELECOM_ISSUED = [rf"(?iu)DATA\s+DE\s+EMISS[AÃ]O\s*[:\-]?\s*{DAY}", rf"(?iu)DATA\s+EMISS[AÃ]O\s*[:\-]?\s*{DAY}", rf"(?iu)EMISS[AÃ]O\s*[:\-]?\s*{DAY}", rf"(?iu)Protocolo\s+de\s+Autoriza[çc][aã]o[^\-]+\-\s*{DAY}"]


def is_telecom(x: str) -> Column:
    t = upper(x)
    named_ = t.contains("TELCABLES BRASIL") & any_in(t, ["DOCUMENTO AUXILIAR", "CHAVE DE ACESSO", "NOTA FISCAL"])
    marks = sum((t.rlike(p).cast("int") for p in TELECOM_MARKS), F.lit(0))
    number = all_digits(x).contains(TELECOM_DIGITS) & F.coalesce(T.digits(T.cnpj_flexible(x)) == TELECOM_DIGITS, F.lit(False))
    return number | named_ | (any_in(t, ["TELCABLES", "FATURA"]) & (marks >= 2))  # two marks can't be without one of these words


def telecom_supplier(t: Column) -> Column:
    """The name after its label, else the one before the registration number, else the known one."""
    before = T.group(t, r"(?su)(.{0,100})20[\.\s]?609[\.\s]?743[\./\s]?0004[\.\-\s]?13")
    return F.coalesce(*[T.let(T.group(s, p), lambda g: F.when(g.isNotNull(), T.entity_name(g))) for s, p in (
        (t, r"(?iu)NOME\s*[:\-]\s*([^\n]+)"), (before, r"([A-ZÀ-ÿ][A-Za-zÀ-ÿ\s&\.\-]{10,80}(?:LTDA|S/?A|EIRELI))"), (t, r"(?iu)(TELCABLES\s+BRASIL\s+LTDA(?:\s+FILIAL\s+[A-Z\s]+)?)"))],
        F.when(F.upper(t).contains("TELCABLES BRASIL"), F.lit(TELECOM_SUPPLIER)))


TELECOM = Extractor("telecom_invoice", "NFSE", is_telecom, {
    "fornecedor_nome": plain(telecom_supplier), "cnpj": constant(TELECOM_CNPJ), "serie_nf": constant("1"),
    "numero_nota": plain(lambda t: F.regexp_replace(T.first_group(t, TELECOM_NUMBER), r"^0+(?=\d)", "")),
    "valor": plain(lambda t: F.coalesce(T.first_positive(t, TELECOM_VALUE), F.array_max(F.transform(F.regexp_extract_all(t, F.lit(rf"(?iu)R\$\s*{AMOUNT}"), F.lit(1)), T.money)), F.lit(0.0))),
    "vencimento": plain(lambda t: dates(t, TELECOM_DUE)), "data_emissao": plain(lambda t: F.coalesce(dates(t, TELECOM_ISSUED), F.array_min(T.dates_all(t)))),
})

# ---- an association's slip, a telecom company's goods invoice, an advertiser's slip or invoice

# Companies that these suppliers bill, and labels near dates.
BILLED = ["MOC", "MOC COMUNICACAO", "CSC", "CARRIER", "ITACOLOMI", "OP11", "EXATA", "DEVICE", "ORION", "ATIVE", "RBC"]
GOODS_BILLED = ["ITACOLOMI", "ITACOLOMI COMUNICACAO", "MOC", "MOC COMUNICACAO", "CSC", "CARRIER", "OP11", "EXATA", "DEVICE", "ORION", "ATIVE", "RBC"]
PANEL_BILLED = ["CSC", "CSC GESTÃO INTEGRADA", "CSC GESTAO INTEGRADA", "MOC", "MOC COMUNICACAO", "ITACOLOMI", "ITACOLOMI COMUNICACAO", "CARRIER", "OP11", "EXATA", "DEVICE", "ORION", "ATIVE", "RBC"]

# The association, its number, what shows its slips and what speaks against them.
ASSOCIATION, ASSOCIATION_CNPJ = "ASSOCIAÇÃO COML. INDL. E SERVIÇOS DE MONTES CLAROS", "22.677.702/0001-47"
ASSOCIATION_MARKS = ["ACIMOC", "ASSOCIAÇÃO COMERCIAL INDUSTRIAL E DE SERVIÇOS DE MONTES CLAROS", "ASSOCIAÇÃO COML. INDL. E SERVIÇOS DE MONTES CLAROS", "RECIBO DO SACADO"]
ASSOCIATION_NOT = r"CHAVE\s+DE\s+ACESSO|DANFSE|DOCUMENTO\s+AUXILIAR|NOTA\s+FISCAL|NFSE|NFS-E|GUIA\s+[-–]\s+PROCESSO|DISTRATO|RESCIS[ÓO]RIO|ENCERRAMENTO\s+DE\s+CONTRATO|SOLICITA[ÇC][AÃ]O\s+DE\s+ENCERRAMENTO"
ASSOCIATION_WORDS = ["VALOR", "VENCIMENTO", "DOCUMENTO", "CEDENTE", "SACADO", "PAGADOR"]

ASSOCIATION_SLIP = Extractor("association_slip", "BOLETO", lambda x: any_in(compact(x), compacted(ASSOCIATION_MARKS)) & ~upper(x).rlike(ASSOCIATION_NOT) & (count_in(upper(x), ASSOCIATION_WORDS) >= 2), {
    "fornecedor_nome": constant(ASSOCIATION), "cnpj": constant(ASSOCIATION_CNPJ),
    "valor": lambda x: X.weighted_value(x, lambda u, v: F.when(u.contains("VALOR"), 2).otherwise(1)),
    "vencimento": lambda x: near(x, has("VENC|VCTO"), loose_day, 3),
    "numero_documento": lambda x: T.first_group(x, [r"(?iu)(?:N[ÚU]MERO|DOCUMENTO|BOLETO)[:\s]+(\d{3,4}-\d{3,4})", r"\b(\d{3,4}-\d{3,4})\b", r"(?iu)(?:N[ÚU]MERO|DOCUMENTO)[:\s]+(\d{6,10})"]),
    "empresa": lambda x: named(x, has("SACADO:|PAGADOR:"), BILLED), "data_emissao": lambda x: near(x, has("EMISS[ÃA]O|DATA"), day(DAY), 2),
})

# The supplier of the goods invoice, its number, and the labels of its totals.
GOODS_SUPPLIER, GOODS_CNPJ = "MUGO TELECOMUNICAÇÕES LTDA", "14.732.961/0001-03"
GOODS_TOTALS = ["TOTAL: R$", "VALOR TOTAL: R$", "TOTAL R$", "VALOR TOTAL R$", "VALOR A PAGAR", "VALOR DA FATURA", "DESCRIÇÃO VALOR TOTAL", "V. TOTAL", "V.TOTAL"]
GOODS_NUMBER = [r"(?iu)N[º°O]\s+(?:DOCUMENTO)?\s*[:]?\s*(\d{6,12})", r"(?iu)N[ÚU]MERO\s+(?:DO\s+)?(?:DOCUMENTO|FATURA)?\s*[:]?\s*(\d{6,12})", r"(?iu)FATURA\s+N[º°O]\s*[:]?\s*(\d{6,12})", r"(?iu)DOCUMENTO\s+N[º°O]?\s*[:]?\s*(\d{6,12})", r"(?iu)N[º°O]\s*\.?\s*(\d{6,12})", r"(?iu)NOTA\s+FISCAL\s+N[º°O]?\s*[:]?\s*(\d{6,12})"]
GOODS_LABELS = "Nº|NUMERO|FATURA|DOCUMENTO|NOTA FISCAL|NÚMERO|NF|DOC"


def goods_weight(u: Column, v: Column) -> Column:
    """Of an amount on a line: by the label of a total on it, an item's line, and the amount's size."""
    rules = [(any_in(u, GOODS_TOTALS), 10), (u.contains("VALOR TOTAL"), 9), (u.contains("TOTAL") & ~u.contains("V.UNIT"), 8), (any_in(u, ["V. TOTAL", "V.TOTAL"]), 7), (u.rlike(r"^\s*\d+\s+[^\d]*\d+[\.,]\d+") & (v > 100), 6)]
    return F.coalesce(*[F.when(c, w) for c, w in rules], F.lit(1)) + size_bonus(v)


def goods_number(x: str) -> Column:
    """A labelled number; else one on a line with a label, where the next line's goes first unless the label says number; else any long one."""
    rows, number = lines(x), lambda s: T.group(s, r"(\d{6,12})")
    spot = lambda s, i: F.when(has(GOODS_LABELS)(s), T.let(number(s), lambda n: F.when(n.isNotNull(), F.when(has("Nº|NUMERO")(s), n).otherwise(F.coalesce(number(F.get(rows, i + 1)), n)))))
    return F.coalesce(T.first_group(x, GOODS_NUMBER), F.get(F.array_compact(F.transform(rows, spot)), F.lit(0)), T.group(x, r"\b((?!20|19|00)\d{8,12})\b"))


GOODS = Extractor("goods_invoice", "NFSE", lambda x: upper(x).contains("MUGO TELECOM"), {
    "fornecedor_nome": constant(GOODS_SUPPLIER), "cnpj": constant(GOODS_CNPJ), "valor": lambda x: X.weighted_value(x, goods_weight, AMOUNT_LOOSE), "numero_nota": goods_number, "numero_documento": goods_number,
    "data_emissao": lambda x: near(x, has("EMISS[ÃA]O|EMITIDO|DATA"), loose_day, 2), "vencimento": lambda x: near(x, has("VENC|VCTO|VALIDADE"), loose_day, 3),
    "empresa": lambda x: named(x, has("RAZÃO SOCIAL:|CLIENTE:|TOMADOR:"), GOODS_BILLED),
})

# The advertiser, its number, its spellings, and other suppliers whose papers may name it.
PANEL_SUPPLIER, PANEL_CNPJ = "PRÓ - PAINEL LTDA", "23.129.448/0001-05"
PANEL_NOT = ["MUGO TELECOM", "ACIMOC", "REPROMAQ", "EMC TECNOLOGIA", "NET CENTER"]
PANEL_NUMBER = [r"(?iu)N\.?O?:?\s*(\d{4,6})", r"(?iu)ENTRADA\s+N\.?O?:?\s*(\d{4,6})", r"(?iu)DOCUMENTO\s*[:]?\s*(\d{4,10})", r"(?iu)FATURA\s*[:]?\s*(\d{4,10})", r"(?iu)NOSSO\s+N[ÚU]MERO\s*[:]?\s*([\d\/\-]{8,30})"]


def panel_weight(u: Column, v: Column) -> Column:
    return F.when(u.contains("VALOR DO DOCUMENTO"), 12).when(u.rlike("VALOR|TOTAL"), 10).otherwise(1) + size_bonus(v)


def panel_number(x: str) -> Column:
    """A labelled number; of one with over 15 digits in groups the first group of four or more. Else one of 4 or 6 digits that is no year and no postcode."""
    long = lambda g: F.coalesce(F.when(g.rlike("[/-]") & (F.length(F.regexp_replace(g, "[/-]", "")) > 15), T.group(g, r"(\d{4,10})")), g)
    return F.coalesce(T.let(T.first_group(x, PANEL_NUMBER), long), T.group(x, r"\b((?!20|19|30|31)(?:\d{4}|\d{6}))\b"))


PANEL = Extractor("panel_slip", lambda x: F.when(any_in(upper(x), ["BOLETO PIX", "VALOR DO DOCUMENTO"]), "BOLETO").otherwise("NFSE"), lambda x: compact(x).contains("PROPAINEL") & ~any_in(upper(x), PANEL_NOT), {
    "fornecedor_nome": constant(PANEL_SUPPLIER), "cnpj": constant(PANEL_CNPJ), "valor": lambda x: X.weighted_value(x, panel_weight, AMOUNT_LOOSE), "numero_nota": panel_number, "numero_documento": panel_number,
    "data_emissao": lambda x: near(x, has("EMISS[ÃA]O|EMITIDO|DATA"), loose_day, 2), "vencimento": lambda x: near(x, has("VENC|VCTO"), loose_day, 3),
    "empresa": lambda x: named(x, has("PAGADOR|CLIENTE"), PANEL_BILLED),
})

# ---- a cooperative bank's slip

# What shows the bank and a slip, in compact form.
COOPERATIVE, COOPERATIVE_WORDS = "SICOOB", ["LINHADIGITAVEL", "BENEFICI", "VENCIMENTO", "VALORDODOCUMENTO", "CODIGODEBARRAS"]


def is_cooperative(x: str) -> Column:
    c = compact(x)
    return (any_in(c, ["SICOOB", "BANCOOB", "7560"]) | (c.contains("756") & c.contains("LINHADIGITAVEL"))) & any_in(c, COOPERATIVE_WORDS)


def cooperative_supplier(x: str) -> Column:
    """The slip's supplier; where that is short or a label, what stands between the beneficiary's label and the agency or number."""
    bare = F.regexp_replace(F.regexp_replace(T.group(x, r"(?isu)\bBenefici[aá]rio\b\s*[:\-]?\s*(.+?)\s*(?:\bAg[êe]ncia\b|\bCNPJ\b|\bCPF\b)"), r"[\d\./\-]+", " "), r"\s+", " ")
    named_ = T.group(x, r"(?iu)\b(CAMARGO\s+E\s+SILVA\s+[^\n\r0-9]{3,80})\b")
    own = T.let(T.entity_name(GENERIC["slip"].fields["fornecedor_nome"](x)), lambda f: F.when((F.length(f) >= 5) & ~f.rlike(r"(?iu)\bCPF\b|\bCNPJ\b|\bBENEFICI"), f))
    return F.coalesce(F.trim(named_), own, T.let(F.regexp_replace(bare, r"^[ \-:;]+|[ \-:;]+$", ""), lambda b: F.when(F.length(b) >= 4, b)), GENERIC["slip"].fields["fornecedor_nome"](x))


COOPERATIVE_SLIP = Extractor("cooperative_slip", "BOLETO", is_cooperative, GENERIC["slip"].fields | {"banco": constant(COOPERATIVE), "fornecedor_nome": cooperative_supplier})

for _e in (LINE_BASED, RENTAL, NET, FIRST_CITY, SECOND_CITY):
    register(_e, before="energy")
for _e in (TELECOM, ASSOCIATION_SLIP, GOODS, PANEL):
    register(_e, before="admin")
register(COOPERATIVE_SLIP, before="product")
