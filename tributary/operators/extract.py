"""Text of a document to one typed row: an ordered router, and a cascade of patterns for each field.

An extractor is a name, a predicate over the text and a column for each field. The first predicate that holds in the registry's
order routes the text. Everything is a native expression, so a scan of texts stays in one stage.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import text as T

# Formats of amounts and days.
AMOUNT = r"(\d{1,3}(?:\.\d{3})*,\d{2})"
DAY = r"(\d{2}/\d{2}/\d{4})"


@dataclass
class Extractor:
    name: str
    doc_type: str | Callable[[str], Column]
    accepts: Callable[[str], Column]
    fields: dict[str, Callable[[str], Column]] = field(default_factory=dict)


REGISTRY: list[Extractor] = []


def register(e: Extractor, before: str | None = None) -> Extractor:
    """Adds an extractor to the registry, at its end or before the named one."""
    at = next((i for i, x in enumerate(REGISTRY) if x.name == before), len(REGISTRY))
    REGISTRY.insert(at, e)
    return e


def upper(x: str) -> Column:
    """The text in upper case, as prepared() has it."""
    return F.col(f"{x}__upper")


def all_digits(x: str) -> Column:
    """The digits of the text, as prepared() has them."""
    return F.col(f"{x}__digits")


def compact(x: str) -> Column:
    """Upper-case letters and digits of the text, as prepared() has them."""
    return F.col(f"{x}__compact")


def fenced(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns by a generator of one row, which the optimizer doesn't merge with what reads them: each is evaluated once for a row."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def prepared(df: DataFrame, x: str) -> DataFrame:
    """Adds what predicates and fields ask many times of a text: its upper-case and compact forms, its lines, and its slip's line."""
    rows = F.filter(F.transform(F.split(F.coalesce(F.col(x), F.lit("")), "\n"), lambda s: F.trim(s)), lambda s: s != "")
    first = fenced(df, {f"{x}__upper": F.upper(F.coalesce(F.col(x), F.lit(""))), f"{x}__compact": T.compact(x), f"{x}__digits": T.digits(x), f"{x}__lines": rows})
    enough = F.length(all_digits(x)) >= 47  # a slip's line has as many, so most texts need no scan for one
    return fenced(first, {f"{x}__line": enough & has_slip_line(x), f"{x}__slip": F.when(enough, T.first_group(x, [rf"({SLIP_LINE})", r"(\d{47,48})"]))})


def unprepared(df: DataFrame, x: str) -> DataFrame:
    return df.drop(*(f"{x}__{c}" for c in ("upper", "compact", "digits", "lines", "line", "slip")))


def count_in(t: Column, words: list[str]) -> Column:
    """How many of the words a text holds."""
    return sum((F.contains(t, F.lit(w)).cast("int") for w in words), F.lit(0))


def any_in(t: Column, words: list[str]) -> Column:
    return count_in(t, words) > 0


def lines(x: str) -> Column:
    """The lines of a text, trimmed, without empty ones, as prepared() has them."""
    return F.col(f"{x}__lines")


def first_of(rows: Column, pick: Callable[[Column], Column]) -> Column:
    """The first pick of a row that isn't null."""
    return F.get(F.array_compact(F.transform(rows, pick)), F.lit(0))


def near(x: str, label: Callable[[Column], Column], pick: Callable[[Column], Column], ahead: int, begin: int = 0) -> Column:
    """The first pick of a line with the label or, from `begin` lines on, one of the `ahead` lines after it, in the order of the lines."""
    rows = lines(x)
    spot = lambda s, i: F.when(label(s), first_of(F.slice(rows, i + 1 + begin, ahead + 1 - begin), pick))
    return F.get(F.array_compact(F.transform(rows, spot)), F.lit(0))


def has(pattern: str) -> Callable[[Column], Column]:
    """A label: whether a line has the pattern."""
    return lambda s: s.rlike("(?iu)" + pattern)


def after_label(x: str, label: str, pattern: str, ahead: int) -> Column:
    """The pattern's group on the first line with the label or one of the `ahead` lines after it."""
    rows = lines(x)
    marked = F.filter(F.transform(rows, lambda s, i: F.when(s.rlike("(?iu)" + label), i)), lambda i: i.isNotNull())
    return T.let(F.get(marked, F.lit(0)), lambda i: F.when(i.isNotNull(), T.group(F.array_join(F.slice(rows, i + 1, ahead + 1), "\n"), pattern)))


# What shows that a long number is an invoice's key and not a slip's line.
INVOICE_CONTEXT = ["DANFSE", "DOCUMENTO AUXILIAR DA NFS-E", "DOCUMENTO AUXILIAR DA NOTA FISCAL", "CHAVE DE ACESSO", "CÓDIGO DE VERIFICAÇÃO", "CODIGO DE VERIFICACAO", "NFS-E", "NOTA FISCAL DE SERVIÇO ELETRÔNICA", "NOTA FISCAL DE SERVICO ELETRONICA"]
SLIP_LINE = r"\d{5}[.\s]?\d{5}\s+\d{5}[.\s]?\d{6}\s+\d{5}[.\s]?\d{6}\s+\d\s+\d{14}"


def has_slip_line(x: str) -> Column:
    """Whether the text has a slip's digits: in groups, or 47 to 48 in a row away from a key. Never in the context of an invoice."""
    flat = F.replace(F.coalesce(F.col(x), F.lit("")), F.lit("\n"), F.lit(" "))
    long = flat.rlike(r"\d{47}") & ~F.upper(F.regexp_extract(flat, r"(.{0,50})\d{47,48}", 1)).rlike("CHAVE|ACESSO")
    return ~any_in(upper(x), INVOICE_CONTEXT) & (flat.rlike(SLIP_LINE) | long)


# ---- bank slips

# Words of slips and of invoices. Each spelling counts, also where two are alike in compact form.
SLIP_WORDS = [
    "LINHA DIGITÁVEL", "LINHA DIGITAVEL", "BENEFICI", "BENEFICIÁRIO", "BENEFICIARIO", "VENCIMENTO", "VALOR DO DOCUMENTO", "NOSSO", "NOSSO NÚMERO", "NOSSO NUMERO",
    "CÓDIGO DE BARRAS", "CODIGO DE BARRAS", "AGÊNCIA/CÓDIGO", "AGENCIA/CODIGO", "CEDENTE", "RECIBO DO PAGADOR", "RECIBO DO SACADO",
]
INVOICE_WORDS = ["NFS-E", "NOTA FISCAL DE SERVIÇO ELETRÔNICA", "NOTA FISCAL DE SERVICO ELETRONICA", "PREFEITURA", "DANFE", "DOCUMENTO AUXILIAR DA NOTA FISCAL", "DOCUMENTO AUXILIAR DA NFS", "DANFSE"]
# Codes of banks.
BANKS = {"001": "BANCO DO BRASIL", "033": "SANTANDER", "077": "INTER", "104": "CAIXA ECONOMICA FEDERAL", "237": "BRADESCO", "341": "ITAU", "389": "MERCANTIL", "422": "SAFRA", "748": "SICREDI", "756": "SICOOB"}


def compacted(words: list[str]) -> list[str]:
    """Words in compact form, as many as there are."""
    return [re.sub("[^A-Z0-9]+", "", w.translate(str.maketrans(T.ACCENTED, T.PLAIN)).upper()) for w in words]


def is_slip(x: str) -> Column:
    c = compact(x)
    invoice = any_in(c, ["DANFSE", "DOCUMENTOAUXILIARDANFS"]) | (c.contains("DOCUMENTOAUXILIAR") & c.contains("NFS")) | (c.contains("CHAVEDEACESSO") & any_in(c, ["NFSE", "NOTAFISCALDESERVICO"]))
    return ~invoice & ((count_in(c, compacted(SLIP_WORDS)) >= 3) | F.col(f"{x}__line")) & (count_in(c, compacted(INVOICE_WORDS)) < 3)


def slip_line(x: str) -> Column:
    """The slip's digits, as prepared() has them."""
    return F.col(f"{x}__slip")


def slip_line_cents(x: str) -> Column:
    """The value in a slip's line: its last ten digits are cents; null if they are 0."""
    return T.let(F.substr(T.digits(slip_line(x)), F.lit(-10), F.lit(10)).try_cast("long"), lambda d: F.when(d > 0, d))


# Labels before a slip's value and number, and before the number of its invoice.
SLIP_VALUE = [rf"(?iu)Valor\s+do\s+Documento\s*[:\s]*R\$?\s*{AMOUNT}", rf"(?iu)Valor\s+Nominal\s*[:\s]*R\$?\s*{AMOUNT}", rf"(?iu)Valor\s+Cobrado\s*[:\s]*R\$?\s*{AMOUNT}", rf"(?iu)Valor\s+do\s+Documento[\s\n]+{AMOUNT}\b", rf"(?iu)Valor\s+Nominal[\s\n]+{AMOUNT}\b", rf"(?iu)Valor\s*[:\s]*R\$\s*{AMOUNT}"]
SLIP_NUMBER = [r"(?iu)N[uú]mero\s+do\s+Documento\s*[:\s]*([0-9]+(?:\.[0-9]+)?)", r"(?iu)Num\.?\s*Documento\s*[:\s]*([0-9]+(?:\.[0-9]+)?)", r"(?iu)N[º°]\s*Documento\s*[:\s]*([0-9]+(?:[/.][0-9]+)?)", r"\b(20\d{2}\.\d+)\b"]
REFERENCE = [r"(?iu)Ref\.?\s*NF[:\s-]*(\d+)", r"(?iu)Refer[eê]ncia\s*NF[:\s-]*(\d+)", r"(?iu)Nota\s+Fiscal\s*n?[º°]?\s*[:\s]*(\d+)", r"(?iu)\bNFS?-?e?\s*[:\s-]*(\d+)"]


def slip_value(x: str) -> Column:
    """The line's cents, else a labelled value, else the largest amount."""
    return F.coalesce(slip_line_cents(x) / F.lit(100.0), T.first_positive(x, SLIP_VALUE), T.money_max(x))


# The words that speak for or against a due date beside them, and their weights.
DUE_ALONE, DUE_NUMBER, DUE_AMOUNT, DUE_PROCESSED, DUE_ISSUED, DUE_STARTS = 3, 2, 2, -3, -1, 2
YEARS = ("2020-01-01", "2035-12-31")


def slip_due(x: str) -> Column:
    """The best scored due date of the lines that name one, on the line or the next two; ties go to the latest.

    A header of issue and due date comes first. Without a labelled date it is the latest date of a line that neither names an issue
    nor a processing date, else the latest of all. Only years from 2020 to 2035 count.
    """
    rows, day = lines(x), rf"\b{DAY}\b"
    valid = lambda d: T.let(T.date_br(d), lambda v: F.when(v.between(*YEARS), v))
    heads = T.let(
        F.regexp_extract(F.col(x), r"(?isu)\bEmiss[aã]o\b\s+\bVencim\s*ento\b[\s\S]{0,220}?(\d{2}/\d{2}/\d{4}\s+\d{2}/\d{2}/\d{4})", 1),
        lambda h: T.let(valid(F.substring(h, -10, 10)), lambda v: F.when(v >= T.date_br(F.substring(h, 1, 10)), v)),
    )

    def spot(s: Column, i: Column) -> Column:
        up, around = F.upper(s), F.upper(F.array_join(F.slice(rows, F.greatest(F.lit(1), i), F.lit(3)), " "))
        score = sum(
            (F.when(c, w).otherwise(0) for c, w in (
                (up == "VENCIMENTO", DUE_ALONE), (up.rlike("N[UÚ]MERO DO DOCUMENTO"), DUE_NUMBER), (up.contains("VALOR DO DOCUMENTO"), DUE_AMOUNT),
                (around.contains("PROCESSAMENTO"), DUE_PROCESSED), (around.rlike("EMISS|DATA DO DOCUMENTO"), DUE_ISSUED))),
            F.lit(0),
        )
        own = valid(T.group(s, rf"(?iu)\bVencimento\b.{{0,130}}?{day}"))
        later = lambda n: T.let(F.get(rows, i + n), lambda t: F.struct(valid(T.group(t, day)).alias("d"), F.when(t.rlike(rf"^{DAY}"), DUE_STARTS).otherwise(0).alias("w")))
        below = first_of(F.array(later(1), later(2)), lambda p: F.when(p["d"].isNotNull(), p))
        return F.when(has(r"\bVencimento\b")(s), T.let(own, lambda o: F.when(o.isNotNull(), F.struct(score.alias("w"), o.alias("d"))).otherwise(T.let(below, lambda p: F.when(p.isNotNull(), F.struct((score + p["w"]).alias("w"), p["d"].alias("d")))))))

    labelled = F.array_max(F.array_compact(F.transform(rows, spot)))["d"]
    dated = lambda keep: F.array_max(F.flatten(F.transform(F.filter(rows, keep), lambda s: F.filter(T.dates_all(s), lambda d: d.between(*YEARS)))))
    return F.coalesce(heads, labelled, dated(lambda s: ~F.upper(s).rlike("PROCESSAMENTO|DATA DO DOCUMENTO|EMISS")), dated(lambda s: F.lit(True)))


def slip_issued(x: str) -> Column:
    """The document's date, else the smallest date from 2020 to 2035."""
    early = F.array_min(F.filter(T.dates_all(x), lambda d: d.between("2020-01-01", "2035-12-31")))
    return F.coalesce(T.date_br(after_label(x, r"\bData\s+do\s+documento\b", rf"\b{DAY}\b", 3)), T.date_br(T.group(x, rf"(?isu)Data\s+de\s+Emiss[aã]o.{{0,120}}?{DAY}")), early)


def bank_name(x: str) -> Column:
    """The bank by its code, in the text or the slip's line; BANCO_code for a code without a name."""
    code = F.coalesce(T.group(x, r"(?iu)(?:Banco|C[oó]digo\s+Banco)[^\d\n]{0,20}(\d{3})\b"), F.substring(T.digits(slip_line(x)), 1, 3))
    return T.let(T.blank_to_null(code), lambda c: F.coalesce(*[F.when(c == k, v) for k, v in BANKS.items()], F.concat(F.lit("BANCO_"), c)))


# Fixed values in the extractors below: words that show the kind of a document, and labels before its fields.
ENERGY_VALUE = [rf"(?iu)TOTAL\s+A\s+PAGAR\s*[:\-]?\s*(?:R\$)?\s*{AMOUNT}", rf"(?iu)VALOR\s+(?:TOTAL|A\s+PAGAR)\s*[:\-]?\s*{AMOUNT}", rf"(?iu)TOTAL\s*[:\-]?\s*(?:R\$)?\s*{AMOUNT}"]
ENERGY_WORDS = [
    "DISTRIB DE ENERGIA", "DISTRIBUIDORA DE ENERGIA", "ENERGIA ELÉTRICA", "ENERGIA ELETRICA", "CONSUMO", "KWH", "KWH/MÊS", "KWH/MES", "INSTALAÇÃO", "INSTALACAO",
    "BANDEIRA TARIFÁRIA", "BANDEIRA TARIFARIA", "FATURA DE ENERGIA", "CONTA DE LUZ", "CONTA DE ENERGIA", "FATURA ELETRÔNICA", "FATURA ELETRONICA",
    "EDP", "CEMIG", "COPEL", "CPFL", "ENERGISA", "NEOENERGIA", "ELEKTRO", "ENEL", "LIGHT", "COSERN", "CELESC", "CELPE", "COELBA", "COELCE",
]

register(Extractor("energy", "NFSE", lambda x: count_in(upper(x), ENERGY_WORDS) >= 2, {
    "numero_nota": lambda x: T.first_group(x, [r"(?iu)NOTA\s+FISCAL\s*N[°º]?\s*[:\-]?\s*([0-9.\-]+)", r"(?iu)FATURA\s*N[°º]?\s*[:\-]?\s*([0-9.\-]+)", r"(?iu)DOCUMENTO\s*[:\-]?\s*([0-9.\-]+)"]),
    "instalacao": lambda x: T.first_group(x, [r"(?iu)INSTALA[ÇC][ÃA]O\s*[:\-]?\s*(\d+)", r"(?iu)(\d{8,12})\s*(?:INSTALA[ÇC][ÃA]O|MATR[ÍI]CULA)"]),
    "valor": lambda x: F.coalesce(T.let(repaired(x), lambda t: T.first_positive(t, ENERGY_VALUE)), T.money_max(x)),
    "vencimento": lambda x: T.date_br(T.first_group(x, [rf"(?iu)VENCIMENTO\s*[:\-]?\s*{DAY}", rf"(?iu)VENCE\s+EM\s*[:\-]?\s*{DAY}", rf"(?iu)VENC\.?\s*[:\-]?\s*{DAY}", rf"(?iu)VENCIMENTO[^\d]{{0,30}}{DAY}"])),
    "data_emissao": lambda x: T.date_br(T.first_group(x, [rf"(?iu)EMISS[ÃA]O\s*[:\-]?\s*{DAY}", rf"(?iu)EMITIDO\s+EM\s*[:\-]?\s*{DAY}", rf"\b{DAY}\b"])),
    "cnpj": lambda x: T.cnpj_flexible(x),
    "fornecedor_nome": lambda x: T.entity_name(F.get(lines(x), F.lit(0))),
}))


def repaired(x: str) -> Column:
    """Text with decimals joined that were split: `369, 4 0` is `369,40`."""
    return F.regexp_replace(F.col(x), r"(\d{1,3}(?:\.\d{3})*),\s*(\d)\s*(\d)", "$1,$2$3")


# Administrative papers by what their text says.
ADMIN = {"DISTRATO": r"\bDISTRATO\b", "GUIA": r"\bGUIA\s+(DE\s+)?(RECOLHIMENTO|PROCESSO)", "CONTRATO": r"\bCONTRATO\s+DE\s+(PRESTA|LOCA)", "ORDEM_SERVICO": r"\bORDEM\s+DE\s+SERVI[ÇC]O", "RELATORIO": r"\bRELAT[ÓO]RIO\s+DE\b", "COMUNICADO": r"\bCOMUNICADO\b", "NOTIFICACAO": r"\bNOTIFICA[ÇC][ÃA]O\b"}


def is_admin(x: str) -> Column:
    """A paper that says what it is and is neither an invoice nor a slip."""
    t = upper(x)
    fiscal = count_in(t, ["NFS-E", "NF-E", "DANFE", "CHAVE DE ACESSO", "PREFEITURA", "CÓDIGO DE VERIFICAÇÃO"])
    return ~((fiscal >= 2) | t.rlike(r"(?<!\d)\d{44}(?!\d)") | (count_in(compact(x), list(dict.fromkeys(compacted(SLIP_WORDS)))) >= 3)) & T.any_match(x, list(ADMIN.values()))


register(Extractor("admin", "OUTRO", is_admin, {
    "subtipo": lambda x: F.coalesce(*[F.when(T.any_match(x, [p]), F.lit(k)) for k, p in ADMIN.items()]),
    "valor": lambda x: T.money_max(x), "vencimento": lambda x: slip_due(x), "data_emissao": lambda x: T.first_date(x), "cnpj": lambda x: T.cnpj(x),
}))


def is_other(x: str) -> Column:
    """Rental statements and administrative invoices without the marks of a fiscal document."""
    t = upper(x)
    fiscal = any_in(t, ["NFS-E", "NFSE", "CÓDIGO DE VERIFICAÇÃO", "CODIGO DE VERIFICACAO", "PREFEITURA MUNICIPAL", "DANFE", "DOCUMENTO AUXILIAR", "CHAVE DE ACESSO", "NF-E", "NFE"]) | t.rlike(r"(?<!\d)\d{44}(?!\d)")
    taxes = F.size(F.regexp_extract_all(t, F.lit("ISS|INSS|PIS|COFINS|ICMS|CSLL|IRRF|IRPJ"), F.lit(0))) >= 2
    invoice = t.contains("FATURA") & ~any_in(t, ["NOTA FATURA", "NOTA-FATURA"]) & (count_in(t, ["NOTA FISCAL", "NFS", "NFSE", "SERVIÇO", "SERVICO", "ELETRÔNICA", "ELETRONICA"]) < 2)
    return ~fiscal & ~taxes & ((t.contains("DEMONSTRATIVO") & t.contains("LOCA")) | t.contains("VALOR DA LOCA") | invoice)


# Labels before the value of a rental or administrative invoice.
OTHER_VALUE = [rf"(?iu)\bTOTAL\s+A\s+PAGAR\b[\s\S]{{0,80}}?{AMOUNT}\b", rf"(?iu)\bVALOR\s+DA\s+LOCA[ÇC][ÃA]O\b[\s\S]{{0,40}}?{AMOUNT}\b", rf"(?iu)\bTOTAL\s*R\$\s*{AMOUNT}", rf"(?iu)\bVALOR\b[\s\S]{{0,20}}?R\$\s*{AMOUNT}", rf"\bR\$\s*{AMOUNT}\b"]

register(Extractor("other", "OUTRO", is_other, {
    "subtipo": lambda x: F.when(F.upper(F.col(x)).contains("LOCA"), "LOCACAO").otherwise("FATURA"),
    "numero_documento": lambda x: T.first_group(x, [r"(?iu)\bN[º°o]\.?\s*[:\-]?\s*(\d+)", r"(?iu)FATURA\s*[:\-]?\s*(\d+)"]),
    "valor": lambda x: F.coalesce(T.first_positive(x, OTHER_VALUE), F.lit(0.0)),
    "vencimento": lambda x: T.date_br(T.first_group(x, [rf"(?iu)\bVENCIMENTO\b\s*[:\-]?\s*{DAY}", rf"(?iu)Data\s+de\s+Vencimento\s+do\s+Contrato\s*[:\-]?\s*{DAY}"])),
    "data_emissao": lambda x: T.date_br(T.group(x, rf"\b{DAY}\b")), "cnpj": lambda x: T.cnpj(x),
    "fornecedor_nome": lambda x: T.entity_name(T.first_group(x, [r"(?iu)(?:Locador|Fornecedor)\s*:\s*([^\n]+)"])),
}))

# What a service invoice says of itself.
SERVICE_MARKS = ["NFS-E", "NFSE", "NOTA FISCAL DE SERVIÇO", "NOTA FISCAL DE SERVICO", "DOCUMENTO AUXILIAR DA NFS-E", "CÓDIGO DE VERIFICAÇÃO", "CODIGO DE VERIFICACAO", "PREFEITURA MUNICIPAL"]


def is_service(x: str) -> Column:
    """A service invoice: a strong mark and no slip line; else anything that is neither a product invoice, a slip nor another kind."""
    t = upper(x)
    return (any_in(t, SERVICE_MARKS) & ~F.col(f"{x}__line")) | ~(is_product(x) | is_slip(x) | is_other(x))


def is_product(x: str) -> Column:
    """A product invoice. Its key must be 44 digits that no other digit touches."""
    t = upper(x)
    return t.contains("DANFE") | (t.contains("DOCUMENTO AUXILIAR") & t.contains("NOTA FISCAL") & t.contains("ELETR")) | t.rlike(r"(?<!\d)\d{44}(?!\d)") | (t.contains("CHAVE DE ACESSO") & any_in(t, ["NF-E", "NFE"]))


def tax(names: list[str]) -> Callable[[str], Column]:
    """The first amount after one of the labels; null without one."""
    return lambda x: T.let(T.first_group(x, [rf"(?iu){n}[:\s]*R?\$?\s*{AMOUNT}" for n in names]), lambda g: F.when(g.isNotNull(), T.money(g)))


# Labels before the value and number of a service invoice.
SERVICE_VALUE = [rf"(?iu)Valor\s+Total\s*(?:do\s+Servi[çc]o)?\s*[:=\s]*R\$\s*{AMOUNT}", rf"(?iu)Valor\s+da\s+Nota\s*[:\s]*R\$\s*{AMOUNT}", rf"(?iu)Valor\s*[:\s]*R\$\s*{AMOUNT}", rf"(?iu)Valor\s+(?:Total|da\s+Nota)\s*[:\s]+{AMOUNT}\b", rf"(?iu)Total\s+Nota\s*[:\s]+{AMOUNT}\b", rf"(?iu)Valor\s+L[ií]quido\s*[:\s]+{AMOUNT}\b", rf"\bR\$\s*{AMOUNT}\b"]
SERVICE_NUMBER = [r"(?iu)NFS-?e\s*(?:N[º°o]|Num)?\.?\s*[:.-]?\s*(\d{4}[/\-]\d{1,6})\b", r"(?iu)N[úu]mero\s+da\s+Nota[^\d]{0,40}(?<!\d)(\d{1,15})(?!\d)", r"(?iu)Nota\s*Fiscal\s*(?:N[º°o]|Num)?\.?\s*[:.-]?\s*(\d{1,15})", r"(?iu)(?:N[úu]mero|N[º°o])\s*[:.-]?\s*(\d{1,15})"]


def service_number(x: str) -> Column:
    """The number of a service invoice, once dates and the numbers of receipts, lots and series are out of the way."""
    clean = F.regexp_replace(F.regexp_replace(F.coalesce(F.col(x), F.lit("")), r"\d{2}/\d{2}/\d{4}", " "), r"(?iu)\b(RPS|Lote|Protocolo|Recibo|S[eé]rie)\b\D{0,10}?\d+", " ")
    return T.let(clean, lambda t: T.first_group(t, SERVICE_NUMBER))


register(Extractor("service", "NFSE", is_service, {
    "numero_nota": service_number,
    "valor": lambda x: F.coalesce(T.first_positive(x, SERVICE_VALUE), F.lit(0.0)),
    "data_emissao": lambda x: T.date_br(T.group(x, r"\d{2}/\d{2}/\d{4}", 0)),
    "vencimento": lambda x: T.date_br(T.first_group(x, [rf"(?iu)Vencimento[:\s]+{DAY}", rf"(?iu)Venc[:.\s]+{DAY}"])),
    "cnpj": lambda x: T.cnpj_flexible(x),
    "fornecedor_nome": lambda x: T.entity_name(T.first_group(x, [r"(?imu)^\s*Raz[ãa]o\s+Social\s*[:\-]\s*([^\n]+?)\s*$", r"(?iu)Prestador[^\n:]*:\s*([^\n]+)", r"(?iu)Nome[^\n:]*:\s*([^\n]+)"])),
    "valor_ir": tax([r"\bIR\s*(?:Retido)?", r"Imposto\s+de\s+Renda"]), "valor_inss": tax([r"\bINSS\s*(?:Retido)?"]), "valor_csll": tax([r"\bCSLL\s*(?:Retida)?", r"Contribui[çc][ãa]o\s+Social"]),
    "valor_iss": tax([r"\bISS\s*(?:Retido)?", r"Imposto\s+(?:Sobre\s+)?Servi[çc]os?"]), "valor_icms": tax([r"\bICMS"]), "base_icms": tax([r"Base\s+de\s+C[aá]lculo\s+ICMS", r"BC\s+ICMS"]),
}))

register(Extractor("slip", "BOLETO", is_slip, {
    "numero_documento": lambda x: T.first_group(x, SLIP_NUMBER), "valor": slip_value, "vencimento": slip_due, "data_emissao": slip_issued, "linha_digitavel": slip_line,
    "nosso_numero": lambda x: T.first_group(x, [r"(?iu)Nosso\s+N[úu]mero[^\n]{0,20}?(\d{2,3}/\d{7,}-\d+)", r"(?iu)Nosso\s+N[úu]mero\s*[:\s]*([\d\-/]+)", r"\b(\d{3}/\d{8}-\d)\b"]),
    "cnpj": lambda x: F.coalesce(T.group(x, r"(?iu)Benefici[aá]rio[^\n]*?(\d{2}\.\d{3}\.\d{3}/\d{4}-\d{2})"), T.group(x, r"(?iu)Cedente[^\n]*?(\d{2}\.\d{3}\.\d{3}/\d{4}-\d{2})"), T.cnpj(x)),
    "cnpj_pagador": lambda x: after_label(x, r"\bDados\s+do\s+Pagador\b", r"(\d{2}\.\d{3}\.\d{3}/\d{4}-\d{2})", 8),
    "fornecedor_nome": lambda x: T.entity_name(T.first_group(x, [r"(?iu)Benefici[aá]rio\s*:?\s*([^\n]+?)\s*[-–]?\s*CNPJ", r"(?iu)Benefici[aá]rio\s*:?\s*([^\n]+)", r"(?iu)Cedente\s*:?\s*([^\n]+)"])),
    "referencia_nfse": lambda x: T.first_group(x, REFERENCE), "banco": bank_name,
    "agencia": lambda x: T.first_group(x, [r"(?iu)Ag[eê]ncia[^\d\n]*(\d[\d.]{1,14}(?:\s*[-–]\s*\d)?)"]), "conta": lambda x: T.first_group(x, [r"(?iu)Conta\s+Corrente[^\d\n]*(\d{1,12}(?:[\s\-]\d)?)", r"(?iu)\bC/?C[^\d\n]*(\d{1,12}(?:[\s\-]\d)?)"]),
}))


def instalments(x: str) -> Column:
    """Array of (parcela, vencimento, valor), in the order of the instalments' numbers."""
    found = F.regexp_extract_all(F.coalesce(F.col(x), F.lit("")), F.lit(r"(?m)(?:\b\d{1,2}/\d{1,2}|\b\d{3})\s+\d{2}/\d{2}/\d{4}\s+[\d.]+,\d{2}"), F.lit(0))
    part = lambda s, n: F.get(F.split(s, r"\s+"), F.lit(n))
    rows = F.transform(found, lambda s: F.struct(F.regexp_extract(s, r"^(\d+)", 1).try_cast("int").alias("n"), part(s, 0).alias("parcela"), T.date_br(part(s, 1)).alias("vencimento"), T.money(part(s, 2)).alias("valor")))
    return F.transform(F.array_sort(rows), lambda r: F.struct(r["parcela"].alias("parcela"), r["vencimento"].alias("vencimento"), r["valor"].alias("valor")))


# Labels before the value of a product invoice.
PRODUCT_VALUE = [r"\bVALOR\s+TOTAL\s+DA\s+NOTA\b", r"\bVALOR\s+TOTAL\s+(?:DOS\s+)?PRODUTOS\b", r"\bV\.?\s*TOTAL\s+DA\s+NOTA\b", r"\bTOTAL\s+DA\s+NOTA\b"]

register(Extractor("product", "DANFE", is_product, {
    "numero_nota": lambda x: T.digits(T.first_group(x, [r"(?iu)\bN[º°o]\.?\s*[:\-]?\s*([0-9]+(?:\.[0-9]+)*)", r"(?iu)\bNF-?E\b[^\n]{0,120}?\bN[º°o.]?\s*[:\-]?\s*([0-9.]{1,20})"])),
    "serie_nf": lambda x: T.group(x, r"(?iu)\bS[ÉE]RIE\s*[:\-]?\s*(\d{1,4})\b"),
    "valor": lambda x: F.coalesce(T.first_positive(x, [rf"(?iu){p}[^\d]{{0,40}}{AMOUNT}" for p in PRODUCT_VALUE]), T.money_max(x)),
    "data_emissao": lambda x: T.date_br(T.first_group(x, [r"(?iu)DATA\s*(?:DA|DE)?\s*EMISS.O[^\d]{0,30}(\d{2}[/-]\d{2}[/-]\d{2,4})", r"(?iu)\bEMISS[ÃA]O\s*[:\-]?\s*(\d{2}[/-]\d{2}[/-]\d{2,4})"])),
    "chave_acesso": lambda x: F.coalesce(T.group(x, r"(?<!\d)(\d{44})(?!\d)"), T.digits(T.group(x, r"((?:\d{4}\s+){10}\d{4})"))),
    "cnpj": lambda x: T.cnpj(x),
    "fornecedor_nome": lambda x: T.entity_name(T.first_group(x, [r"(?isu)\bRECEBEMOS\s+DE\s+(.+?)\s+OS\s+PRODUTOS", r"(?iu)Emitente\s*:\s*([^\n]+)"])),
    "numero_pedido": lambda x: T.first_group(x, [r"(?iu)\bPEDIDO\s*(?:DE\s*COMPRAS?)?\s*[:\-]?\s*(\d+)", r"(?iu)\bORDEM\s*(?:DE\s*COMPRA)?\s*[:\-]?\s*(\d+)"]),
    "vencimento": lambda x: F.get(instalments(x), F.lit(0))["vencimento"],
}))


def weighted_value(x: str, weight: Callable[[Column, Column], Column], amount: str = AMOUNT) -> Column:
    """The amount of the largest (weight, value) over all lines; weight(line in upper case, value). 0 without one."""

    def found(s: Column) -> Column:
        return F.transform(F.regexp_extract_all(s, F.lit(amount), F.lit(1)), lambda a: T.let(T.positive(a), lambda v: F.when(v.isNotNull(), F.struct(weight(F.upper(s), v).alias("w"), v.alias("v")))))

    return F.coalesce(F.array_max(F.array_compact(F.flatten(F.transform(lines(x), found))))["v"], F.lit(0.0))


def kind_of(e: Extractor, x: str) -> Column:
    return e.doc_type(x) if callable(e.doc_type) else F.lit(e.doc_type)


def routed(texts: DataFrame, column: str = "text", registry: list[Extractor] | None = None) -> DataFrame:
    """Adds extractor, the name of the first one that accepts the text; null for an empty text."""
    use = REGISTRY if registry is None else registry
    return unprepared(fenced(prepared(texts, column), {"extractor": F.when(T.blank_to_null(column).isNotNull(), F.coalesce(*[F.when(e.accepts(column), F.lit(e.name)) for e in use]))}), column)


def extracted(texts: DataFrame, name: str, column: str = "text", registry: list[Extractor] | None = None) -> DataFrame:
    """Adds doc_type and the fields of the named extractor."""
    e = next(x for x in (registry or REGISTRY) if x.name == name)
    return unprepared(fenced(prepared(texts, column), {"doc_type": kind_of(e, column)} | {k: f(column) for k, f in e.fields.items()}), column)


def extracted_all(texts: DataFrame, column: str = "text", registry: list[Extractor] | None = None) -> DataFrame:
    """Routes each text and adds doc_type and the union of all extractors' fields, those of others null.

    The route is decided first; a field's expression then begins with the branch of the text's own extractor, and no other is evaluated.
    """
    use = REGISTRY if registry is None else registry
    ready = prepared(texts, column)
    route = F.when(T.blank_to_null(column).isNotNull(), F.coalesce(*[F.when(e.accepts(column), F.lit(e.name)) for e in use]))
    out = fenced(ready, {"extractor": route})
    names = list(dict.fromkeys(k for e in use for k in e.fields))
    own = lambda e: F.col("extractor") == e.name

    def pick(f: Callable[[Extractor], Column | None]) -> Column:
        rule = F
        for e in use:
            if (c := f(e)) is not None:
                rule = rule.when(own(e), c)
        return rule

    return unprepared(fenced(out, {"doc_type": pick(lambda e: kind_of(e, column))} | {k: pick(lambda e, k=k: e.fields[k](column) if k in e.fields else None) for k in names}), column)


def incomplete(texts: DataFrame, x: str = "text") -> DataFrame:
    """Adds incompleto: the text looks as if some of it were missing, with under 300 characters, or as a slip or invoice without any amount."""
    bare = (F.length(F.coalesce(F.col(x), F.lit(""))) < 300) | ((is_slip(x) | is_product(x)) & (T.money_max(x) == 0))
    return unprepared(fenced(prepared(texts, x), {"incompleto": bare}), x)


from tributary.operators import suppliers as suppliers  # noqa: E402 - completes the registry, which it builds on
