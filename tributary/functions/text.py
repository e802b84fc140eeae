"""Scalar functions over text columns. All are built-in expressions; none calls Python for a row.

Patterns are Unicode-aware and ignore case by (?iu). Where nothing matches the result is null, unless the docstring says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of Brazilian amounts, dates and registration numbers.
MONEY = r"\b(\d{1,3}(?:\.\d{3})*,\d{2})\b"
DATE = r"\b(\d{2})[/\-](\d{2})[/\-](\d{2,4})\b"
CNPJ = r"\b\d{2}\.\d{3}\.\d{3}/\d{4}-\d{2}\b"
CNPJ_LOOSE = r"(?<!\d)(\d{2})\D?(\d{3})\D?(\d{3})\D?(\d{4})\D?(\d{2})(?!\d)"
CPF = r"\b\d{3}\.\d{3}\.\d{3}-\d{2}\b"

# Accented letters and the letters under the accents, and squares that character recognition leaves behind.
ACCENTED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "AAAAAACEEEEIIIINOOOOOUUUUYaaaaaaceeeeiiiinooooouuuuyy"
SQUARES = "□▢■▭▯�"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value evaluated once however often `use` names it, in any branch."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _nonempty(v: Column) -> Column:
    return F.when(v != "", v)


def blank_to_null(x) -> Column:
    """Null for text of white space only."""
    return let(F.trim(_c(x)), _nonempty)


def group(x, pattern: str, n: int = 1) -> Column:
    """Group n of the first match; null without a match or with an empty group."""
    return let(F.regexp_extract(_c(x), pattern, n), _nonempty)


def first_group(x, patterns: list[str], n: int = 1) -> Column:
    """The group of the first pattern, in their order, that matches."""
    return F.coalesce(*[group(x, p, n) for p in patterns])


def any_match(x, patterns: list[str]) -> Column:
    """Whether any pattern matches; false for null."""
    return F.coalesce(_c(x).rlike("(?iu)(?:" + ")|(?:".join(patterns) + ")"), F.lit(False))


def money(x) -> Column:
    """1.234,56 as a number; 0 for anything that isn't one."""
    return F.coalesce(F.replace(F.replace(_c(x), F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double"), F.lit(0.0))


def positive(x) -> Column:
    """1.234,56 as a number; null for 0 and for anything that isn't one."""
    return let(F.replace(F.replace(_c(x), F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double"), lambda v: F.when(v > 0, v))


def first_positive(x, patterns: list[str]) -> Column:
    """The amount of the first pattern, in their order, whose first match isn't 0."""
    return F.coalesce(*[positive(group(x, p)) for p in patterns])


def money_all(x) -> Column:
    """All amounts above 0, in their order."""
    return F.coalesce(F.filter(F.transform(F.regexp_extract_all(_c(x), F.lit(MONEY), F.lit(1)), money), lambda v: v > 0), F.array().cast("array<double>"))


def money_max(x) -> Column:
    """The largest amount, or 0."""
    return F.coalesce(F.array_max(money_all(x)), F.lit(0.0))


def date_br(x) -> Column:
    """dd/MM/yyyy, dd-MM-yyyy or with two digits of the year, as yyyy-MM-dd. Two digits below 69 are of this century."""


    def whole(t: Column) -> Column:
        short = F.concat(F.substring(t, 1, 6), F.when(F.substring(t, 7, 2) < "69", "20").otherwise("19"), F.substring(t, 7, 2))
        return F.when(t.rlike(r"^\d{2}/\d{2}/\d{4}$"), t).when(t.rlike(r"^\d{2}/\d{2}/\d{2}$"), short)

    return F.date_format(F.try_to_date(let(F.replace(F.trim(_c(x)), F.lit("-"), F.lit("/")), whole), "dd/MM/yyyy"), "yyyy-MM-dd")


def date_loose(x) -> Column:
    """d/M/yyyy with one or two digits of day and month, as yyyy-MM-dd."""
    return F.date_format(F.try_to_date(_c(x), "d/M/yyyy"), "yyyy-MM-dd")


def first_date(x) -> Column:
    """The first date in a text, as yyyy-MM-dd."""
    return date_br(group(x, DATE, 0))


def dates_all(x) -> Column:
    """All valid dates in a text, as yyyy-MM-dd, in their order."""
    return F.array_compact(F.transform(F.regexp_extract_all(_c(x), F.lit(DATE), F.lit(0)), date_br))


def email_date(x) -> Column:
    """The date of a message's Date header as yyyy-MM-dd, in the message's own zone: RFC 2822, ISO with T, dd/MM/yyyy or yyyy-MM-dd."""
    t = F.trim(_c(x))
    rfc = F.regexp_extract(t, r"(\d{1,2}\s+[A-Za-z]{3}\s+\d{4})\s+\d{2}:\d{2}", 1)
    rfc = F.try_to_date(F.initcap(F.regexp_replace(F.nullif(rfc, F.lit("")), r"\s+", " ")), "d MMM yyyy")
    iso = F.try_to_date(group(t, r"^(\d{4}-\d{2}-\d{2})(?:T.*)?$"), "yyyy-MM-dd")
    return F.date_format(F.coalesce(rfc, iso, F.try_to_date(group(t, r"^(\d{2}/\d{2}/\d{4})"), "dd/MM/yyyy")), "yyyy-MM-dd")


def digits(x) -> Column:
    """The digits of a text; empty for null."""
    return F.regexp_replace(F.coalesce(_c(x), F.lit("")), r"\D+", "")


def cnpj(x) -> Column:
    """The first formatted registration number."""
    return group(x, CNPJ, 0)


def cpf(x) -> Column:
    """The first formatted personal number."""
    return group(x, CPF, 0)


def cnpj_format(x, otherwise: str = "digits") -> Column:
    """14 digits as 00.000.000/0000-00. Other digit counts stay as digits, or give an empty text with otherwise='empty'."""
    shown = lambda d: F.regexp_replace(d, r"^(\d{2})(\d{3})(\d{3})(\d{4})(\d{2})$", r"$1.$2.$3/$4-$5")
    return let(digits(x), lambda d: F.when(F.length(d) == 14, shown(d)).otherwise(d if otherwise == "digits" else F.lit("")))


def cnpj_flexible(x) -> Column:
    """The first run of 14 digits with any one separator between the groups, formatted."""
    return let(group(x, CNPJ_LOOSE, 0), lambda g: F.when(g.isNotNull(), cnpj_format(g)))


def cnpj_digits(x) -> Column:
    """The digits of a registration number; null unless there are 14."""
    return let(digits(x), lambda d: F.when(F.length(d) == 14, d))


def cnpjs_all(x) -> Column:
    """All registration numbers of a text as 14 digits, in their order."""
    return F.transform(F.regexp_extract_all(_c(x), F.lit(CNPJ_LOOSE), F.lit(0)), digits)


def is_cnpj(x) -> Column:
    """Whether the digits are 14; check digits aren't verified."""
    return F.length(digits(x)) == 14


def is_cpf(x) -> Column:
    return F.length(digits(x)) == 11


def domains_all(x) -> Column:
    """The distinct domains of addresses and links in a text, in lower case, without www."""
    t = F.lower(F.coalesce(_c(x), F.lit("")))
    mail = F.regexp_extract_all(t, F.lit(r"[a-z0-9._%+-]+@([a-z0-9.-]+\.[a-z]{2,})"), F.lit(1))
    link = F.regexp_extract_all(t, F.lit(r"https?://(?:www\.)?([a-z0-9.-]+\.[a-z]{2,})"), F.lit(1))
    return F.array_distinct(F.concat(mail, link))


def strip_accents(x) -> Column:
    """Letters without their accents; empty for null."""
    return F.translate(F.coalesce(_c(x), F.lit("")), ACCENTED, PLAIN)


def compact(x) -> Column:
    """Upper-case letters and digits only, without accents."""
    return F.regexp_replace(F.upper(strip_accents(x)), "[^A-Z0-9]+", "")


def spaces(x) -> Column:
    """Tabs and fixed spaces as spaces, runs of them as one, none at the ends; empty for null."""
    return F.trim(F.regexp_replace(F.translate(F.coalesce(_c(x), F.lit("")), " \t", "  "), " +", " "))


def ready(x) -> Column:
    """Text as the extractors want it: plain hyphens, no marks of failed character recognition, single spaces."""
    t = F.translate(F.coalesce(_c(x), F.lit("")), "­–—Êê " + SQUARES, "---   " + " " * len(SQUARES))
    return F.regexp_replace(t, "[ \t]+", " ")


def entity_name(x) -> Column:
    """A name without registration numbers, document numbers and punctuation at its ends; empty for null."""
    t = F.regexp_replace(F.trim(F.coalesce(_c(x), F.lit(""))), r"\s+", " ")
    t = reduce(lambda a, p: F.regexp_replace(a, p, " "), [CNPJ, CPF, r"\b\d+[\./]\d+\b", r"\b\d{4,}\b"], t)
    t = F.regexp_replace(F.translate(t, "Êê" + SQUARES, " " * (2 + len(SQUARES))), r"\s+", " ")
    return F.regexp_replace(t, r"^[\s\-:;]+|[\s\-:;]+$", "")


# Labels that extraction leaves before a supplier's name.
LABELS = ["CNPJ", "CPF", "RAZÃO SOCIAL", "RAZAO SOCIAL", "NOME:"]


def supplier_name(x, more_labels: tuple[str, ...] = (), upper: bool = False) -> Column:
    """A supplier's name with single spaces and without a leading label and its colon or hyphen; empty for null."""
    t = F.trim(F.regexp_replace(F.coalesce(_c(x), F.lit("")), r"\s+", " "))
    for label in [*LABELS, *more_labels]:
        t = F.regexp_replace(t, rf"(?iu)^\Q{label}\E\s*[:\-]?\s*", "")
    return F.upper(t) if upper else t


def html_text(x) -> Column:
    """The text of a page: without scripts, styles and tags, with single spaces; empty for null."""
    t = F.regexp_replace(F.coalesce(_c(x), F.lit("")), r"(?is)<(script|style)\b.*?</\1>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"(?s)<[^>]*>", " "), r"[ \n\t]+", " "))


def company_code(x) -> Column:
    """The first token of 2 to 15 letters or digits outside parentheses, in upper case."""
    return F.upper(group(F.regexp_replace(strip_accents(x), r"\([^)]*\)", " "), r"\b([A-Za-z0-9]{2,15})\b"))


def file_name(x, most: int = 200) -> Column:
    """A name that file systems take: <>:\"/\\|?* become _, and the stem is cut so that the whole has at most `most` characters."""
    t = F.regexp_replace(_c(x), r'[<>:"/\\|?*]', "_")
    ext = F.regexp_extract(t, r"(\.[^.]*)$", 1)
    return F.when(F.length(t) <= most, t).otherwise(F.concat(F.substr(t, F.lit(1), most - F.length(ext)), ext))


def money_text(cents: Column) -> Column:
    """Integer cents as 1.234,56."""
    return F.concat(F.replace(F.format_number(F.floor(cents / 100), 0), F.lit(","), F.lit(".")), F.lit(","), F.lpad((cents % 100).cast("string"), 2, "0"))


def normalized_number(x) -> Column:
    """The part of a document number that counts: without prefix, year and leading zeros. Empty for null."""
    zeros = lambda v: let(F.regexp_replace(v, "^0+", ""), lambda z: F.when(z != "", z).otherwise("0"))
    year = lambda v: F.when(v.rlike(r"^20(2\d|30)"), zeros(F.substr(v, F.lit(5), F.length(v)))).otherwise(v)

    def counted(t: Column) -> Column:
        return (
            F.when(t.rlike(r"\d{4}[./\-]\d+$"), zeros(F.regexp_extract(t, r"\d{4}[./\-](\d+)$", 1)))
            .when(t.rlike(r"^\d{9,}$"), let(F.regexp_replace(t, "^0+", ""), year))
            .when(t.rlike(r"^\d+$"), zeros(t))
            .otherwise(t)
        )

    return let(F.regexp_replace(F.trim(F.coalesce(_c(x), F.lit(""))), r"(?iu)^(NF|NFSE|NFE|NOTA)[_\s\-]*", ""), counted)


def same_number(a, b) -> Column:
    """Whether two normalized numbers are equal, or one ends in the other once leading zeros are gone."""
    a, b = _c(a), _c(b)
    x, y = (F.coalesce(F.nullif(F.regexp_replace(v, "^0+", ""), F.lit("")), F.lit("0")) for v in (a, b))
    return F.coalesce((a != "") & (b != "") & (F.endswith(x, y) | F.endswith(y, x)), F.lit(False))


# Where a document's number stands in a file name.
FILE_NUMBERS = [r"NF[_\s\-]*(\d{4}[\.\/\-]\d+)", r"NF[_\s\-]*(\d+)", r"nfse[_\-]*(\d+)", r"[Nn]ota[_\s\-]*[Ff]iscal[_\s\-]*(\d+)", r"BOLETO[_\s\-]*NF[_\s\-]*(\d{4}[\.\/\-]\d+)", r"BOLETO[_\s\-]*NF[_\s\-]*(\d+)"]


def number_in_file_name(x) -> Column:
    """The document number that a file name holds."""
    return F.coalesce(*[group(x, "(?iu)" + p) for p in FILE_NUMBERS])


def iso_date(x) -> Column:
    """d/m/yyyy with /, - or . as yyyy-MM-dd; any other text as it is."""
    t = F.trim(_c(x))
    p = r"^(\d{1,2})[/\-.](\d{1,2})[/\-.](\d{4})$"
    return F.when(t.rlike(p), F.concat_ws("-", F.regexp_extract(t, p, 3), F.lpad(F.regexp_extract(t, p, 2), 2, "0"), F.lpad(F.regexp_extract(t, p, 1), 2, "0"))).otherwise(_c(x))
