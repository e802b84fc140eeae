"""Invoices in XML, in four dialects. Namespaces are cut first; a malformed document gives nulls and an error, it never fails the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions import text as T

# What each dialect holds, and how many of it must be there; the order decides.
DIALECTS = [
    ("NFSE_SPED", 2, [r"<infNFSe\s", r"<nNFSe>", r"<nDFSe>", r"<DPS\s", r"<infDPS\s", r"<toma>", r"<prest>"]),
    ("NFSE_SIGISS", 3, [r"<NumeroNFe>", r"<InscricaoPrestador>", r"<CPFCNPJPrestador>", r"<TributacaoNFe>", r"<StatusNFe>", r"<ChaveNFe>", r"<RazaoSocialPrestador>"]),
    ("NFE", 1, [r"<nfeProc", r"<infNFe", r"portalfiscal\.inf\.br/nfe", r"<mod>55</mod>"]),
    ("NFSE", 1, [r"<CompNfse", r"<Nfse>", r"<InfNfse", r"<ListaNfse", r"<ConsultarNfseResposta", r"abrasf\.org\.br", r"<Rps>", r"<InfRps", r"nfse\.xsd", r"<NumeroNfse", r"<PrestadorServico", r"<TomadorServico"]),
]

# The elements that hold each field; the first that isn't empty counts.
FIELDS = {
    "NFE": {"numero_nota": ["nNF"], "serie_nf": ["serie"], "cnpj": ["emit/CNPJ"], "fornecedor_nome": ["emit/xNome"], "valor": ["vNF"], "data_emissao": ["dhEmi", "dEmi"], "vencimento": ["dup/dVenc"], "chave_acesso": ["chNFe"]},
    "NFSE": {"numero_nota": ["InfNfse/Numero", "Numero"], "cnpj": ["PrestadorServico//Cnpj", "Prestador//Cnpj"], "fornecedor_nome": ["PrestadorServico/RazaoSocial", "RazaoSocial"], "valor": ["ValorServicos", "ValorLiquidoNfse"], "data_emissao": ["DataEmissao"], "valor_iss": ["ValorIss"]},
    "NFSE_SPED": {"numero_nota": ["nNFSe"], "cnpj": ["emit/CNPJ", "prest/CNPJ"], "fornecedor_nome": ["emit/xNome", "prest/xNome"], "valor": ["vLiq", "vServ"], "data_emissao": ["dhEmi", "dhProc"]},
    "NFSE_SIGISS": {"numero_nota": ["NumeroNFe"], "cnpj": ["CPFCNPJPrestador//CNPJ", "CPFCNPJPrestador"], "fornecedor_nome": ["RazaoSocialPrestador"], "valor": ["ValorServicos"], "data_emissao": ["DataEmissaoNFe"], "valor_iss": ["ValorISS"]},
}

# Codes of means of payment.
PAYMENT = {"01": "DINHEIRO", "02": "CHEQUE", "03": "CARTAO CREDITO", "04": "CARTAO DEBITO", "15": "BOLETO", "16": "DEPOSITO", "17": "PIX", "18": "TRANSFERENCIA", "90": "SEM PAGAMENTO", "99": "OUTROS"}


def dialect(x: str = "xml") -> Column:
    """The first dialect that a text has enough marks of; null without one."""
    score = lambda ps: sum((F.coalesce(F.col(x).rlike("(?isu)" + p), F.lit(False)).cast("int") for p in ps), F.lit(0))
    return F.coalesce(*[F.when(score(ps) >= n, F.lit(name)) for name, n, ps in DIALECTS])


# The named references of XML; the ampersand comes last, so that what it leaves isn't read again.
REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&"}
_CDATA = r"<!\[CDATA\[(?s:(.*?))\]\]>"


def decoded(v: Column) -> Column:
    """An element's text with its references resolved; a CDATA section stands as it is."""

    def resolve(t: Column) -> Column:
        plain = t
        for ref, char in REFERENCES.items():
            plain = F.replace(plain, F.lit(ref), F.lit(char))
        return F.when(t.contains("<![CDATA["), F.regexp_replace(t, _CDATA, "$1")).when(t.contains("&"), plain).otherwise(t)

    return T.let(v, resolve)


def element(x: Column, path: str) -> Column:
    """The text of the first element at the path: a/b is b somewhere under a. Read by patterns, so a broken end of a document does no harm."""
    parts = [p for p in path.split("/") if p]
    for p in parts[:-1]:
        x = F.regexp_extract(x, rf"(?s)<{p}(?:\s[^>]*)?>(.*?)</{p}>", 1)
    return T.blank_to_null(decoded(F.regexp_extract(x, rf"(?s)<{parts[-1]}(?:\s[^>]*)?>((?:[^<]|<!\[CDATA\[.*?\]\]>)*+)</{parts[-1]}>", 1)))


def without_namespaces(x: str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.col(x), r"\sxmlns(:\w+)?=\"[^\"]*\"", ""), r"(</?)\w+:", "$1")


def payment_name(code: str | Column) -> Column:
    c = F.col(code) if isinstance(code, str) else code
    return F.coalesce(*[F.when(c == k, v) for k, v in PAYMENT.items()], F.concat(F.lit("CODIGO_"), c))


def parsed(docs: DataFrame, column: str = "xml") -> DataFrame:
    """Adds dialect, doc_type, the fields and _error."""
    flat, kind = without_namespaces(column), dialect(column)
    names = list(dict.fromkeys(k for f in FIELDS.values() for k in f))
    out = docs.withColumn("dialect", kind).withColumn("_flat", flat)
    for k in names:
        per = [F.when(F.col("dialect") == d, F.coalesce(*[element(F.col("_flat"), p) for p in f[k]])) for d, f in FIELDS.items() if k in f]
        v = F.coalesce(*per)
        if k.startswith("valor"):
            v = v.try_cast("double")
        elif k in ("data_emissao", "vencimento"):
            v = F.coalesce(F.date_format(F.try_to_date(F.substring(v, 1, 10), "yyyy-MM-dd"), "yyyy-MM-dd"), T.date_br(F.substring(v, 1, 10)))
        out = out.withColumn(k, v)
    whole = F.regexp_extract(F.trim(F.col("_flat")), r"(?s)^(?:<\?[^>]*\?>\s*)?<([A-Za-z]\w*)[^>]*>.*</\1>\s*$", 1) != ""
    error = F.when(F.col("dialect").isNull(), "unknown dialect").when(~whole, "malformed document").when(F.col("numero_nota").isNull(), "no number")
    return out.withColumn("doc_type", F.when(F.col("dialect") == "NFE", "DANFE").when(F.col("dialect").isNotNull(), "NFSE")).withColumn("_error", error).drop("_flat")
