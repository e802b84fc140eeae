"""Which of our companies a text names, and which supplier it comes from. The dimension is given by the caller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions import text as T

#: The dimension is broadcast; a table of more companies than this is refused.
MOST_COMPANIES = 20_000


def dimension(companies: DataFrame) -> DataFrame:
    """(cnpj_digits, razao_social, codigo, ordinal) of (cnpj, razao_social, ordinal), with its size checked for a broadcast."""
    if companies.limit(MOST_COMPANIES + 1).count() > MOST_COMPANIES:
        raise ValueError(f"over {MOST_COMPANIES} companies")
    return F.broadcast(companies.select(T.digits("cnpj").alias("cnpj_digits"), "razao_social", T.company_code("razao_social").alias("codigo"), "ordinal"))


def _cnpjs(texts: DataFrame, key: str, column: str) -> DataFrame:
    return texts.select(key, F.col(column).alias("_t"), F.posexplode(T.cnpjs_all(column)).alias("_pos", "cnpj_digits"))


# Words before a registration number that make its owner the payer, or not.
PAYER_WORDS, PAYEE_WORDS = r"TOMADOR|PAGADOR|SACADO|DESTINAT|CLIENTE", r"PRESTADOR|BENEFICI|CEDENTE|EMITENTE|FORNECEDOR"


def by_cnpj(texts: DataFrame, companies: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, razao_social, codigo, score): the company whose number stands in the best context; the first, in a tie."""
    found = _cnpjs(texts, key, column).join(dimension(companies), "cnpj_digits")
    nth = F.regexp_extract_all("_t", F.lit(rf"(?s)(.{{0,125}}?){T.CNPJ_LOOSE}"), F.lit(1))  # what stands before each number, back to the one before it
    shown = F.upper(F.get(nth, F.col("_pos")))
    score = F.lit(10) + F.when(shown.rlike(PAYER_WORDS), 3).otherwise(0) - F.when(shown.rlike(PAYEE_WORDS), 3).otherwise(0)
    ranked = found.withColumn("score", score)
    return ranked.groupBy(key).agg(F.max_by(F.struct("razao_social", "codigo", "score"), F.struct("score", -F.col("_pos"))).alias("x")).select(key, "x.*")


def by_code(texts: DataFrame, companies: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, razao_social, codigo): the first company of the table whose code is a word of the text. Words meet codes in an equi-join."""
    words = texts.select(key, F.explode(F.array_distinct(F.split(F.upper(T.strip_accents(column)), "[^A-Z0-9]+"))).alias("codigo")).filter("length(codigo) >= 2")
    found = words.join(dimension(companies), "codigo")
    return found.groupBy(key).agg(F.min_by(F.struct("razao_social", "codigo"), "ordinal").alias("x")).select(key, "x.*")


def by_domain(texts: DataFrame, companies: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, razao_social, codigo, score): the company whose code is a label of a domain in the text; longer codes score more."""
    labels = texts.select(key, F.explode(T.domains_all(column)).alias("d")).select(key, F.explode(F.split(F.upper("d"), r"[.\-]")).alias("codigo")).filter("length(codigo) >= 2")
    found = labels.join(dimension(companies), "codigo").withColumn("score", F.lit(7) + F.least(F.lit(3), F.length("codigo")))
    return found.groupBy(key).agg(F.max_by(F.struct("razao_social", "codigo", "score"), F.struct("score", -F.col("ordinal"))).alias("x")).select(key, "x.*")


def matched(texts: DataFrame, companies: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, razao_social, codigo, method): by number, else by code, else by domain."""
    tries = [by_cnpj(texts, companies, key, column).withColumn("method", F.lit("cnpj")).withColumn("_m", F.lit(0)), by_code(texts, companies, key, column).withColumn("method", F.lit("codigo")).withColumn("_m", F.lit(1)), by_domain(texts, companies, key, column).withColumn("method", F.lit("dominio")).withColumn("_m", F.lit(2))]
    every = tries[0].select(key, "razao_social", "codigo", "method", "_m")
    for t in tries[1:]:
        every = every.unionByName(t.select(key, "razao_social", "codigo", "method", "_m"))
    return every.groupBy(key).agg(F.min_by(F.struct("razao_social", "codigo", "method"), "_m").alias("x")).select(key, "x.*")


def ours(df: DataFrame, companies: DataFrame, column: str = "cnpj") -> DataFrame:
    """The rows whose registration number is a company's."""
    return df.withColumn("cnpj_digits", T.cnpj_digits(column)).join(dimension(companies).select("cnpj_digits"), "cnpj_digits", "left_semi")


def first_foreign_cnpj(texts: DataFrame, companies: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, cnpj_digits): the first registration number of a text that is no company's."""
    left = _cnpjs(texts, key, column).join(dimension(companies), "cnpj_digits", "left_anti")
    return left.groupBy(key).agg(F.min_by("cnpj_digits", "_pos").alias("cnpj_digits"))


def inferred_supplier(texts: DataFrame, companies: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, fornecedor): of the lines with a foreign number, the name on the best one, or on the line before it.

    A legal form in the name gives 2, a supplier's label on the line before 1; the first line wins a tie.
    """
    rows = texts.select(key, F.posexplode(F.split(F.coalesce(F.col(column), F.lit("")), "\n")).alias("_pos", "_l"))
    rows = rows.withColumn("_before", F.lag("_l").over(Window.partitionBy(key).orderBy("_pos"))).withColumn("cnpj_digits", T.digits(T.group("_l", T.CNPJ_LOOSE, 0)))
    rows = rows.filter("length(cnpj_digits) = 14").join(dimension(companies), "cnpj_digits", "left_anti")
    own = T.entity_name(F.regexp_replace(F.regexp_replace("_l", r"(?iu)\b(CPF/)?CNPJ\b.*$", ""), r"(?iu)^\s*(benefici[áa]rio|cedente|prestador|fornecedor|emitente)\s*:?", ""))
    name = F.when(F.length(own) >= 5, own).otherwise(T.entity_name("_before"))
    score = F.when(F.upper(name).rlike(r"\b(LTDA|S/?A|EIRELI|ME|EPP)\b"), 2).otherwise(0) + F.when(F.upper("_before").rlike(PAYEE_WORDS), 1).otherwise(0)
    good = rows.withColumn("fornecedor", name).withColumn("_s", score).filter("length(fornecedor) >= 5")
    return good.groupBy(key).agg(F.max_by("fornecedor", F.struct("_s", -F.col("_pos"))).alias("fornecedor"))


# Links, attributes and domains that say nothing about the company an e-mail is for, and words too common to be codes.
TRACKING = [r"https?://click\.[^\s]+", r"https?://track\.[^\s]+", r"https?://[^\s]*\.cdn\.[^\s]+", r"https?://cdn\.[^\s]+", r"https?://[^\s]+/track/[^\s]+", r"https?://[^\s]+/click/[^\s]+", r'href="[^"]*"', r'src="[^"]*"']
OWN_DOMAINS = ["soumaster.com.br", "soumaster.com", "gmail.com", "outlook.com", "hotmail.com", "yahoo.com", "yahoo.com.br"]
COMMON_WORDS = [
    "SERVICO", "SERVICOS", "SERVICE", "CONSULTORIA", "GESTAO", "INTEGRADA", "COMERCIO", "INDUSTRIA", "TECNOLOGIA", "SOLUCOES", "SISTEMA", "SISTEMAS", "EMPRESA", "EMPRESAS", "ADMINISTRACAO", "ADMINISTRADORA",
    "PARTICIPACOES", "SOCIETARIAS", "GRUPO", "HOLDING", "COMPANHIA", "CIA", "LTDA", "SA", "S/A", "EIRELI", "EPP", "ME", "PROVEDOR", "ACESSO", "INTERNET", "TELECOM", "TELECOMUNICACOES", "COMUNICACAO", "MATRIZ", "FILIAL",
    "BRASIL", "BRASILEIRA", "REDE", "CLICK", "TRACK", "VIEW", "OPEN", "LINK", "HTTP", "HTTPS", "WWW", "STYLE", "WIDTH", "HEIGHT", "FONT", "ALIGN", "CENTER", "LEFT", "RIGHT", "VISTA", "ALEGRE", "PAULO", "SAO",
]
# What stands on a line before the company that an e-mail is for, and before one that only a password names.
SAFE_CONTEXT, IGNORED_CONTEXT = r"Para:|To:|Tomador[:\s]|Destinat[áa]rio[:\s]|Cliente[:\s]", r"frase\s+de\s+seguran[çc]a[^:]*:|senha[^:]*:|password[^:]*:|security\s+phrase[^:]*:"


def without_noise(x: str) -> Column:
    """A text without tracking links, own domains, styles and scripts."""
    t = F.regexp_replace(F.coalesce(F.col(x), F.lit("")), "(?iu)" + "|".join(TRACKING), " ")
    for d in sorted(OWN_DOMAINS, key=len, reverse=True):
        t = F.regexp_replace(t, rf"(?iu)[a-z0-9._%+-]*@\Q{d}\E|https?://[^\s]*\Q{d}\E[^\s]*|\b\Q{d}\E\b", " ")
    return F.regexp_replace(t, r"(?is)<(style|script)\b.*?</\1>", " ")


def in_email(texts: DataFrame, companies: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, codigos, codigo, method): the companies that an e-mail names, and the one it is for.

    A registration number decides. Else it is the first company, in the table's order, on a line that names a recipient; else the
    only one that the text names outside a password's line. codigos are all codes found. Lines meet codes in an equi-join on words.
    """
    clean = texts.select(key, without_noise(column).alias("_t"))
    rows = clean.select(key, F.posexplode(F.split(F.upper("_t"), "\n")).alias("_line", "_s"))
    # of a label in the line, what follows it; else the whole line counts as neither safe nor ignored
    safe, ignored = T.group("_s", rf"(?iu)(?:{SAFE_CONTEXT})(.*)"), T.group("_s", rf"(?iu)(?:{IGNORED_CONTEXT})(.*)")
    words = lambda c: F.array_distinct(F.split(T.strip_accents(c), "[^A-Z0-9]+"))
    rows = rows.select(key, F.explode(words(F.col("_s"))).alias("codigo"), words(safe).alias("_safe"), words(ignored).alias("_ignored")).filter((F.length("codigo") >= 3) & ~F.col("codigo").isin(COMMON_WORDS))
    found = rows.join(dimension(companies).groupBy("codigo").agg(F.min("ordinal").alias("ordinal")), "codigo")
    found = found.groupBy(key, "codigo", "ordinal").agg(F.max(F.array_contains("_safe", F.col("codigo"))).alias("safe"), F.max(F.array_contains("_ignored", F.col("codigo"))).alias("ignored"))
    got = found.groupBy(key).agg(
        F.array_sort(F.collect_set("codigo")).alias("codigos"), F.min_by(F.when(F.col("safe"), F.col("codigo")), F.when(F.col("safe"), F.col("ordinal"))).alias("_safe"),
        F.collect_set(F.when(~F.col("safe") & ~F.col("ignored"), F.col("codigo"))).alias("_plain"),
    )
    by_number = by_cnpj(clean, companies, key, "_t").select(key, F.col("codigo").alias("_number"))
    out = got.join(by_number, key, "full").withColumn("_name", F.coalesce("_safe", F.when(F.size("_plain") == 1, F.get("_plain", F.lit(0)))))
    method = F.when(F.col("_number").isNotNull(), "cnpj").when(F.col("_name").isNotNull(), "nome_exato")
    return out.select(key, F.coalesce("codigos", F.array("_number")).alias("codigos"), F.coalesce("_number", "_name").alias("codigo"), method.alias("method"))


def cnpj_by_code(df: DataFrame, companies: DataFrame, code: str = "empresa") -> DataFrame:
    """Adds empresa_cnpj: the number of the first company, in the table's order, whose name has the code as a word."""
    known = dimension(companies).select(F.explode(F.array_distinct(F.split(F.upper(T.strip_accents("razao_social")), "[^A-Z0-9]+"))).alias("_w"), "cnpj_digits", "ordinal")
    first = known.groupBy("_w").agg(F.min_by("cnpj_digits", "ordinal").alias("empresa_cnpj"))
    return df.join(first, F.upper(df[code]) == F.col("_w"), "left").drop("_w")


#: The bank dimension is broadcast; codes have three digits.
MOST_BANKS = 1000


def bank_names(df: DataFrame, banks: DataFrame, code: str = "codigo_banco") -> DataFrame:
    """Adds banco by code; BANCO_code for a code without a name. banks: (codigo, nome), a table of more than a thousand is refused."""
    if banks.limit(MOST_BANKS + 1).count() > MOST_BANKS:
        raise ValueError(f"over {MOST_BANKS} banks")
    dim = F.broadcast(banks.select(F.col("codigo").alias("_c"), F.col("nome").alias("_n")))
    return df.join(dim, df[code] == F.col("_c"), "left").withColumn("banco", F.coalesce("_n", F.concat(F.lit("BANCO_"), F.col(code)))).drop("_c", "_n")


def supplier_repair(text: str = "text") -> Column:
    """(sugestao, confianca): a label's name at 0.8, a line with a legal form at 0.6, the first long line at 0.4."""
    label = T.entity_name(T.first_group(text, [r"(?imu)^\s*(?:Raz[ãa]o\s+Social|Benefici[áa]rio|Fornecedor)\s*:\s*([^\n]+)"]))
    legal = T.entity_name(T.group(text, r"(?mu)^\s*([^\n]*\b(?:LTDA|EIRELI|S/A)\b)"))
    line = T.entity_name(T.group(text, r"(?m)^\s*([^\n]{10,})$"))
    good = lambda c: F.length(c) >= 5
    return F.struct(F.coalesce(F.when(good(label), label), F.when(good(legal), legal), F.when(good(line), line)).alias("sugestao"), F.when(good(label), 0.8).when(good(legal), 0.6).when(good(line), 0.4).otherwise(0.0).alias("confianca"))
