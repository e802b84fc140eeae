"""E-mail rules: the decision whether to process, content types, administrative subjects, links and codes, fields of a body."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions import text as T

# Subjects, senders and extensions that decide. All patterns ignore case.
SUBJECT_BLACKLIST = [
    r"\b(feliz\s+)?(natal|ano\s*novo|páscoa|festas)\b", r"\bcomunicado\b", r"\b(horário|funcionamento|expediente)\b", r"\bnews(letter)?\b", r"\bnotícias\b", r"\bconfira\b",
    r"^(re|res|fw|fwd|enc):\s*(re|res|fw|fwd|enc):", r"\b(promoção|oferta|desconto)\b", r"\binscreva-?se\b", r"\bimpactar\s+seu\s+negócio\b", r"\bnotificação\s+de\s+regularização\b",
    r"\baviso\s+de\s+vencimento\b", r"\blembrete\s+aci\b", r"\bpré[\s-]?cobrança\b", r"\bajuste\s+(de\s+)?nf\b", r"\bdistrato\b",
]
SUBJECT_WHITELIST = [
    r"\bnota\s*fiscal\b", r"\bnf[\s-]?e\b", r"\bnf[\s-]?s[\s-]?e\b", r"\bnfcom\b", r"\bdanfe\b", r"\bfatura\b", r"\bboleto\b", r"\bcobrança\b", r"\bpagamento\b", r"\bvencimento\b", r"\bdébito\b", r"\bdívida\b",
    r"\brenovação\b", r"\bcontrato\b", r"\bmensalidade\b", r"\bassinatura\b", r"\baluguel\b", r"\b(energia|luz|cemig|edp|conta\s+de\s+luz)\b", r"\b(telecom|internet|fibra)\b", r"\benvio\s+de\b",
    r"\bsua\s+(fatura|conta|nf)\b", r"\bfaturamento\b", r"\bdocumento\b",
]
SENDER_BLACKLIST = [
    r"@(mail\.)?mailchimp\.com$", r"@(mail\.)?sendgrid\.(net|com)$", r"@(email\.)?hubspot\.com$", r"@(mail\.)?rdstation\.com\.br$", r"@(e\.)?mailjet\.com$", r"noreply@.*\.marketing\.", r"newsletter@", r"marketing@",
    r"promocoes@", r"ofertas@", r"@.*\.slack\.com$", r"@.*\.atlassian\.(com|net)$", r"@github\.com$", r"@linkedin\.com$", r"@facebookmail\.com$", r"@.*zendesk\.com$", r"@freshdesk\.com$",
]
SENDER_WHITELIST = [
    r"@.*nfe\.fazenda\.gov\.br$", r"@.*\.gov\.br$", r"@.*sefaz.*\.gov\.br$", r"@.*prefeitura.*\.gov\.br$", r"@.*omie\.com\.br$", r"@.*bling\.com\.br$", r"@.*tiny\.com\.br$", r"@.*contaazul\.com$",
    r"@.*enotas\.com\.br$", r"@.*nfe\.io$", r"@.*plugnotas\.com\.br$", r"@.*tecnospeed\.com\.br$", r"@.*totvs\.com\.br$", r"@.*sankhya\.com\.br$", r"@.*senior\.com\.br$", r"@.*cemig\.com\.br$",
    r"@.*cpfl\.com\.br$", r"@.*copel\.com$", r"@.*sabesp\.com\.br$", r"@.*vivo\.com\.br$", r"@.*claro\.com\.br$", r"@.*tim\.com\.br$", r"faturamento@", r"cobranca@", r"financeiro@", r"nfe@", r"nfse@", r"notafiscal@", r"boleto@",
]
EXTENSIONS = [".pdf", ".xml", ".zip", ".rar", ".7z"]


def first_pattern(x, patterns: list[str]) -> Column:
    """The first pattern of the list that matches."""
    return F.coalesce(*[F.when(F.col(x).rlike("(?iu)" + p), F.lit(p)) for p in patterns])


def first_hit(x, patterns: list[str]) -> Column:
    """The text that the first matching pattern of the list finds."""
    return F.coalesce(*[F.regexp_substr(F.col(x), F.lit("(?iu)" + p)) for p in patterns])


def all_hits(x, patterns: list[str]) -> Column:
    """What each pattern finds first, in the order of the list."""
    return F.array_compact(F.array(*[F.regexp_substr(F.col(x), F.lit("(?iu)" + p)) for p in patterns]))


def has_valid_attachment(x="attachments") -> Column:
    """Whether a name in the list ends in an extension that counts; null for a null list."""
    return F.exists(x, lambda f: F.concat(F.lit("."), F.lower(F.substring_index(f, ".", -1))).isin(EXTENSIONS) & f.contains("."))


def decided(emails: DataFrame, blacklist: tuple[str, ...] = (), whitelist: tuple[str, ...] = (), sender_blacklist: tuple[str, ...] = (), sender_whitelist: tuple[str, ...] = ()) -> DataFrame:
    """Adds decision, blacklist_match and whitelist_matches; the first rule that holds decides. The tuples are added to the lists.

    A list of attachments overrides the flag has_attachment.
    """
    attached = F.coalesce(has_valid_attachment(), F.col("has_attachment"), F.lit(False))
    bad_sender = T.any_match("sender_address", [*SENDER_BLACKLIST, *sender_blacklist])
    bad_subject = first_hit("subject", [*SUBJECT_BLACKLIST, *blacklist])
    hits = F.coalesce(all_hits("subject", [*SUBJECT_WHITELIST, *whitelist]), F.array().cast("array<string>"))
    content = F.coalesce(F.col("has_links_nfe"), F.lit(False)) | F.coalesce(F.col("has_verification_code"), F.lit(False))
    decision = (
        F.when(~attached & bad_sender, "SKIP_SENDER_BLACKLIST")
        .when(attached, "PROCESS")
        .when(bad_subject.isNotNull(), "SKIP_BLACKLIST")
        .when(~content, "SKIP_NO_CONTENT")
        .when((F.size(hits) > 0) | T.any_match("sender_address", [*SENDER_WHITELIST, *sender_whitelist]), "PROCESS")
        .otherwise("SKIP_NO_SUBJECT_MATCH")
    )
    return emails.withColumn("decision", decision).withColumn("blacklist_match", F.when(F.col("decision") == "SKIP_BLACKLIST", bad_subject)).withColumn("whitelist_matches", F.when((F.col("decision") == "PROCESS") & ~attached, hits))


def decision_counts(emails: DataFrame) -> DataFrame:
    return decided(emails).groupBy("decision").agg(F.count("*").alias("emails"))


def content_type(attached="has_attachment", links="has_links_nfe", code="has_verification_code") -> Column:
    """ATTACHMENT, LINK_CODE, LINK, CODE or NONE."""
    return F.when(F.col(attached), "ATTACHMENT").when(F.col(links) & F.col(code), "LINK_CODE").when(F.col(links), "LINK").when(F.col(code), "CODE").otherwise("NONE")


# Subjects of administrative documents, and the label of the first key that a subject holds.
ADMIN_SUBJECTS = [
    r"\b(sua\s+)?ordem\b.*\bagendad[ao]\b", r"\bagendamento\s+de\s+serviço\b", r"\bdistrato\b", r"\brescis[ãa]o\s*(contratual)?\b", r"\bencerramento\s+(de\s+)?contrato\b", r"\bsolicitação\s+de\s+encerramento\b",
    r"\bcancelamento\s+(de\s+)?contrato\b", r"\brelat[oó]rio\s+de\s+faturamento\b", r"\bplanilha\s+de\s+(confer[eê]ncia|faturamento)\b", r"\bcomprovante\s+de\s+solicitação\b", r"\bnotificação\s+automática\b",
    r"\bguia\s*[\|\-]?\s*(processo|execu[çc][aã]o|fiscal|trabalhist|rr)\b", r"\bguias\s*-?\s*(csc|processo)\b", r"\bcontrato(_|\s+)(site|master|renova[çc][aã]o|aditivo)\b",
    r"\bc[aâ]mbio\s+(hbo|globosat|band|sbt|record|programadora)\b", r"\blembrete\s+gentil\b", r"\b(december|january|february|march|april|may|june|july|august|september|october|november)\s*-?\s*\d{4}\s+invoice\s+for\b",
    r"\b(processo|execu[çc][aã]o)\s+(fiscal|trabalhist[ao]|judicial)\b", r"\banuidade\s+(crea|oab|crm|cfm|coren)\b", r"\breembolso\s+de\s+tarifas\b", r"\btarifas\s+csc\b", r"\bcobran[çc]a\s+indevida\b",
]
ADMIN_LABELS = {
    "ordem": "Ordem de serviço/agendamento", "agendamento": "Ordem de serviço/agendamento", "distrato": "Documento de distrato", "rescis": "Documento de rescisão contratual", "encerramento": "Documento de encerramento de contrato",
    "cancelamento": "Documento de cancelamento", "relatório": "Relatório/planilha de conferência", "relatorio": "Relatório/planilha de conferência", "planilha": "Relatório/planilha de conferência", "comprovante": "Comprovante administrativo",
    "notificação": "Notificação automática", "guia": "Guia jurídica/fiscal", "contrato_": "Documento de contrato", "contrato ": "Documento de contrato", "câmbio": "Documento de programação/câmbio", "cambio": "Documento de programação/câmbio",
    "lembrete": "Lembrete administrativo", "invoice": "Invoice internacional", "processo": "Processo jurídico", "execução": "Execução fiscal/judicial", "execucao": "Execução fiscal/judicial", "anuidade": "Taxa/anuidade de órgão",
    "reembolso": "Reembolso interno", "tarifa": "Documento de tarifas internas", "cobrança indevida": "Reclamação de cobrança", "cobranca indevida": "Reclamação de cobrança",
}


def admin_label(x="subject") -> Column:
    """The label of an administrative subject."""
    label = F.coalesce(*[F.when(F.lower(x).contains(k), v) for k, v in ADMIN_LABELS.items()], F.lit("Documento administrativo"))
    return F.when(T.any_match(x, ADMIN_SUBJECTS), label)


# Links that lead to an invoice, and words before a code.
LINK_PATTERNS = [
    r"nf[es]?\.", r"nota[^\s]*fiscal", r"danfe", r"sefaz", r"prefeitura", r"\.gov\.br", r"pmf\.", r"issqn", r"iss[.\-]", r"nfse", r"ginfes", r"abrasf", r"webiss", r"tributosmunicipais", r"tributos\.",
    r"\.omie\.com", r"\.bling\.com", r"\.tiny\.com", r"\.conta\.azul", r"\.nibo\.com", r"\.enotas\.com", r"\.nfe\.io", r"\.focusnfe\.com", r"\.webmaniabr\.com", r"\.plugnotas\.com", r"\.tecnospeed\.com", r"\.senior\.com", r"\.totvs\.com", r"\.sankhya\.com",
    r"click\.[^\s]+/track", r"\.rdstation\.com", r"\.mailchimp\.com", r"sendgrid\.", r"/consulta[^\s]*nf", r"/download[^\s]*xml", r"/validar", r"/verificar", r"2via", r"fatura", r"conta[^\s]*digital", r"boleto",
]
CODE_PATTERNS = [r"c[óo]digo\s+de\s+verifica[çc][ãa]o\s*:?\s*([A-Z0-9\-]{4,})", r"c[óo]d\.?\s*verifica[çc][ãa]o\s*:?\s*([A-Z0-9\-]{4,})", r"autenticidade\s*:?\s*([A-Z0-9\-]{4,})"]


def links(x="body") -> Column:
    """All links of a text, in their order."""
    return F.regexp_extract_all(F.coalesce(F.col(x), F.lit("")), F.lit(r"(https?://[^\s\"'<>]+)"), F.lit(1))


def invoice_links(x="body") -> Column:
    """The links that may lead to an invoice."""
    return F.filter(links(x), lambda u: u.rlike("(?iu)https?://[^\\s]*(?:" + "|".join(LINK_PATTERNS) + ")"))


def with_filter_inputs(emails: DataFrame, body: str = "body") -> DataFrame:
    """Adds has_links_nfe and has_verification_code, which the decision asks for, from an e-mail's body."""
    return emails.withColumn("has_links_nfe", F.size(invoice_links(body)) > 0).withColumn("has_verification_code", verification_code(body).isNotNull())


# The content types.
CONTENT_TYPES = ["ATTACHMENT", "LINK_CODE", "LINK", "CODE", "NONE"]


def parsed_content_type(x: str) -> Column:
    """A content type as it is written; null for anything else."""
    return F.when(F.col(x).isin(CONTENT_TYPES), F.col(x))


def notices(emails: DataFrame, companies: DataFrame, limit: int | None = None) -> DataFrame:
    """(email_id, subject, sender_address, link, codigo, numero_nota, empresa, aviso) of e-mails without a file that have a link or a code.

    emails: email_id, subject, sender_address, body, attachments. The filter's decision is taken first; limit counts what passes.
    """
    from tributary.operators import companies as K

    kept = decided(with_filter_inputs(emails).withColumn("has_attachment", F.lit(False))).filter((F.col("decision") == "PROCESS") & ~F.coalesce(has_valid_attachment(), F.lit(False)))
    out = kept.withColumn("link", F.get(invoice_links(), F.lit(0))).withColumn("codigo", F.coalesce(verification_code(), code_in_link())).withColumn("numero_nota", F.coalesce(T.first_group("body", BODY_NUMBER), number_in_link()))
    out = out.filter("link is not null or codigo is not null")
    told = K.in_email(out.select("email_id", F.concat_ws("\n", "subject", "body").alias("text")), companies, "email_id").select("email_id", F.col("codigo").alias("empresa"))
    got = out.join(told, "email_id", "left").select("email_id", "subject", "sender_address", "link", "codigo", "numero_nota", "empresa", notice_text().alias("aviso"))
    return got.limit(limit) if limit else got


def verification_code(x="body") -> Column:
    return F.coalesce(*[T.group(x, "(?iu)" + p) for p in CODE_PATTERNS])


def code_in_link(x="link") -> Column:
    """The verification code among a link's parameters."""
    return T.first_group(x, [r"(?iu)[?&](?:cod(?:igo)?(?:verificacao)?|verificacao|chave|hash|token)=([A-Za-z0-9\-]+)"])


def number_in_link(x="link") -> Column:
    """The invoice number among a link's parameters."""
    return T.first_group(x, [r"(?iu)[?&](?:nf|nfe|nfse|nota|numero|num)=(\d+)", r"(?iu)/(?:nf|nfe|nfse|nota)/(\d+)"])


# Labels of amounts, dates and numbers in bodies.
BODY_DUE = [r"(?iu)vencimento\s*:?\s*(\d{2}[/\-.]\d{2}[/\-.]\d{4})", r"(?iu)vence\s+em\s*:?\s*(\d{2}[/\-.]\d{2}[/\-.]\d{4})", r"(?iu)venc\.?\s*:?\s*(\d{2}[/\-.]\d{2}[/\-.]\d{4})"]
BODY_NUMBER = [r"(?iu)nota\s+fiscal\s*(?:n[º°o.]*)?\s*:?\s*(\d{3,})", r"(?iu)\bnf[\s-]?s?[\s-]?e?\s*(?:n[º°o.]*)?\s*:?\s*(\d{3,})", r"(?iu)fatura\s*(?:n[º°o.]*)?\s*:?\s*(\d{3,})"]
ORDER_NUMBER = [r"(?iu)pedido\s*(?:de\s*compra)?\s*(?:n[º°o.]*)?\s*:?\s*(\d+)", r"(?iu)\bPC\s*:?\s*(\d{4,})"]
RANGE = (0.01, 10_000_000.0)


def body_fields(emails: DataFrame, body: str = "body") -> DataFrame:
    """Adds valores, valor_total, vencimento, numero_nota, numero_pedido, cnpj, codigo and confianca from an e-mail's body.

    valor_total is the largest amount in range. Confidence starts at 0.5; a total's label gives 0.3, another label of an amount 0.2,
    a currency sign 0.1, and an amount below 10 takes 0.2.
    """
    values = F.sort_array(F.array_distinct(F.filter(T.money_all(body), lambda v: v.between(*RANGE))), False)
    total = F.coalesce(F.get(values, F.lit(0)), F.lit(0.0))
    t = F.lower(F.coalesce(F.col(body), F.lit("")))
    sure = F.lit(50) + F.when(t.rlike(r"valor\s+total|total\s+a\s+pagar|total\s+da\s+nota"), 30).when(t.rlike(r"valor|total"), 20).otherwise(0) + F.when(t.contains("r$"), 10).otherwise(0) - F.when(total < 10, 20).otherwise(0)
    return emails.withColumns({
        "valores": values, "valor_total": total, "vencimento": T.iso_date(T.first_group(body, BODY_DUE)), "numero_nota": T.first_group(body, BODY_NUMBER), "numero_pedido": T.first_group(body, ORDER_NUMBER),
        "cnpj": T.cnpj(body), "codigo": verification_code(body), "confianca": F.when(total > 0, F.least(F.lit(100), F.greatest(F.lit(0), sure)) / 100.0).otherwise(0.0),
    })


def notice_text(link="link", code="codigo", number="numero_nota", cut: int = 100) -> Column:
    """What a notice says of an e-mail without an attachment."""
    return F.concat_ws(" | ", F.when(F.col(link).isNotNull(), F.concat(F.lit("Link: "), F.substring(link, 1, cut))), F.when(F.col(code).isNotNull(), F.concat(F.lit("Código: "), F.col(code))), F.when(F.col(number).isNotNull(), F.concat(F.lit("NF: "), F.col(number))))


def grouped(attachments: DataFrame) -> DataFrame:
    """One row for each e-mail of (email_id, subject, filename): its files, in the order of their names."""
    return attachments.groupBy("email_id").agg(F.min("subject").alias("subject"), F.array_sort(F.collect_list("filename")).alias("attachments"))


# Attachments that never are documents.
IGNORED_EXTENSIONS = [".png", ".jpg", ".jpeg", ".gif", ".bmp", ".ics", ".vcf", ".p7s", ".htm", ".html"]
IGNORED_NAMES = [r"^image\d+", r"^logo", r"assinatura", r"^smime"]


def ignored(name: Column) -> Column:
    """Whether a file of that name never is a document."""
    return F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1)).isin(IGNORED_EXTENSIONS) | T.any_match(name, IGNORED_NAMES)


def ignored_file(x="filename") -> Column:
    return ignored(F.col(x))


# Words of subjects and bodies that an inbox's statistics count.
INBOX_WORDS = ["nota fiscal", "nf-e", "nfs-e", "boleto", "fatura", "danfe", "cobrança", "pagamento", "vencimento", "código de verificação", "prefeitura", "xml"]


def inbox_words(*columns: str) -> Column:
    """The words of INBOX_WORDS that the columns have, in the list's order."""
    t = F.lower(F.concat_ws("\n", *columns))
    return F.array_compact(F.array(*[F.when(t.contains(w), F.lit(w)) for w in INBOX_WORDS]))


def inbox_statistics(emails: DataFrame, words: int = 20, senders: int = 15, examples: int = 10) -> DataFrame:
    """(grupo, valor, n, exemplos): how often each keyword and sender's domain occurs, the first `examples` subjects by email_id.

    A heap of the smallest examples is kept for each group while it is merged, so a common keyword collects no unbounded list.
    """
    each = emails.select("email_id", "subject", F.explode(F.concat(F.transform(inbox_words("subject"), lambda w: F.struct(F.lit("palavra").alias("grupo"), w.alias("valor"))), F.array(F.struct(F.lit("remetente").alias("grupo"), F.lower(F.substring_index("sender_address", "@", -1)).alias("valor"))))).alias("x"))
    each = each.select("email_id", "subject", "x.grupo", "x.valor").filter("valor is not null and valor <> ''")
    ranked = each.groupBy("grupo", "valor").agg(F.count("*").alias("n"), F.min_by("subject", "email_id").alias("_first"), F.min("email_id").alias("_id"))
    top = Window.partitionBy("grupo").orderBy(F.desc("n"), "valor")
    best = ranked.withColumn("_r", F.row_number().over(top)).filter(((F.col("grupo") == "palavra") & (F.col("_r") <= words)) | ((F.col("grupo") == "remetente") & (F.col("_r") <= senders)))
    place = Window.partitionBy("grupo", "valor").orderBy("email_id")
    shown = each.join(F.broadcast(best.select("grupo", "valor")), ["grupo", "valor"]).withColumn("_p", F.row_number().over(place)).filter(F.col("_p") <= examples)  # `words` and `senders` rows
    shown = shown.groupBy("grupo", "valor").agg(F.array_sort(F.collect_list(F.struct("_p", "subject"))).alias("_s")).select("grupo", "valor", F.transform("_s", lambda x: x["subject"]).alias("exemplos"))
    return best.select("grupo", "valor", "n").join(shown, ["grupo", "valor"])


def sender_parts(x="sender") -> DataFrame:
    """(name, address) of `Name <address>`."""
    address = F.coalesce(T.group(x, r"<([^<>]+)>"), T.group(x, r"([^\s<>]+@[^\s<>]+)"))
    return F.struct(F.trim(F.regexp_replace(F.regexp_replace(F.col(x), r"<[^<>]*>", ""), '"', "")).alias("name"), address.alias("address"))
