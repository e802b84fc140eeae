"""Log lines to rows, and what is counted over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions import text as T

HEAD = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})(?:,\d+)? - (\S+) - (DEBUG|INFO|WARNING|ERROR|CRITICAL) - (.*)$"
#: Seconds above which a batch is slow.
SLOW = 20.0


def entries(lines: DataFrame, column: str = "line") -> DataFrame:
    """Adds ts, module, level and message to lines that begin an entry; other lines are left out."""
    out = lines.filter(F.col(column).rlike(HEAD))
    return out.withColumn("ts", F.try_to_timestamp(F.regexp_extract(column, HEAD, 1), F.lit("yyyy-MM-dd HH:mm:ss"))).withColumn("module", F.regexp_extract(column, HEAD, 2)).withColumn("level", F.regexp_extract(column, HEAD, 3)).withColumn("message", F.regexp_extract(column, HEAD, 4))


def joined_entries(lines: DataFrame, file: str = "file", ordinal: str = "ordinal", column: str = "line") -> DataFrame:
    """Entries with the lines that follow them appended to their message. The running count is kept file by file."""
    order = Window.partitionBy(file).orderBy(ordinal)
    marked = lines.withColumn("_n", F.sum(F.col(column).rlike(HEAD).cast("int")).over(order)).filter("_n > 0")
    whole = marked.groupBy(file, "_n").agg(F.array_sort(F.collect_list(F.struct(ordinal, column))).alias("_l"))
    first = whole.select(file, F.col("_n").alias("entry"), F.col("_l")[0][column].alias(column), F.array_join(F.transform(F.slice("_l", 2, 1_000_000), lambda x: x[column]), "\n").alias("rest"))
    out = entries(first, column)
    return out.withColumn("message", F.concat_ws("\n", "message", F.nullif("rest", F.lit("")))).drop("rest")


def level_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("level", "module").agg(F.count("*").alias("n"))


def masked(x: str = "message") -> Column:
    """A message with batch ids, paths, durations and numbers masked, for grouping."""
    t = F.regexp_replace(F.col(x), r"email_\d{8}_\w+", "<lote>")
    t = F.regexp_replace(t, r"(/[\w.\-]+){2,}", "<caminho>")
    t = F.regexp_replace(t, r"\d+(\.\d+)?s\b", "<tempo>")
    return F.regexp_replace(t, r"\d+", "<n>")


def top_messages(log: DataFrame, n: int = 10) -> DataFrame:
    return log.groupBy("level", masked().alias("mensagem")).agg(F.count("*").alias("vezes")).orderBy(F.desc("vezes"), "level", "mensagem").limit(n)


def batches(log: DataFrame) -> DataFrame:
    """(batch_id, duracao, lenta): the last duration that a batch reports."""
    found = log.select("ts", T.group("message", r"(email_\d{8}_\w+)").alias("batch_id"), T.group("message", r"(\d+(?:\.\d+)?)s\b").try_cast("double").alias("duracao"))
    got = found.filter("batch_id is not null and duracao is not null").groupBy("batch_id").agg(F.max_by("duracao", F.struct("ts", "duracao")).alias("duracao"))
    return got.withColumn("lenta", F.col("duracao") > SLOW)


def sessions(log: DataFrame, begins: str, ends: str) -> DataFrame:
    """(module, sessao, inicio, fim, linhas, completa): from a line that begins a session to the next such line of its module.

    Lines are ordered hour by hour, and an hour's sessions are counted on from those of the hours before, so a busy module is no
    single task.
    """
    begun = log.withColumn("_h", F.date_trunc("hour", "ts")).withColumn("_b", F.col("message").rlike(begins).cast("int"))
    before = Window.partitionBy("module").orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)
    hours = begun.groupBy("module", "_h").agg(F.sum("_b").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    order = Window.partitionBy("module", "_h").orderBy("ts", "message")
    marked = begun.withColumn("_n", F.sum("_b").over(order)).join(hours, ["module", "_h"]).withColumn("sessao", F.col("_n") + F.col("_before")).filter("sessao > 0")
    return marked.groupBy("module", "sessao").agg(F.min("ts").alias("inicio"), F.max("ts").alias("fim"), F.count("*").alias("linhas"), F.max(F.col("message").rlike(ends)).alias("completa"))


def report(log: DataFrame) -> DataFrame:
    """(secao, linha) of a text report: entries by level, the slow batches, and the commonest messages."""
    levels = log.groupBy("level").agg(F.count("*").alias("n")).select(F.lit("niveis").alias("secao"), F.concat_ws(": ", "level", F.col("n").cast("string")).alias("linha"))
    slow = batches(log).filter("lenta").select(F.lit("lotes lentos").alias("secao"), F.concat("batch_id", F.lit(" em "), F.col("duracao").cast("string"), F.lit("s")).alias("linha"))
    top = top_messages(log).select(F.lit("mensagens").alias("secao"), F.concat(F.col("vezes").cast("string"), F.lit("x ["), "level", F.lit("] "), "mensagem").alias("linha"))
    return levels.union(slow).union(top)


def extractor_results(log: DataFrame) -> DataFrame:
    """Tries, successes and failures of each extractor that messages name."""
    name = T.group("message", r"(?i)extractor[:\s]+(\w+)")
    found = log.select(name.alias("extractor"), F.lower("message").alias("m")).filter("extractor is not null")
    return found.groupBy("extractor").agg(F.count("*").alias("tentativas"), F.count_if(F.col("m").rlike("sucesso|extra[ií]do")).alias("sucessos"), F.count_if(F.col("m").rlike("falha|erro")).alias("falhas"))


def pdf_problems(log: DataFrame) -> DataFrame:
    """(arquivo, problema) of the messages about files that can't be read."""
    m = F.lower("message")
    kind = F.when(m.rlike("senha|password"), "SENHA").when(m.rlike("corromp|corrupt"), "CORROMPIDO").when(m.rlike("vazio|empty"), "VAZIO").when(m.rlike("timeout|tempo"), "TIMEOUT")
    return log.select(T.group("message", r"([\w.\-]+\.pdf)").alias("arquivo"), kind.alias("problema")).filter("arquivo is not null and problema is not null")
