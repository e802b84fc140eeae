"""File sources: e-mail folders, metadata, messages, reports, partial results and logs. Paths are read by Spark only."""

from __future__ import annotations

import email
import email.header
import email.utils
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions import text as T

METADATA = "batch_id string, email_subject string, email_sender_name string, email_sender_address string, email_body_text string, received_date string, attachments array<string>, created_at string, extra map<string,string>, _corrupt string"


def metadata(spark: SparkSession, root: str) -> DataFrame:
    """metadata.json of every batch folder; a malformed one has nulls and its text in _corrupt. batch_id falls back to the folder."""
    raw = spark.read.schema(METADATA).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("recursiveFileLookup", True).option("pathGlobFilter", "metadata.json").json(root)
    return raw.withColumn("batch_id", F.coalesce("batch_id", F.regexp_extract(F.input_file_name(), r"([^/]+)/[^/]+$", 1)))


def batch_files(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """(batch_id, ordinal, path, name, kind, length, modificationTime) of the PDF and XML files that count, XML first, without content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.{pdf,PDF,xml,XML}").load(root).drop("content")
    name, ext = F.regexp_extract("path", r"([^/]+)$", 1), F.lower(F.regexp_extract("path", r"\.([^.]+)$", 1))
    out = files.select("path", name.alias("name"), ext.alias("kind"), "length", "modificationTime", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("batch_id"))
    out = out.filter(~F.startswith(F.col("name"), F.lit(".")) & ~F.contains(F.col("path"), F.lit("/ignored/")))
    from pyspark.sql import Window

    return out.withColumn("ordinal", F.row_number().over(Window.partitionBy("batch_id").orderBy(F.col("kind") != "xml", "path")))


MESSAGE = "path string, email_id string, subject string, sender_name string, sender_address string, date string, body string, filename string, content binary"
MARKER = "\n--- HTML CONTENT ---\n"


def _decoded(text: str | None) -> str:
    out = ""
    for part, charset in email.header.decode_header(text or ""):
        if isinstance(part, bytes):
            try:
                part = part.decode(charset or "utf-8")
            except (LookupError, UnicodeDecodeError):
                part = part.decode("latin-1")
        out += part
    return out


def parse_message(raw: bytes) -> list[dict]:
    """One dict for each attachment of a message, or one without a file; text parts, then HTML parts after MARKER."""
    m = email.message_from_bytes(raw)
    plain, html, files = [], [], []
    for part in m.walk():
        if part.is_multipart():
            continue
        data = part.get_payload(decode=True) or b""
        if part.get_filename():
            files.append((_decoded(part.get_filename()), data))
        elif part.get_content_type() in ("text/plain", "text/html"):
            charset = part.get_content_charset() or "utf-8"
            try:
                text = data.decode(charset)
            except (LookupError, UnicodeDecodeError):
                text = data.decode("latin-1")
            (plain if part.get_content_type() == "text/plain" else html).append(text)
    name, address = email.utils.parseaddr(_decoded(m.get("From")))
    received = (m.get("Received") or "").rpartition(";")[2].strip()
    row = {"email_id": (m.get("Message-ID") or "").strip().strip("<>"), "subject": _decoded(m.get("Subject")), "sender_name": name, "sender_address": address, "date": m.get("Date") or received or None, "body": "\n".join(plain) + (MARKER + "\n".join(html) if html else "")}
    return [row | {"filename": f, "content": d} for f, d in files] or [row | {"filename": None, "content": None}]


def messages(spark: SparkSession, root: str) -> DataFrame:
    """A row for each attachment of every .eml file, or one for a message without any. A message that can't be parsed has nulls."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.eml").load(root).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in MESSAGE.split(", ")]
        for b in batches:
            for path, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    rows = [{"path": path} | r for r in parse_message(raw)]
                except (ValueError, LookupError, TypeError):
                    rows = [{"path": path}]
                kinds = [pa.string()] * 8 + [pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], k) for n, k in zip(names, kinds, strict=True)], names)

    return files.mapInArrow(run, MESSAGE)


def by_email(rows: DataFrame) -> DataFrame:
    """One row for each message of messages(), its files as an array."""
    files = F.array_compact(F.collect_list(F.when(F.col("filename").isNotNull(), F.struct("filename", "content"))))
    return rows.groupBy("path").agg(*[F.first(c).alias(c) for c in ("email_id", "subject", "sender_name", "sender_address", "date", "body")], files.alias("attachments"))


def without_attachments(emails: DataFrame, limit: int | None = None) -> DataFrame:
    """E-mails of by_email() without a file that counts; limit counts after the predicate."""
    ok = F.exists("attachments", lambda a: F.lower(F.substring_index(a["filename"], ".", -1)).isin("pdf", "xml", "zip", "rar", "7z"))
    out = emails.filter(~ok)
    return out.limit(limit) if limit else out


def email_key(x: str = "email_id") -> F.Column:
    """A stable id that file systems take, from a Message-ID."""
    return F.regexp_replace(F.col(x), r"[^\w.\-@]", "_")


def texts(files: DataFrame, strategies: list[tuple[str, Callable[[bytes], str | None]]], good: int = 300) -> DataFrame:
    """Adds text and strategy to (path, content): the first strategy whose text has `good` characters, else the longest text.

    A strategy is a function of a file's bytes; one that raises counts as no text. Readers of PDF and images are the caller's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, how = [], []
            for raw in b.column(1).to_pylist():
                text, name = "", None
                for n, f in strategies:
                    try:
                        got = f(raw) or ""
                    except Exception:  # noqa: BLE001 - a file that one strategy can't read is for the next
                        continue
                    if len(got) > len(text):
                        text, name = got, n
                    if len(text) >= good:
                        break
                out.append(text)
                how.append(name)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string()), pa.array(how, pa.string())], ["path", "text", "strategy"])

    return files.select("path", "content").mapInArrow(run, "path string, text string, strategy string")


def passwords(cnpjs: DataFrame, column: str = "cnpj") -> DataFrame:
    """Passwords that senders derive from registration numbers: 14, 8, 5 and 4 digits; distinct, in order."""
    d = T.cnpj_digits(column)
    return cnpjs.select(F.explode(F.array(d, F.substring(d, 1, 8), F.substring(d, 1, 5), F.substring(d, 1, 4))).alias("senha")).filter("senha is not null").distinct().orderBy("senha")


def report_csv(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """A report back, all columns text; the delimiter is taken from the first line, and a byte order mark is cut."""
    if sep is None:
        head = spark.read.text(path).limit(1).collect()
        sep = ";" if head and head[0][0].count(";") >= head[0][0].count(",") else ","
    df = spark.read.option("header", True).option("sep", sep).csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def br_number(x: str) -> F.Column:
    """1.234,56, 1234,56 or 1234.56 of a report as a number; 0 otherwise."""
    t = F.trim(F.replace(F.coalesce(F.col(x), F.lit("")), F.lit("R$"), F.lit("")))
    return F.coalesce(F.when(t.contains(","), F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).otherwise(t).try_cast("double"), F.lit(0.0))


def log_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, ordinal, line) of log files; ordinal grows along each file."""
    return spark.read.text(path).select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("ordinal"), F.col("value").alias("line"))


def report_cases(spark: SparkSession, path: str) -> DataFrame:
    """(case_id, severity, body) of an audit's text report, whose cases are 80 hyphens apart."""
    raw = spark.read.option("lineSep", "-" * 80).text(path)
    return raw.select(T.group("value", r"(?iu)caso\s*#?\s*(\d+)").try_cast("int").alias("case_id"), T.group("value", r"(?iu)severidade\s*:\s*(\w+)").alias("severity"), F.trim("value").alias("body")).filter("case_id is not null")


def partial_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines that a stopped run has left; broken lines are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
