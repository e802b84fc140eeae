"""A mailbox as a data source: `spark.read.format("mailbox")`, one row for each attachment, with a pushed predicate on the subject.

Options: path, a folder of .eml files; or host, user, password and folder of an IMAP server, which each partition asks by itself. A
filter `subject` LIKE '%text%' goes to the server as SEARCH SUBJECT, and is checked again on the rows. A message that can't be read
gives a row with its path only, so that one of them doesn't end the scan.
"""

from __future__ import annotations

import glob
import imaplib
import os
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, StringContains

from tributary.sources.readers import MESSAGE, parse_message

FIELDS = [f.split()[0] for f in MESSAGE.split(", ")]


class Part(InputPartition):
    def __init__(self, names: list[str]):
        self.names = names


class Folder:
    """Messages in files of a folder that all executors can read."""

    def __init__(self, options: dict):
        self.root = options["path"]

    def names(self, subject: str | None) -> list[str]:
        return sorted(glob.glob(os.path.join(self.root, "**", "*.eml"), recursive=True))

    def fetch(self, names: list[str]) -> Iterator[tuple[str, bytes]]:
        for n in names:
            with open(n, "rb") as f:
                yield n, f.read()


class Imap:
    """Messages of one folder of an IMAP server, over TLS."""

    def __init__(self, options: dict, connect=imaplib.IMAP4_SSL):
        self.options, self.connect = options, connect

    def _open(self):
        box = self.connect(self.options["host"])
        box.login(self.options["user"], self.options["password"])
        box.select(self.options.get("folder", "INBOX"), readonly=True)
        return box

    def names(self, subject: str | None) -> list[str]:
        box = self._open()
        try:
            asked = ("SUBJECT", '"' + subject.replace("\\", "\\\\").replace('"', '\\"') + '"') if subject and subject != "*" else ("ALL",)
            return [x.decode() for x in box.uid("SEARCH", None, *asked)[1][0].split()]
        finally:
            box.logout()

    def fetch(self, names: list[str]) -> Iterator[tuple[str, bytes]]:
        box = self._open()
        try:
            for n in names:
                got = box.uid("FETCH", n, "(RFC822)")[1]
                yield n, next((x[1] for x in got if isinstance(x, tuple)), b"")
        finally:
            box.logout()


class Reader(DataSourceReader):
    def __init__(self, client: Folder | Imap, size: int):
        self.client, self.size, self.subject = client, size, None

    def pushFilters(self, filters: list) -> Iterator:  # noqa: N802 - the interface's name
        for f in filters:
            if isinstance(f, StringContains) and tuple(f.attribute) == ("subject",):
                self.subject = f.value
            yield f  # servers ignore case and encodings differ, so Spark checks again

    def partitions(self) -> list[Part]:
        names = self.client.names(self.subject)
        return [Part(names[i : i + self.size]) for i in range(0, len(names), self.size)] or [Part([])]

    def read(self, partition: Part) -> Iterator[tuple]:
        for path, raw in self.client.fetch(partition.names):
            try:
                rows = parse_message(raw)
            except (ValueError, LookupError, TypeError):
                rows = [{}]
            for r in rows:
                yield tuple(path if n == "path" else r.get(n) for n in FIELDS)


class Mailbox(DataSource):
    """Register with register(spark)."""

    @classmethod
    def name(cls) -> str:
        return "mailbox"

    def schema(self) -> str:
        return MESSAGE

    def client(self) -> Folder | Imap:
        return Folder(self.options) if "path" in self.options else Imap(self.options)

    def reader(self, schema) -> Reader:  # noqa: ARG002 - all columns are read; a message is one piece
        return Reader(self.client(), int(self.options.get("partitionsize", "50")))


def register(spark: SparkSession) -> None:
    """Makes the format "mailbox" known, and lets its predicate be pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Mailbox)
