"""Sinks: reports by kind, batch folders, a spreadsheet in chunks, partial results flattened, and the deletion of old batches.

Tasks write by themselves, under names that a task's retry writes again, so nothing comes twice and nothing passes the driver.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.operators import emails as E
from tributary.operators import reports as R

Sink = Callable[[DataFrame, str], None]


def _csv(df: DataFrame, path: str) -> None:
    if df.isEmpty():
        raise ValueError("nothing to write")
    R.write_csv(df, path)


#: Sinks by name; a caller's own is added with SINKS["name"] = function(rows, destination).
SINKS: dict[str, Sink] = {"csv": _csv, "by_type": R.write_by_type, "jsonl": R.write_partial}


def export(df: DataFrame, kind: str, destination: str) -> None:
    """Writes the rows by the named sink."""
    if kind not in SINKS:
        raise ValueError(f"no sink {kind}: there are {', '.join(sorted(SINKS))}")
    SINKS[kind](df, destination)


def write_run(docs: DataFrame, pairs: DataFrame, path: str) -> None:
    """All reports of a run: a folder for each type of document, all types together, and a row for each pair."""
    R.write_by_type(docs, f"{path}/por_tipo")
    R.write_csv(docs.orderBy("batch_id", "ordinal"), f"{path}/consolidado")
    R.write_csv(pairs.orderBy("batch_id", "pair_id"), f"{path}/pares")


def flattened(results: DataFrame) -> DataFrame:
    """Partial results with a row for each of their documents: (batch_id, status, ordinal, and the document's fields). A batch without any keeps a row."""
    rows = results.select("batch_id", "status", F.posexplode_outer("documents").alias("ordinal", "d"))
    return rows.select("batch_id", "status", (F.col("ordinal") + 1).alias("ordinal"), "d.*")


def append_rows(df: DataFrame, append: Callable[[list[list]], None], size: int = 100, tries: int = 5, wait: tuple[float, float] = (2.0, 10.0)) -> DataFrame:
    """Calls append with the rows in chunks, partition by partition; (linhas, tentativas) of each chunk. Run it by an action.

    A chunk that raises is tried again, after a time that doubles between the bounds of `wait`; the last error is raised.
    """
    names, kinds = df.columns, df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [list(r) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
            for i in range(0, len(rows), size):
                for n in range(1, tries + 1):
                    try:
                        append(rows[i : i + size])
                        break
                    except Exception:
                        if n == tries:
                            raise
                        time.sleep(min(wait[1], wait[0] * 2 ** (n - 1)))
                yield pa.RecordBatch.from_arrays([pa.array([len(rows[i : i + size])], pa.int64()), pa.array([n], pa.int64())], ["linhas", "tentativas"])

    assert len(names) == len(kinds)
    return df.mapInArrow(run, "linhas long, tentativas long")


def safe_name(name: str, most: int = 200) -> str:
    """A name that file systems take; as functions.text.file_name."""
    t = re.sub(r'[<>:"/\\|?*]', "_", name)
    ext = re.search(r"(\.[^.]*)$", t)
    ext = ext[1] if ext else ""
    return t if len(t) <= most else t[: most - len(ext)] + ext


def unique_names(names: list[str]) -> list[str]:
    """Numbered names in the order given, 01_ first: equal names stay apart."""
    return [f"{i:02d}_{safe_name(n)}" for i, n in enumerate(names, 1)]


def write_batches(mails: DataFrame, root: str, keep_ignored: bool = True) -> DataFrame:
    """Writes a folder for each e-mail and gives (batch_id, arquivos, ignorados). Run it by an action.

    mails: batch_id, subject, sender_name, sender_address, body, attachments of (filename, content). Files that never are documents
    go to the folder ignored, or nowhere. metadata.json is written last: a folder that has it is whole.
    """
    other = F.filter(F.col("attachments"), lambda a: E.ignored(a["filename"]))
    good = F.filter(F.col("attachments"), lambda a: ~E.ignored(a["filename"]))
    use = mails.select("batch_id", "subject", "sender_name", "sender_address", "body", good.alias("good"), other.alias("other"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)

        def put(path: str, data: bytes) -> None:
            with store.open_output_stream(path) as f:
                f.write(data)

        for b in batches:
            out = []
            for batch, subject, name, address, body, good, other in zip(*(c.to_pylist() for c in b.columns), strict=True):
                folder = f"{base}/{safe_name(batch)}"
                store.create_dir(f"{folder}/ignored" if keep_ignored and other else folder, recursive=True)
                names = unique_names([a["filename"] for a in good or []])
                for n, a in zip(names, good or [], strict=True):
                    put(f"{folder}/{n}", a["content"] or b"")
                for n, a in zip(unique_names([a["filename"] for a in other or []]), other or [], strict=True):
                    if keep_ignored:
                        put(f"{folder}/ignored/{n}", a["content"] or b"")
                put(f"{folder}/metadata.json", json.dumps({"batch_id": batch, "email_subject": subject, "email_sender_name": name, "email_sender_address": address, "email_body_text": body, "attachments": names}, ensure_ascii=False).encode())
                out.append((batch, names, len(other or [])))
            cols = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.list_(pa.string()), pa.int64()), strict=True)], ["batch_id", "arquivos", "ignorados"])

    return use.mapInArrow(run, "batch_id string, arquivos array<string>, ignorados long")


def delete_batches(batches: DataFrame, root: str) -> DataFrame:
    """Deletes the folders of the batches (batch_id), as reports.expired lists them; (batch_id, apagado). Run it by an action. A folder that is gone already is false."""

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        for b in found:
            done = []
            for batch in b.column(0).to_pylist():
                folder = f"{base}/{safe_name(batch)}"
                there = bool(batch) and store.get_file_info(folder).type == fs.FileType.Directory
                if there:
                    store.delete_dir(folder)
                done.append(there)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(done, pa.bool_())], ["batch_id", "apagado"])

    return batches.select(F.col("batch_id").cast("string").alias("batch_id")).mapInArrow(run, "batch_id string, apagado boolean")
