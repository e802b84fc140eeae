"""Streams: windows, sessions and deduplication over events, and the resumable run over a folder of e-mails."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators.emails import decided


def read(spark: SparkSession, sf_dir: str, files: int | None = None) -> DataFrame:
    """The events table as a stream."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return (stream.option("maxFilesPerTrigger", files) if files else stream).parquet(sf_dir)


def windowed(events: DataFrame, width: str = "1 hour", late: str | None = "10 minutes") -> DataFrame:
    """Events and their value by type in tumbling windows; sums are of exact cents. late: how long a stream waits."""
    e = events.withWatermark("ts", late) if late else events
    got = e.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"))
    return got.select(F.col("window.start").alias("inicio"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str | None = "10 minutes") -> DataFrame:
    """Sessions of a user, apart by a gap."""
    e = events.withWatermark("ts", late) if late else events
    got = e.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n"))
    return got.select("user_id", F.col("session_window.start").alias("inicio"), "n")


def distinct(events: DataFrame, keys: list[str], late: str | None = "10 minutes") -> DataFrame:
    """Each key once: the state that a stream keeps ends with the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys) if late else events.dropDuplicates(keys)


def run_once(stream: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """What a stream gives once all that is there is processed, as a table in memory; for tests and small results."""
    w = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True)
    q = (w.option("checkpointLocation", checkpoint) if checkpoint else w).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)


def ingest(emails: DataFrame, out: str, checkpoint: str, each: Callable[[DataFrame], DataFrame] = decided, rules: str = "") -> None:
    """Decides on all new e-mails of a stream and appends them as JSON lines, each e-mail once across runs.

    The checkpoint is kept for each set of rules, since decisions under other rules are another result. Files of a batch that is
    repeated after a failure replace those of its first try.
    """
    import hashlib

    key = hashlib.sha256(rules.encode()).hexdigest()[:12]

    def write(batch: DataFrame, n: int) -> None:
        each(batch.dropDuplicates(["email_id"])).write.mode("overwrite").json(f"{out}/rules={key}/batch={n:08d}")

    emails.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint}/{key}").trigger(availableNow=True).start().awaitTermination()


def without_processed(emails: DataFrame, processed: DataFrame, key: str = "email_id") -> DataFrame:
    """The rows of a batch that no earlier run has processed."""
    return emails.join(processed.select(key).distinct(), key, "left_anti")


def with_history(now: DataFrame, before: DataFrame, key: str) -> DataFrame:
    """The rows of this run, and those of earlier runs whose key it doesn't have."""
    return now.unionByName(before.join(now.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def retries(batches: DataFrame, limit: float = 300.0) -> DataFrame:
    """(batch_id, limite) of the batches that took too long, with twice the time for the next try."""
    return batches.filter(F.col("seconds") > limit).select("batch_id", F.lit(limit * 2).alias("limite"))


def _phase(emails: DataFrame, name: str, rows: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, tell: Callable[[str, dict], None] | None) -> int:
    """Runs one phase over what is new; gives the rows that it has read."""

    def write(batch: DataFrame, n: int) -> None:
        rows(batch.dropDuplicates(["email_id"])).write.mode("overwrite").json(f"{out}/{name}/batch={n:08d}")

    query = emails.writeStream.foreachBatch(write).option("checkpointLocation", f"{checkpoint}/{name}").trigger(availableNow=True).start()
    query.awaitTermination()
    seen = 0
    for p in query.recentProgress:
        seen += p["numInputRows"]
        if tell:
            tell(name, {"batch": p["batchId"], "rows": p["numInputRows"]})
    return seen


def run(emails: DataFrame, companies: DataFrame, out: str, checkpoint: str, links_first: bool = False, attachments: bool = True, notices: bool = True, tell: Callable[[str, dict], None] | None = None) -> dict[str, int]:
    """The whole run over a stream of e-mails: those with files, and those with a link or code only; rows read by phase.

    Each phase has its checkpoint and is resumed by itself. links_first turns their order around. A file that a batch writes again
    after a failure replaces that of its first try. tell gets each batch's progress.
    """
    from tributary.operators import emails as E

    def files(batch: DataFrame) -> DataFrame:
        return decided(E.with_filter_inputs(batch)).filter((F.col("decision") == "PROCESS") & E.has_valid_attachment())

    phases = [("attachments", files, attachments), ("notices", lambda batch: E.notices(batch, companies), notices)]
    return {name: _phase(emails, name, rows, out, checkpoint, tell) for name, rows, wanted in (phases[::-1] if links_first else phases) if wanted}


def status(spark: SparkSession, out: str) -> DataFrame:
    """(fase, lotes, emails) of what a run has written so far."""
    parts = []
    for name in ("attachments", "notices"):
        try:
            rows = spark.read.json(f"{out}/{name}")
        except Exception as e:  # noqa: BLE001 - a phase that has written nothing has no folder, or files without columns
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            continue
        if "email_id" in rows.columns:
            parts.append(rows.agg(F.lit(name).alias("fase"), F.count_distinct("batch").alias("lotes"), F.count("*").alias("emails")))
    empty = spark.createDataFrame([], "fase string, lotes long, emails long")
    return reduce(DataFrame.union, parts, empty)


def clear(spark: SparkSession, checkpoint: str) -> None:
    """Forgets what has been processed: the next run reads all e-mails again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(checkpoint)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
