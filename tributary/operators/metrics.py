"""Counters, gauges and histograms over rows of (name, labels, value, ts), and their text forms."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

# Upper edges of the histogram's buckets, in seconds.
BUCKETS = [0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0]


def counters(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("n"))


def gauges(rows: DataFrame, *by: str, value: str = "value", ts: str = "ts") -> DataFrame:
    """The last value of each."""
    return rows.groupBy(*by).agg(F.max_by(value, F.struct(ts, value)).alias("value"))


def histogram(rows: DataFrame, by: str, seconds: str = "seconds") -> DataFrame:
    """Cumulative buckets le_0_1 to le_60_0 and le_inf with count, sum and average; one pass. Sums are of exact millionths."""
    edges = [F.count_if(F.col(seconds) <= b).alias(f"le_{str(b).replace('.', '_')}") for b in BUCKETS]
    total = F.sum(F.col(seconds).cast("decimal(24,6)"))
    return rows.groupBy(by).agg(*edges, F.count("*").alias("le_inf"), total.cast("double").alias("total"), (total.cast("double") / F.count("*")).alias("media"))


def session_summary(rows: DataFrame, name: str = "name", n: str = "n") -> DataFrame:
    """One row: the sums of counters by the beginnings of their names."""
    part = lambda p: F.coalesce(F.sum(F.when(F.startswith(F.col(name), F.lit(p)), F.col(n))), F.lit(0))
    return rows.agg(part("emails_").alias("emails"), part("documents_").alias("documentos"), part("errors_").alias("erros"), F.sum(n).alias("total"))


def as_prometheus(rows: DataFrame, name: str = "name", label: str = "label", value: str = "value") -> DataFrame:
    """A line for each metric in the text format of Prometheus."""
    return rows.select(F.concat(F.col(name), F.lit('{label="'), F.regexp_replace(F.col(label), r'(["\\])', r"\\$1"), F.lit('"} '), F.col(value).cast("string")).alias("line"))


def as_json(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(F.struct("*")).alias("line"))


def run_totals(results: DataFrame) -> DataFrame:
    """Counts of the status of batches: OK, TIMEOUT, ERROR."""
    return results.agg(F.count("*").alias("lotes"), F.count_if(F.col("status") == "OK").alias("ok"), F.count_if(F.col("status") == "TIMEOUT").alias("timeout"), F.count_if(F.col("status") == "ERROR").alias("erro"))


def skipped(decisions: DataFrame) -> DataFrame:
    """(motivo, n): how many e-mails were left out, by reason."""
    return decisions.filter(F.startswith("decision", F.lit("SKIP_"))).groupBy(F.lower(F.substring("decision", 6, 100)).alias("motivo")).agg(F.count("*").alias("n"))


class Measure:
    """What a block of work took: its name, seconds, and the rows that passed each observed DataFrame."""

    def __init__(self, name: str):
        self.name, self.seconds, self._seen = name, 0.0, []

    def rows(self, df: DataFrame) -> DataFrame:
        """df, whose rows are counted by the action that runs it, without another pass."""
        o = Observation()
        self._seen.append(o)
        return df.observe(o, F.count(F.lit(1)).alias("n"))

    @property
    def counts(self) -> list[int]:
        """Once an action has run each of them."""
        return [o.get["n"] for o in self._seen]


@contextmanager
def measured(name: str) -> Iterator[Measure]:
    """Times a block: `with measured("merge") as m: m.rows(df).write...`."""
    m, began = Measure(name), time.monotonic()
    try:
        yield m
    finally:
        m.seconds = time.monotonic() - began
