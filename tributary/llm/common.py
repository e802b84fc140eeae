"""Shared working folder, written tables and connected components."""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Hashable
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

_OWN: dict[str, str] = {}
_MADE: list[tuple[SparkSession, str]] = []


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir, or in local mode one of our own where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return ("file://" + root[5:] if root.startswith("file:/") and not root.startswith("file://") else root).rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = "file://" + tempfile.mkdtemp(prefix="tributary-")
        spark.sparkContext.setCheckpointDir(_OWN[app])
    return _OWN[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; cleanup() removes it."""
    path = f"{shared_root(spark)}/tributary-{uuid.uuid4().hex[:12]}/{name}"
    _MADE.append((spark, path.rpartition("/")[0]))
    return path


def cleanup() -> None:
    """Removes what scratch() has handed out. DataFrames that read it can't be used afterwards."""
    while _MADE:
        spark, path = _MADE.pop()
        try:
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
        except Exception:  # noqa: BLE001 - the session may be gone, and with it the way to reach the folder
            return


atexit.register(cleanup)

_RESIDENT: dict[Hashable, Any] = {}


def evict() -> None:
    """Frees what resident() keeps, and gives the memory back to the system: workers live on."""
    _RESIDENT.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def resident(key: Hashable, build: Callable[[], Any]) -> Any:
    """What build() makes, kept in a Python worker until another key is asked for: workers live on, and hold one model at a time."""
    if key not in _RESIDENT:
        if _RESIDENT:
            evict()
        _RESIDENT[key] = build()
    return _RESIDENT[key]


#: Bytes of a batch that goes to a Python worker while written() runs; a batch is held in the JVM, in the worker, and as what comes out of it.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's batches to Python workers as written() does: for jobs of many stages, whose executors keep what each needs at most."""
    spark.conf.set(*BATCH)


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet to the shared folder and read again: this cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    before = spark.conf.get(BATCH[0])
    spark.conf.set(*BATCH)
    try:
        df.write.parquet(path := scratch(spark, name))
    finally:
        spark.conf.set(BATCH[0], before)
    return spark.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A table of rows that the driver holds, within the plan itself. From a list, createDataFrame would pass them through Python on an executor, by a daemon and workers beside those of the queries."""
    schema = StructType.fromDDL(columns)
    held = list(zip(*rows, strict=True)) or [()] * len(schema)
    return spark.createDataFrame(pa.table([pa.array(x, to_arrow_type(f.dataType)) for x, f in zip(held, schema, strict=True)], names=schema.names), schema)


def give_back(spark: SparkSession) -> None:
    """Lets the executors' JVMs collect garbage and return the heap that they don't need: it grows with the most that a step needs at once, and stays, while the next step needs its memory elsewhere.

    A task for each core, so that all executors that are idle have one; what one misses costs memory, never rows.
    """
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.java_method(F.lit("java.lang.System"), F.lit("gc"))).collect()


class Sieve:
    """What may be among keys (h long): true for all hashes that are, and for few others.

    A Bloom filter of some 16 bits a key, 32 MB at most, is broadcast; with more keys than that allows, more others pass. What passes
    is to be joined with the keys themselves: the sieve only saves the shuffle of all the rest.
    """

    def __init__(self, keys: DataFrame, most_bits: int = 1 << 28):
        bits = min(most_bits, max(1 << 15, 1 << (16 * keys.count()).bit_length()))
        place = F.explode(F.array(*(F.shiftright("h", n).bitwiseAND(F.lit(bits - 1)) for n in (0, 32))))
        maps = keys.select(place.alias("p")).groupBy(F.shiftright("p", 15).alias("bucket")).agg(F.bitmap_construct_agg(F.col("p").bitwiseAND(F.lit(32767))).alias("bits"))
        full = np.zeros(bits // 8, np.uint8)
        for r in maps.collect():  # bits // 32768 rows of 4096 bytes at most
            full[r["bucket"] * 4096 : (r["bucket"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
        self.bits, self.shared = bits, keys.sparkSession.sparkContext.broadcast(full)

    def passes(self, h: np.ndarray) -> np.ndarray:
        """For use within a Python function over batches, so that a task needs one worker and not two."""
        hit = np.ones(len(h), bool)
        for n in (0, 32):
            p = (h.astype(np.int64) >> n) & (self.bits - 1)
            hit &= (self.shared.value[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
        return hit

    def column(self, h: F.Column | str) -> F.Column:
        me = self

        @F.arrow_udf("boolean")
        def passes(h: pa.Array) -> pa.Array:
            return pa.array(me.passes(h.to_numpy(zero_copy_only=False)))

        return passes(h)


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the edges (a long, b long); root is the smallest node that can be reached.

    Alternates large-star and small-star: each round links every node to the smallest of its neighbourhood, with a
    grouped minimum and a join that adaptive execution can split at hubs. Rounds grow with the logarithm of a path's length.
    """

    def state(e: DataFrame) -> tuple:
        r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    e = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "edges")
    seen = state(e)
    for _ in range(rounds):
        if not seen[0]:
            break
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u and v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        e = written(small.distinct(), "edges")
        now = state(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"no fixpoint in {rounds} rounds")
    return e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).union(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
