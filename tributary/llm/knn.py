"""Exact top-k by inner product of integers, with KD-trees over shards.

Vectors that are null, empty, or hold null or non-finite components take no part, nor do rows without a vec_id; vectors of different
lengths raise an error. Zero vectors take part. A score beyond 64 bits is the largest or smallest long. Rows that repeat a vec_id are
rows of their own: each of them asks for itself, so that its id has as many answers as rows, and a query's candidates are the rows
with any other id. Fewer candidates than wanted are all returned. An empty table gives an empty result. Only vec_id and embedding
are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.ann import _grouped, best, matrix, queries, vectors
from tributary.llm.common import written


class KDTree:
    """Median splits of the dimension with the widest range; each node has the tight bounding box of its rows."""

    LEAF = 64

    def __init__(self, x: np.ndarray):
        self.x, low, high, self.node = x, [], [], []
        order = np.arange(len(x))
        todo = [(0, len(x), -1, 0)]
        while todo:
            i, j, parent, side = todo.pop()
            rows = x[order[i:j]]
            lo, hi = rows.min(axis=0), rows.max(axis=0)
            me = len(self.node)
            if parent >= 0:
                self.node[parent][side] = me
            low.append(lo)
            high.append(hi)
            d = int((hi - lo).argmax())
            if j - i <= self.LEAF or hi[d] == lo[d]:
                self.node.append([-1, -1, i, j])
                continue
            mid = (j - i) // 2
            order[i:j] = order[i:j][np.argpartition(rows[:, d], mid)]
            self.node.append([-1, -1, i, j])
            todo += [(i, i + mid, me, 0), (i + mid, j, me, 1)]
        self.order, self.low, self.high = order, np.array(low), np.array(high)

    def bounds(self, q: np.ndarray) -> np.ndarray:
        return bounds(q, self.low, self.high)

    def search(self, q: np.ndarray, bound: np.ndarray, ids: np.ndarray, own: int, k: int, floor: float) -> list[tuple[float, int]]:
        """(score, vec_id) of the k best, best node first; nodes that can't reach the k-th score so far, or floor, stay closed."""
        queue, top = [(-bound[0], 0)], []
        while queue:
            b, at = heapq.heappop(queue)
            if -b < floor:
                break
            left, right, i, j = self.node[at]
            if left >= 0:
                for n in (left, right):
                    if bound[n] >= floor:
                        heapq.heappush(queue, (-bound[n], n))
                continue
            rows = self.order[i:j]
            s = self.x[rows] @ q
            for n in np.flatnonzero(s >= floor):
                if ids[rows[n]] != own:
                    item = (s[n], -int(ids[rows[n]]))
                    if len(top) < k:
                        heapq.heappush(top, item)
                    else:
                        heapq.heappushpop(top, item)
            if len(top) == k:
                floor = max(floor, top[0][0])
        return [(s, -i) for s, i in top]


def exact(v: np.ndarray) -> np.ndarray:
    """floor(256 x): as doubles while every inner product of such vectors is exact in them, else as Python's integers."""
    with np.errstate(over="ignore"):
        f = np.floor(256 * v)
    if np.isfinite(f).all() and v.shape[1] * np.abs(f).max(initial=0) ** 2 < 2**53:
        return f
    from math import floor

    return np.array([[floor(256 * x) if abs(x) < 1e300 else 256 * int(x) for x in row] for row in v.tolist()], dtype=object)


def top_splits(x: np.ndarray, parts: int) -> list[tuple[int, float, int, int]]:
    """Median splits of the sample x into `parts` shards: (dimension, value, left, right); a negative child -1 - s is shard s."""
    splits: list = []
    shard = 0

    def cut(at: np.ndarray, n: int) -> int:
        nonlocal shard
        rows = x[at]
        spread = rows.max(axis=0) - rows.min(axis=0) if len(at) else np.zeros(1)
        d = int(spread.argmax())
        if n < 2 or not spread[d] > 0:
            shard += 1
            return -shard
        value = float(np.partition(rows[:, d], len(at) // 2)[len(at) // 2])
        left = rows[:, d] < value
        if not left.any():  # more than half have the least value: it gets a side of its own
            value = float(rows[rows[:, d] > value, d].min())
            left = rows[:, d] < value
        me = len(splits)
        splits.append(None)
        splits[me] = (d, value, cut(at[left], n // 2), cut(at[~left], n - n // 2))
        return me

    cut(np.arange(len(x)), parts)
    return splits


def shard_of(splits: list, x: np.ndarray) -> np.ndarray:
    out, todo = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))] if splits else []
    while todo:
        node, at = todo.pop()
        d, value, left, right = splits[node]
        low = x[at, d] < value
        for child, rows in ((left, at[low]), (right, at[~low])):
            if child < 0:
                out[rows] = -1 - child
            elif len(rows):
                todo.append((child, rows))
    return out


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each query and box, the largest inner product that a vector in the box can have."""
    return np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T


def top_products(table: DataFrame, every: int, k: int, shard: int = 8192, block: int = 65_536, first: int = 2, max_shards: int = 8192, most: int = 65_536) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vec_id divisible by `every`, its k highest inner products over all other rows.

    Median splits of a sample cut the table into shards of about `shard` rows, max_shards at most; a shard of over `most` rows is
    cut further by a hash. The shards' tight boxes are broadcast, max_shards times max_parts of them at most. In a first wave each
    query visits the `first` shards whose boxes promise most; its k-th score then goes with it into the second wave, to all other
    shards that can still reach it and to no more. In a shard, a KD-tree is searched best box first from that score. Rows are shuffled
    once a wave, and again only for each further `block` queries that a shard is asked.
    """
    spark = table.sparkSession
    v = written(vectors(table, zero_too=True), "vectors")
    n = v.count()
    shards = min(max_shards, max(1, -(-n // shard)))
    sample = 16 * shards
    near = v if n <= 2 * sample else v.filter(F.pmod(F.xxhash64("vec_id", F.lit("split")), F.lit(1_000_000)) < int(1_000_000 * sample / n))
    x = matrix(near.select("v").limit(2 * sample).toArrow().column(0).combine_chunks()) if shards > 1 else np.zeros((0, 1))
    splits = spark.sparkContext.broadcast(top_splits(x, shards) if len(x) else [])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(shard_of(splits.value, matrix(b.column(1)))), *b.columns], ["shard", "vec_id", "v"])

    rows = v.mapInArrow(dealt, "shard long, vec_id long, v array<double>")
    many = rows.groupBy("shard").count().filter(F.col("count") > most).select("shard", F.ceil(F.col("count") / most).cast("long").alias("parts"))
    rows = rows.join(F.broadcast(many), "shard", "left")  # a row for each shard at most
    rows = written(rows.select((F.col("shard") * (1 << 32) + F.pmod(F.xxhash64("vec_id"), F.coalesce("parts", F.lit(1)))).alias("shard"), "vec_id", "v"), "shards")

    def boxed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box: dict = {}
        for b in batches:
            s, m = b.column(0).to_numpy(), np.floor(256 * matrix(b.column(1)))
            for i in np.unique(s):
                lo, hi = m[s == i].min(axis=0), m[s == i].max(axis=0)
                old = box.get(i, (lo, hi))
                box[i] = (np.minimum(lo, old[0]), np.maximum(hi, old[1]))
        low, high = ([x[i].tolist() for x in box.values()] for i in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(list(box), pa.int64()), pa.array(low, pa.list_(pa.float64())), pa.array(high, pa.list_(pa.float64()))], ["shard", "low", "high"])

    at = F.posexplode(F.arrays_zip("low", "high")).alias("d", "x")
    box = rows.select("shard", "v").mapInArrow(boxed, "shard long, low array<double>, high array<double>")
    box = box.select("shard", at).groupBy("shard", "d").agg(F.min("x.low").alias("low"), F.max("x.high").alias("high"))
    box = box.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("d", "low", "high"))).alias("b")).select("shard", F.col("b.low").alias("low"), F.col("b.high").alias("high")).orderBy("shard").collect()
    low, high = np.array([r["low"] for r in box]), np.array([r["high"] for r in box])
    wide = bool(len(box)) and not (low.shape[1] * max(np.abs(low).max(), np.abs(high).max()) ** 2 < 2**53)  # then products aren't exact in doubles
    shared = spark.sparkContext.broadcast((np.array([r["shard"] for r in box], np.int64), low, high))

    def routed(wave: int):
        """Rows (q, query_id, floor, v) to one for each shard that the query visits in the wave."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, low, high = shared.value
            for b in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
                reach = np.zeros((b.num_rows, len(ids))) if wide else bounds(np.floor(256 * matrix(b.column(3))), low, high)
                order = np.argsort(-reach, axis=1, kind="stable")[:, :first]
                begin = np.zeros(reach.shape, bool)
                np.put_along_axis(begin, order, True, axis=1)
                floor = b.column(2).to_numpy(zero_copy_only=False)[:, None]
                go = begin if wave == 0 else ~begin if wide else ~begin & (reach >= floor)
                q, s = np.nonzero(go)
                yield pa.RecordBatch.from_arrays([pa.array(ids[s]), *(c.take(pa.array(q)) for c in b.columns)], ["shard", "q", "query_id", "floor", "v"])

        return run

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _grouped(batches, 2):
            kind, number, ids, floor, all_ = *(t.column(i).to_numpy() for i in (2, 3, 4, 5)), matrix(t.column(6).combine_chunks())
            own, asking = ids[kind == 0], np.flatnonzero(kind == 1)
            if not len(own) or not len(asking):
                continue
            both = exact(all_)
            tree = KDTree(both[kind == 0])
            out: tuple = ([], [], [], [])
            for some in np.split(asking, range(1024, len(asking), 1024)):
                reach = tree.bounds(both[some])
                for i, b in zip(some.tolist(), reach, strict=True):
                    got = tree.search(both[i], b, own, int(ids[i]), k, float(floor[i]))
                    for o, x in zip(out, ([number[i]] * len(got), [ids[i]] * len(got), [a for _, a in got], [max(-(2**63), min(2**63 - 1, int(a))) for a, _ in got]), strict=True):
                        o += x
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["q", "query_id", "vec_id", "score"])

    def wave(ask: DataFrame, number: int) -> DataFrame:
        ask = written(ask.select("q", "query_id", "floor", "v").mapInArrow(routed(number), "shard long, q long, query_id long, floor double, v array<double>"), f"wave{number}")
        blocks = F.broadcast(ask.groupBy("shard").agg(F.ceil(F.count("*") / block).cast("long").alias("blocks")))  # a row for each shard at most
        data = rows.join(blocks, "shard").select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(0).cast("long").alias("kind"), F.lit(0).cast("long").alias("q"), "vec_id", F.lit(0.0).alias("floor"), "v")
        come = ask.join(blocks, "shard").select("shard", F.pmod(F.xxhash64("q"), "blocks").alias("block"), F.lit(1).cast("long").alias("kind"), "q", "query_id", "floor", "v")
        found = data.union(come).repartition("shard", "block").sortWithinPartitions("shard", "block", "kind").mapInArrow(search, "q long, query_id long, vec_id long, score long")
        return written(best(found, k, False), f"found{number}")

    asked = queries(rows.select("vec_id", "v"), every)
    one = wave(asked.withColumn("floor", F.lit(-float("inf"))), 0)
    floor = one.filter(F.col("rank") == k).select("q", F.col("score").cast("double").alias("floor"))
    two = wave(asked.join(floor, "q", "left").withColumn("floor", F.coalesce("floor", F.lit(-float("inf")))), 1)
    return best(one.union(two).drop("rank"), k, False).drop("q")


def op9_topk(spark, sf_dir: str) -> DataFrame:
    """Whole embeddings table; queries are the rows whose vec_id is divisible by 50: query_id, rank, vec_id, score."""
    return top_products(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 50, 5)


OP9_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS q, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.q, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, (row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
