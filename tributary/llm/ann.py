"""Approximate nearest neighbours: a hierarchical k-means tree, searched best bin first.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows without a vec_id; vectors of
different lengths raise an error. Rows that repeat a vec_id are rows of their own: each of them asks for itself, so that its id has
as many answers as rows, and a query's candidates are the rows with any other id. Fewer candidates than wanted are all returned. An
empty table gives an empty result. Only vec_id and embedding are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import written


def vectors(table: DataFrame, zero_too: bool) -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part; zero_too: zero vectors do."""
    v = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).filter("vec_id is not null and v is not null and size(v) > 0")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.filter(~F.coalesce(bad, F.lit(True)))
    if not zero_too:
        v = v.filter(F.exists("v", lambda x: x != 0))
    size = v.agg(F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most")).first()
    if size["least"] != size["most"]:
        raise ValueError(f"vectors of {size['least']} to {size['most']} components")
    return v


def queries(rows: DataFrame, every: int) -> DataFrame:
    """(q, query_id, v) of the rows whose vec_id is divisible by `every`; q is each row's own number."""
    asked = rows.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "v")
    return written(asked.withColumn("q", F.monotonically_increasing_id()).select("q", "query_id", "v"), "asked")


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def fit(x: np.ndarray, leaf: int, branch: int = 8, steps: int = 6, seed: int = 7, most: int = 8192) -> dict:
    """A tree over the sample x: arrays of each node's centre, first child and number of children (0: a leaf).

    Nodes split by k-means, level by level, until they hold `leaf` rows of the sample, can't be told apart, or there are `most` leaves.
    """
    rng = np.random.default_rng(seed)
    centre, first, count, todo, leaves = [x.mean(axis=0)], [0], [0], [(0, np.arange(len(x)))], 1
    while todo:
        node, at = todo.pop(0)
        if len(at) <= leaf or leaves + branch - 1 > most:
            continue
        rows = x[at]
        c = rows[rng.choice(len(at), min(branch, len(at)), replace=False)]
        for _ in range(steps):
            near = ((rows**2).sum(1)[:, None] - 2 * rows @ c.T + (c**2).sum(1)).argmin(1)
            used = np.unique(near)
            c = np.stack([rows[near == k].mean(axis=0) for k in used])
        near = ((rows**2).sum(1)[:, None] - 2 * rows @ c.T + (c**2).sum(1)).argmin(1)
        used = np.unique(near)
        if len(used) < 2:
            continue
        first[node], count[node] = len(centre), len(used)
        leaves += len(used) - 1
        for k in used:
            todo.append((len(centre), at[near == k]))
            centre.append(c[k])
            first.append(0)
            count.append(0)
    return {"centre": np.array(centre), "first": np.array(first), "count": np.array(count)}


def home(tree: dict, x: np.ndarray) -> np.ndarray:
    """The leaf that each row falls into, going to the nearest centre at each node."""
    at = np.zeros(len(x), np.int64)
    while len(go := np.flatnonzero(tree["count"][at] > 0)):
        for node in np.unique(at[go]):
            rows = go[at[go] == node]
            kids = slice(tree["first"][node], tree["first"][node] + tree["count"][node])
            c = tree["centre"][kids]
            at[rows] = tree["first"][node] + ((c**2).sum(1) - 2 * x[rows] @ c.T).argmin(1)
    return at


def keys(tree: dict, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of q, the two keys that order the leaves (np.flatnonzero(count == 0)) best bin first.

    A queue of nodes by distance of their centre, children replacing their node, gives a leaf when the farthest node on its way from
    the root has come up: that distance is the first key; the leaf's own parts those below one such node.
    """
    c, count = tree["centre"], tree["count"]
    own = (q**2).sum(1)[:, None] - 2 * q @ c.T + (c**2).sum(1)
    own = np.where(np.isnan(own), np.inf, own)
    way = own.copy()
    way[:, 0] = -np.inf
    at = np.array([0])
    while len(at := at[count[at] > 0]):  # a level; the children of its nodes have consecutive numbers
        up = np.repeat(at, count[at])
        at = np.arange(tree["first"][at[0]], tree["first"][at[0]] + len(up))
        way[:, at] = np.maximum(way[:, at], way[:, up])
    leaf = np.flatnonzero(count == 0)
    return way[:, leaf], own[:, leaf]


def visits(tree: dict, q: np.ndarray, most: int) -> np.ndarray:
    """Whether each row of q visits each leaf: the first `most`, best bin first."""
    way, own = keys(tree, q)
    if most >= way.shape[1]:
        return np.ones(way.shape, bool)
    last = np.partition(way, most - 1, axis=1)[:, most - 1 : most]
    out = way < last
    for i in np.arange(len(q)):
        tied = np.flatnonzero(way[i] == last[i])
        out[i, tied[np.argsort(own[i, tied], kind="stable")[: most - out[i].sum()]]] = True
    return out


def distances(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distance of q to each row; a row's value doesn't depend on the rows beside it."""
    return np.sqrt(((rows - q) ** 2).sum(axis=1))


def nearest(ids: np.ndarray, d: np.ndarray, k: int) -> np.ndarray:
    """Where the k smallest distances are, ties to the smaller id."""
    if len(d) > 4 * k:
        at = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
        return at[np.lexsort((ids[at], d[at]))[:k]]
    return np.lexsort((ids, d))[:k]


def _grouped(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[pa.Table]:
    """The rows of each key (the first `key` columns), of batches sorted by it."""
    held: list[pa.RecordBatch] = []
    now = None
    for b in batches:
        if not b.num_rows:
            continue
        k = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns[:key]])
        cut = np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1
        for i, j in zip(np.r_[0, cut], np.r_[cut, b.num_rows], strict=True):
            mine = tuple(k[:, i].tolist())
            if held and mine != now:
                yield pa.Table.from_batches(held)
                held = []
            now = mine
            held.append(b.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


def best(found: DataFrame, k: int, nearest_first: bool) -> DataFrame:
    """(q, query_id, rank, vec_id, score) of the k best of (q, query_id, vec_id, score), ties to the smaller vec_id."""
    order = F.struct((F.col("score") if nearest_first else F.bitwise_not("score")).alias("o"), "vec_id", "score")
    top = found.groupBy("q", "query_id").agg(F.slice(F.array_sort(F.collect_list(order)), 1, k).alias("top"))
    return top.select("q", "query_id", F.posexplode("top").alias("p", "x")).select("q", "query_id", (F.col("p") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")


def bins(size: dict[int, int], most: int) -> list[tuple[int, int, int]]:
    """(first leaf, last leaf, part) of each bin of neighbouring leaves with some `most` rows at most; leaves of more are cut into parts, a bin each."""
    out: list[tuple[int, int, int]] = []
    held = 0
    for leaf, n in sorted(size.items()):
        if n > most:
            out += [(leaf, leaf, part) for part in range(-(-n // most))]
        elif held and held + n <= most:
            out[-1] = (out[-1][0], leaf, 0)
        else:
            out.append((leaf, leaf, 0))
            held = 0
        held = 0 if n > most else held + n
    return out


def distinct(leaf: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Whether rows are needed for a query's k nearest, ties to the smaller id: not where their leaf has k equal rows of smaller ids, whichever id is the query's."""
    words = np.ascontiguousarray(x).view(np.uint32)
    mix = np.random.default_rng(5).integers(1, 2**63, words.shape[1]).astype(np.uint64) | np.uint64(1)
    h = np.concatenate([(words[i : i + 8192] * mix).sum(axis=1, dtype=np.uint64) for i in range(0, len(x), 8192)])
    order = np.lexsort((ids, h, leaf))
    h, n, at = h[order], ids[order], leaf[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (at[1:] != at[:-1])]
    other = new | np.r_[True, n[1:] != n[:-1]]
    start, place = np.flatnonzero(new)[np.cumsum(new) - 1], np.arange(len(h))
    turn = np.cumsum(other)
    spare = (turn - turn[start] > k) | (place - np.flatnonzero(other)[turn - 1] >= k)
    group = np.flatnonzero(np.isin(start, start[spare]))
    false = ~(x[order[group]] == x[order[start[group]]]).all(axis=1)
    spare &= ~np.isin(start, start[group[false]])  # where only the hashes are equal, all stay
    keep = np.ones(len(x), bool)
    keep[order[spare]] = False
    return keep


class Bin:
    """Rows of some leaves, and the k nearest that each of many queries finds in those that it visits.

    A product in single precision, of a bounded block at a time, rules out rows that are farther than a query's k-th so far by more
    than its rounding; the others are measured in double precision, so the result doesn't depend on it.
    """

    def __init__(self, leaf: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int):
        keep = distinct(leaf, ids, x, k)
        self.leaf, self.ids, self.x, self.k = leaf[keep], ids[keep], x[keep], k
        self.slack = 8 * (x.shape[1] + 2) * 2.0**-24
        norm = np.concatenate([(self.x[i : i + 8192].astype(np.float64) ** 2).sum(axis=1) for i in range(0, len(self.x), 8192)])
        self.plain = self.sound(norm)
        self.norm = norm * (1 - self.slack)

    @staticmethod
    def sound(norm: np.ndarray) -> bool:
        """Whether single precision neither overflows nor underflows."""
        return bool(((norm > 1e-30) & (norm < 1e30)).all())

    def near(self, q: np.ndarray, me: np.ndarray, asks: np.ndarray, lo: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, distance) of the k nearest of each query (q, own id me), which asks for leaf lo + i if asks[:, i]."""
        norm = (q.astype(np.float64) ** 2).sum(axis=1)
        plain = self.plain and self.sound(norm)
        base, limit = norm * (1 - self.slack), np.full(len(q), np.inf)
        minus = (-2 * q).astype(np.float32) if plain else q
        best: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        held, size, step = [], 0, max(1, (1 << 20) // q.shape[1])

        def merge() -> None:
            nonlocal held, size
            for c, r in held:
                for i in range(0, len(c), step):
                    best.append((a := c[i : i + step], self.ids[b := r[i : i + step]], distances(self.x[b].astype(np.float64), q[a].astype(np.float64))))
                    if sum(len(t[0]) for t in best) > 4 * self.k * len(q) + 65536:
                        cut()
            held, size = [], 0
            cut()

        def cut() -> None:
            c, n, d = (np.concatenate(t) for t in zip(*best, strict=True))
            order = np.lexsort((n, d, c))
            c, n, d = c[order], n[order], d[order]
            start = np.flatnonzero(np.r_[True, c[1:] != c[:-1]]) if len(c) else np.zeros(0, np.int64)
            place = np.arange(len(c)) - np.repeat(start, np.diff(np.r_[start, len(c)]))
            full = place == self.k - 1
            limit[c[full]] = np.minimum(limit[c[full]], d[full] ** 2)
            best[:] = [(c[place < self.k], n[place < self.k], d[place < self.k])]

        edge = np.r_[np.flatnonzero(np.r_[True, self.leaf[1:] != self.leaf[:-1]]), len(self.leaf)]
        for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            asking = np.flatnonzero(asks[:, self.leaf[i] - lo])
            for a in range(i, j, 2048):
                b = min(j, a + 2048)
                rows, own = self.x[a:b].astype(np.float32, copy=False) if plain else None, self.ids[a:b]
                mine = np.flatnonzero(np.isin(own, me[asking]))
                for at in range(0, len(asking), 1024):
                    c = asking[at : at + 1024]
                    if plain:
                        far = minus[c] @ rows.T
                        far += self.norm[a:b].astype(np.float32)
                        far[:, mine] = np.where(me[c][:, None] == own[mine], np.float32(np.inf), far[:, mine])
                        free = np.flatnonzero(np.isinf(limit[c])) if b - a > self.k else c[:0]
                        if len(free):  # the k-th of these rows, and what rounding can add
                            kth = np.partition(far[free], self.k - 1, axis=1)[:, self.k - 1].astype(np.float64)
                            limit[c[free]] = (kth + base[c[free]]) + 3 * self.slack * (self.norm[a:b].max() + norm[c[free]])
                        top = limit[c] * (1 + self.slack / 8) - base[c]
                        hit = far <= np.nextafter(top.astype(np.float32), np.float32(np.inf))[:, None]
                        hit[:, mine] &= me[c][:, None] != own[mine]
                    else:
                        hit = me[c][:, None] != own
                    flat = np.flatnonzero(hit)
                    held.append((c[flat // (b - a)], a + flat % (b - a)))
                    size += len(flat)
                    if size > max(65536, len(q) * self.k // 2):
                        merge()
        merge()
        return best[0]


def searched(rows: DataFrame, asked: DataFrame, tree: dict, leaves: int, k: int, most: int | None = None) -> DataFrame:
    """The k nearest of rows (leaf, vec_id, v) for each of asked (q, query_id, v), in `leaves` leaves each.

    Neighbouring leaves share a bin, which is a task's and is held in memory: `most` rows, by default what makes 64 bins, within 4,096
    rows and 32 MB. A query goes once to each bin that holds leaves it visits, with a bit for each leaf, and passes through in batches.
    """
    spark = rows.sparkSession
    kind = rows.schema["v"].dataType.simpleString()
    size = {r["leaf"]: r["count"] for r in rows.groupBy("leaf").count().collect()}  # a row for each leaf at most
    if most is None:
        wide = (4 if kind == "array<float>" else 8) * tree["centre"].shape[1]
        most = max(1, min(max(4096, sum(size.values()) // 64), (32 << 20) // wide))
    cut = bins(size, most)
    where: dict[int, tuple[int, int]] = {}  # a leaf's first bin and its parts
    for b, (lo, hi, part) in enumerate(cut):
        for leaf in range(lo, hi + 1):
            where[leaf] = (where[leaf][0] if part else b, part + 1)
    shared = spark.sparkContext.broadcast((tree, cut))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, cut = shared.value
        leaf = np.flatnonzero(tree["count"] == 0)
        span = [(np.searchsorted(leaf, lo), np.searchsorted(leaf, hi) + 1) for lo, hi, _ in cut]
        step = max(1, min(128, 16384 // max(1, len(cut))))
        for whole in batches if cut else ():
            for i in range(0, whole.num_rows, step):
                b = whole.slice(i, step)
                seen = visits(tree, matrix(b.column(2)).astype(np.float64), leaves)
                n, at, bits, long = [], [], [], []
                for k, (lo, hi) in enumerate(span):
                    mine = seen[:, lo:hi]
                    who = np.flatnonzero(mine.any(axis=1))
                    packed = np.packbits(mine[who], axis=1)
                    n.append(np.full(len(who), k, np.int32))
                    at.append(who)
                    bits.append(packed.ravel())
                    long.append(np.full(len(who), packed.shape[1]))
                at, offsets = np.concatenate(at), np.cumsum(np.r_[0, np.concatenate(long)]).astype(np.int32)
                column = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(np.concatenate(bits))])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(n)), column, *(c.take(pa.array(at)) for c in b.columns)], ["bin", "bits", "q", "query_id", "v"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, cut = shared.value
        leaf = np.flatnonzero(tree["count"] == 0)
        held, now, number = [], None, -1
        for b in batches:
            if not b.num_rows:
                continue
            kind = b.column(1).to_numpy()
            edge = int(np.searchsorted(kind, 1))  # a partition is a bin, its rows before its queries
            if edge:
                number = b.column(0)[0].as_py()
                r = b.slice(0, edge)
                held.append((r.column(2).to_numpy().copy(), r.column(4).to_numpy().copy(), matrix(r.column(6)).copy()))
            if edge == b.num_rows or (now is None and not held):  # a part of a leaf can be empty
                continue
            if now is None:
                parts = list(zip(*held, strict=True))
                held = []
                at, ids = np.searchsorted(leaf, np.concatenate(parts[0])), np.concatenate(parts[1])
                now = Bin(at, ids, np.concatenate(parts[2]), k)
                lo, hi = np.searchsorted(leaf, cut[number][0]), np.searchsorted(leaf, cut[number][1]) + 1
                del parts, at, ids
            ask = b.slice(edge)
            own, me = ask.column(3).to_numpy(), ask.column(4).to_numpy()
            bits = np.frombuffer(b"".join(ask.column(5).to_pylist()), np.uint8).reshape(ask.num_rows, -1)
            c, n, d = now.near(matrix(ask.column(6)), me, np.unpackbits(bits, axis=1, count=hi - lo).astype(bool), lo)
            first = np.flatnonzero(np.r_[True, c[1:] != c[:-1]]) if len(c) else np.zeros(0, np.int64)
            offsets = pa.array(np.r_[first, len(c)].astype(np.int32))
            found = pa.StructArray.from_arrays([pa.array(d), pa.array(n)], ["score", "vec_id"])
            yield pa.RecordBatch.from_arrays([pa.array(own[c[first]]), pa.array(me[c[first]]), pa.ListArray.from_arrays(offsets, found)], ["q", "query_id", "found"])

    none = F.lit(None).cast("binary")
    places = spark.createDataFrame([(leaf, b, parts) for leaf, (b, parts) in where.items()] or [(0, 0, 1)], "leaf long, first int, parts int")  # a row for each leaf at most
    data = rows.join(F.broadcast(places), "leaf")
    data = data.select((F.col("first") + F.pmod(F.xxhash64("vec_id"), "parts")).cast("int").alias("bin"), F.lit(0).alias("kind"), "leaf", F.lit(0).cast("long").alias("q"), F.col("vec_id").alias("id"), none.alias("bits"), "v")
    ask = asked.mapInArrow(route, f"bin int, bits binary, q long, query_id long, v {kind}")
    ask = ask.select("bin", F.lit(1).alias("kind"), F.lit(-1).cast("long").alias("leaf"), "q", F.col("query_id").alias("id"), "bits", "v")
    both = data.union(ask).repartitionById(max(1, len(cut)), F.col("bin")).sortWithinPartitions("kind", "leaf")
    found = both.mapInArrow(search, "q long, query_id long, found array<struct<score: double, vec_id: long>>")
    top = found.repartition("q", "query_id").groupBy("q", "query_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k).alias("top"))
    return top.select("q", "query_id", F.posexplode("top").alias("p", "x")).select("q", "query_id", (F.col("p") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")


def indexed(v: DataFrame, tree: dict) -> DataFrame:
    """(leaf, vec_id, v) of every row."""
    shared = v.sparkSession.sparkContext.broadcast(tree)
    kind = v.schema["v"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(home(shared.value, matrix(b.column(1)).astype(np.float64)), pa.int64()), *b.columns], ["leaf", "vec_id", "v"])

    return v.select("vec_id", "v").mapInArrow(run, f"leaf long, vec_id long, v {kind}")


def calibrated(rows: DataFrame, tree: dict, probes: int, k: int, recall: float, margin: float) -> int:
    """The leaves that a query must visit: widened until the probes find `recall` plus margin of their true neighbours.

    The probes are a fixed number of rows; each task compares them with all its rows and keeps their k nearest with the leaves these
    are in, so brute force over the whole table takes one pass.
    """
    spark = rows.sparkSession
    ask = rows.orderBy(F.xxhash64("vec_id", F.lit("probe")), "vec_id").limit(probes).select("vec_id", "v").collect()
    pids, pv = np.array([r["vec_id"] for r in ask]), np.array([r["v"] for r in ask])
    shared = spark.sparkContext.broadcast((pids, pv))

    def truth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pids, pv = shared.value
        for b in batches:
            leaf, ids, x = b.column(0).to_numpy(), b.column(1).to_numpy(), matrix(b.column(2))
            out = ([], [], [], [])
            for q, (me, y) in enumerate(zip(pids, pv, strict=True)):
                use, d = np.flatnonzero(ids != me), distances(x, y)
                at = use[nearest(ids[use], d[use], k)]
                for o, c in zip(out, (np.full(len(at), q), ids[at], d[at], leaf[at]), strict=True):
                    o.append(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o)) for o in out], ["q", "vec_id", "score", "leaf"])

    near = rows.mapInArrow(truth, "q long, vec_id long, score double, leaf long")
    top = near.groupBy("q").agg(F.slice(F.array_sort(F.collect_list(F.struct("score", "vec_id", "leaf"))), 1, k).alias("top")).collect()
    where = {r["q"]: [x["leaf"] for x in r["top"]] for r in top}
    n = int((tree["count"] == 0).sum())
    needed = np.zeros(n + 1)
    way, own = keys(tree, pv)
    at = np.flatnonzero(tree["count"] == 0)
    for q in range(len(pv)):
        place = dict(zip(at[np.lexsort((own[q], way[q]))].tolist(), range(1, n + 1), strict=True))
        for leaf in where.get(q, []):
            needed[place[leaf]] += 1
    share = np.cumsum(needed) / max(1, needed.sum())
    return int(min(n, max(1, np.searchsorted(share, min(1.0, recall + margin)))))


def neighbours(table: DataFrame, every: int, k: int, recall: float = 0.95, margin: float = 0.02, sample: int = 20_000, leaf_rows: int = 256, probes: int = 64, max_leaves: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vec_id divisible by `every`, its k nearest found, by Euclidean distance.

    The tree is fitted on `sample` rows at most, and holds max_leaves leaves at most, which bounds what is broadcast; every row is
    put into its leaf. The number of leaves to visit comes from calibrated().
    """
    v = vectors(table, zero_too=False)
    if table.schema["embedding"].dataType.simpleString() == "array<float>":  # half the bytes of doubles, and the same numbers
        v = v.withColumn("v", F.col("v").cast("array<float>"))
    n = v.count()
    part = v if n <= sample else v.filter(F.pmod(F.xxhash64("vec_id", F.lit("fit")), F.lit(1_000_000)) < int(1_000_000 * sample / n))
    x = matrix(part.select("v").limit(2 * sample).toArrow().column(0).combine_chunks()).astype(np.float64)
    if not len(x):
        return best(v.select(F.lit(0).cast("long").alias("q"), F.col("vec_id").alias("query_id"), "vec_id", F.lit(0.0).alias("score")), k, True).drop("q")
    tree = fit(x, max(2, int(max(leaf_rows * min(1.0, len(x) / n), len(x) / max_leaves))))
    rows = written(indexed(v, tree), "index")
    leaves = calibrated(rows, tree, probes, k, recall, margin)
    return searched(rows, queries(rows, every), tree, leaves, k).drop("q")


def op3_ann(spark, sf_dir: str) -> DataFrame:
    """Whole embeddings table; queries are the rows whose vec_id is divisible by 100: query_id, rank, vec_id, score."""
    return neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 100, 10)
