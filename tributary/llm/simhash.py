"""SimHash near-duplicates: 64-bit fingerprints, BK-trees over shards, connected components.

Null and empty texts have no words and the fingerprint zero, which links like any other. Repeated rows of one doc_id each give a
row. An empty table gives an empty result. Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest, xxh64_intdigest

from tributary.llm.common import Sieve, connected_components, evict, give_back, written

SEED = 42
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_BYTE = np.arange(8) * 256


def words(text: str | None) -> list[bytes]:
    """The words of a text, with A-Z in lower case: bytes.lower and bytes.split know ASCII only, as is wanted here."""
    return text.encode().lower().split() if text else []


def shingle_hashes(w: list[bytes], k: int) -> np.ndarray:
    """XXH64 of each run of k words, or of all words if they are fewer."""
    n = len(w) - k + 1
    if n < 1:
        return np.array([xxh64_intdigest(b" ".join(w), SEED)] if w else [], dtype=np.uint64)
    return np.fromiter(map(xxh64_intdigest, map(b" ".join, zip(*(w[i:] for i in range(k)), strict=False)), repeat(SEED)), np.uint64, n)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that are set in over half the hashes, as a signed 64-bit number."""
    if not len(hashes):
        return 0
    seen = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _BYTE).ravel(), minlength=2048).reshape(8, 256)
    ones = np.einsum("ij,jk->ik", seen, _BITS).ravel() * 2 > len(hashes)
    return int(np.packbits(ones, bitorder="little").view(np.int64)[0])


def fingerprints(documents: DataFrame, k: int = 3) -> DataFrame:
    """(doc_id, fp): a narrow pass over the whole texts, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [fingerprint(shingle_hashes(words(t.as_py()), k)) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], ["doc_id", "fp"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


class BKTree:
    """Children hang at their Hamming distance from the parent's key; a search follows the edges within the radius.

    Many queries descend together: at each node those remain whose distance to its key admits the edge. Up to LEAF keys stay in
    a bucket, where the distances are taken directly.
    """

    LEAF = 8

    def __init__(self, keys: np.ndarray):
        self.keys = keys.view(np.uint64)  # of a negative number, numpy counts the bits of its absolute value
        self.root = self._node(np.arange(len(keys)))

    def _node(self, at: np.ndarray):
        top: list = []
        todo = [(at, top)]
        while todo:
            at, out = todo.pop()
            if len(at) <= self.LEAF:
                out.append(at)
                continue
            d = np.bitwise_count(self.keys[at[1:]] ^ self.keys[at[0]])
            if not d.any():
                out.append(at)
                continue
            edges: dict[int, list] = {}
            out.append((at[0], edges))
            for e in np.unique(d):
                edges[int(e)] = []
                todo.append((at[1:][d == e], edges[int(e)]))
        return top[0]

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index arrays (query, key) of the pairs within the radius, in pieces."""
        queries = queries.view(np.uint64)
        todo = [(self.root, np.arange(len(queries)))]
        while todo:
            node, q = todo.pop()
            if isinstance(node, np.ndarray):
                step = max(1, 2_000_000 // max(1, len(node)))
                for i in range(0, len(q), step):
                    a, b = np.nonzero(np.bitwise_count(queries[q[i : i + step], None] ^ self.keys[node]) <= radius)
                    if len(a):
                        yield q[i : i + step][a], node[b]
                continue
            at, edges = node
            d = np.bitwise_count(queries[q] ^ self.keys[at]).astype(np.int64)
            if len(hit := q[d <= radius]):
                yield hit, np.full(len(hit), at)
            for e, child in edges.items():
                if len(near := q[np.abs(d - e) <= radius]):
                    todo.append((child[0], near))


def merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the components of a[i] and b[i] in labels, in which each is named by its smallest index."""
    while len(a):
        x, y = labels[a], labels[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while (up := labels[labels]).tobytes() != labels.tobytes():
            labels[:] = up


def _linked(keys: np.ndarray, left: np.ndarray | None, radius: int) -> Iterator[tuple[int, int]]:
    """Edges from each key to the smallest index of its component. left: where the tree's keys are; the others are the queries."""
    labels = np.arange(len(keys))
    tree, ask = (labels, labels) if left is None else (np.flatnonzero(left), np.flatnonzero(~left))
    tree, ask = tree.copy(), ask.copy()
    if len(tree) and len(ask):
        for q, t in BKTree(keys[tree]).search(keys[ask], radius):
            merge(labels, ask[q], tree[t])
    for i in np.flatnonzero(labels != np.arange(len(keys))):
        yield int(keys[i]), int(keys[labels[i]])


def _by_shard(radius: int):
    """mapInArrow function: rows (block, value, i, j, part, fp) sorted by the first four, to edges (a, b)."""

    def edges(n: np.ndarray) -> tuple[list, list]:
        a, b = [], []
        key = n[:4]
        cut = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0), True])
        size = np.diff(cut)
        for s in cut[:-1][size == 2]:
            x, y = int(n[5, s]), int(n[5, s + 1])
            if ((x ^ y) & 0xFFFFFFFFFFFFFFFF).bit_count() <= radius:
                a.append(x)
                b.append(y)
        for s, m in zip(cut[:-1][size > 2], size[size > 2], strict=True):
            g = n[:, s : s + m]
            for x, y in _linked(g[5], None if g[2, 0] == g[3, 0] else g[4] == g[2, 0], radius):
                a.append(x)
                b.append(y)
        return a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((6, 0), np.int64)
        for batch in batches:
            held = np.concatenate([held, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])], axis=1)
            if not held.shape[1]:
                continue
            last = np.flatnonzero((held[:4] != held[:4, -1:]).any(axis=0))
            at = last[-1] + 1 if len(last) else 0  # the last shard may go on in the next batch
            a, b = edges(held[:, :at]) if at else ([], [])
            held = held[:, at:]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        if held.shape[1]:
            a, b = edges(held)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def in_parts(shards: DataFrame, key: list[str], salt: str, most: int) -> DataFrame:
    """Adds i, j, part: a shard of over `most` rows is cut into parts by a hash of `salt`, and each pair of parts is a task of its own."""
    big = shards.groupBy(*key).count().filter(F.col("count") > most).select(*key, F.ceil(F.col("count") / most).cast("long").alias("parts"))
    cut = shards.join(big, key, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    cut = cut.withColumn("part", F.pmod(F.xxhash64(salt), F.col("parts"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    return cut.withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other")).drop("parts", "other")


def block_keys(fp: str, radius: int, blocks: int, bits: int):
    """Array of (block, value): two fingerprints within the radius agree in at least one. Of the blocks, all but radius agree; a value has `bits` bits of these."""
    edge = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for n, kept in enumerate(combinations(range(blocks), blocks - radius)):
        places = sorted((p - edge[i], p) for i in kept for p in range(edge[i], edge[i + 1]))[:bits]
        mask = sum(1 << p for _, p in places)
        signed = mask - (1 << 64) if mask >> 63 else mask
        keys.append(F.struct(F.lit(n).cast("long").alias("block"), F.col(fp).bitwiseAND(F.lit(signed).cast("long")).alias("value")))
    return F.array(*keys)


def links(fps: DataFrame, radius: int = 3, size: int = 1024, most: int = 4096) -> DataFrame:
    """Edges (a, b) that join the distinct fingerprints within the radius into their components; no pair is missed.

    A shard holds the fingerprints that agree in some bits of one block out of radius + 1, as many bits as give shards of about
    `size` fingerprints; when a block has too few bits, in those of two blocks out of radius + 2, and so on. So the work grows with the
    fingerprints and not with their square. The trees of the shards are built in the tasks that hold them, since together they grow
    with the corpus and can't be broadcast.
    """
    bits, blocks = max(0, int(max(1, fps.count()) / size).bit_length()), radius + 1
    while blocks < 64 and (blocks - radius) * (64 // blocks) < min(bits, 40):
        blocks += 1
    shards = fps.select("fp", F.explode(block_keys("fp", radius, blocks, bits)).alias("k")).select("k.block", "k.value", "fp")
    rows = in_parts(shards, ["block", "value"], "fp", most).select("block", "value", "i", "j", "part", "fp")
    return rows.repartition("block", "value", "i", "j").sortWithinPartitions("block", "value", "i", "j").mapInArrow(_by_shard(radius), "a long, b long")


def components(documents: DataFrame, k: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id that links reach, null doc_ids aside."""
    docs = written(fingerprints(documents, k), "fingerprints")
    fps = written(docs.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    root = written(connected_components(links(fps, radius)), "roots")
    own = fps.join(root.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    named = own.join(own.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return docs.join(named, "fp").select("doc_id", "fp", "component_id")


# ---- near-duplicates by similarity of shingles

ROWS, BANDS = 4, 24
_RNG = np.random.default_rng(SEED)
_MULTIPLY = _RNG.integers(1, 2**63, ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 2**63, ROWS * BANDS, dtype=np.uint64)


def band_keys(hashes: np.ndarray) -> list[int]:
    """A key for each band of ROWS minima under random permutations, as signed numbers."""
    low = np.full(ROWS * BANDS, np.iinfo(np.uint64).max)
    for i in range(0, len(hashes), 8192):
        low = np.minimum(low, (np.multiply.outer(_MULTIPLY, hashes[i : i + 8192]) + _ADD[:, None]).min(axis=1))
    return [xxh64_intdigest(b.tobytes(), n) - (1 << 63) for n, b in enumerate(low.reshape(BANDS, ROWS))]


def signatures(documents: DataFrame, k: int) -> DataFrame:
    """(doc_id, key, same, fp, size, bands): same is a digest of all words in their order, equal for exact copies only; fp and size are of the distinct shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evict()
        for b in batches:
            same, fp, size, bands = [], [], [], []
            for t in b.column(2):
                w = words(t.as_py())
                h = np.unique(shingle_hashes(w, k))
                same.append(xxh3_128_digest(b" ".join(w)))
                fp.append(fingerprint(h))
                size.append(len(h))
                bands.append(band_keys(h) if len(h) else [])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(same, pa.binary()), pa.array(fp, pa.int64()), pa.array(size, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "key", "same", "fp", "size", "bands"])

    return documents.select(_id("doc_id"), _key("text"), "text").mapInArrow(run, "doc_id long, key binary, same binary, fp long, size long, bands array<long>")


def _id(c: str) -> F.Column:
    """A null doc_id counts as the smallest."""
    return F.coalesce(F.col(c).cast("long"), F.lit(-(1 << 63))).alias("doc_id")


def _key(c: str) -> F.Column:
    """With doc_id it names a row: rows that have both in common have the same text. Null is like an empty text."""
    return F.unhex(F.md5(F.coalesce(F.col(c), F.lit("")).cast("binary"))).alias("key")


def _row() -> F.Column:
    return F.xxhash64("doc_id", "key")


def shingle_sets(documents: DataFrame, k: int, wanted: Sieve) -> DataFrame:
    """(doc_id, key, shingles) of those rows (doc_id, key, text) that pass: the distinct hashes in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evict()
        for b in batches:
            b = b.filter(pa.array(wanted.passes(b.column(0).to_numpy())))
            out = [np.unique(shingle_hashes(words(t.as_py()), k)).tobytes() for t in b.column(3)]
            yield pa.RecordBatch.from_arrays([*b.columns[1:3], pa.array(out, pa.binary())], ["doc_id", "key", "shingles"])
        evict()

    return documents.select(_row().alias("h"), "doc_id", "key", "text").mapInArrow(run, "doc_id long, key binary, shingles binary")


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each task of in_parts, keyed by the first three columns (band key, i, j)."""
    held: list[pa.RecordBatch] = []
    now = None
    for b in batches:
        if not b.num_rows:
            continue
        key = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns[:3]])
        cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        for i, j in zip(np.r_[0, cut], np.r_[cut, b.num_rows], strict=True):
            mine = tuple(key[:, i].tolist())
            if held and mine != now:
                yield pa.Table.from_batches(held)
                held = []
            now = mine
            held.append(b.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


def _sides(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Where the tree's keys and the queries are: all rows for a part with itself, else one part each."""
    i, j, part = (t.column(c).to_numpy() for c in ("i", "j", "part"))
    return (np.arange(len(i)),) * 2 if i[0] == j[0] else (np.flatnonzero(part == i[0]), np.flatnonzero(part == j[0]))


def _near(similarity: float):
    """mapInArrow function: the rows that have another one in their shard whose size lets the two be similar enough."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evict()
        for t in _shards(batches):
            if t.num_rows < 2:
                continue
            size, sides = t.column("size").to_numpy(), _sides(t)
            hit = np.zeros(len(size), bool)
            for mine, others in (sides, sides[::-1]):
                n, other = size[mine], np.sort(size[others])
                low, high = np.searchsorted(other, n * (similarity - 1e-6)), np.searchsorted(other, n / (similarity - 1e-6), "right")
                hit[mine] |= high - low > (1 if mine is others else 0)  # a row of the same part finds itself
            if hit.any():
                yield from t.filter(pa.array(hit)).to_batches()

    return near


def shared(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many hashes each of the others has in common with one; all are distinct and in order, and none is empty."""
    flat = np.concatenate(others)
    hit = one[np.minimum(np.searchsorted(one, flat), len(one) - 1)] == flat
    return np.add.reduceat(hit, np.cumsum([0, *map(len, others[:-1])]), dtype=np.int64)


def _verified(radius: int, similarity: float, piece: int = 1_000_000):
    """mapInArrow function: edges (a, b) to the first row of each component of pairs that are similar enough.

    Pairs within the radius come first, since most of what is linked is among them. Then every other pair is verified whose
    sizes admit the similarity and whose rows aren't in one component yet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evict()
        for t in _shards(batches):
            fp, ids, (tree, ask) = t.column("fp").to_numpy(), t.column("id").to_numpy(), _sides(t)
            sets = [np.frombuffer(x, np.uint64) for x in t.column("shingles").to_pylist()]
            size = np.fromiter(map(len, sets), np.int64, len(sets))
            root = np.arange(len(ids))

            def join(a: int, others: np.ndarray, root=root, sets=sets, size=size) -> None:
                both = shared(sets[a], [sets[x] for x in others])
                for x in others[both >= similarity * (size[a] + size[others] - both)]:
                    if (r := root[a]) != (q := root[x]):
                        root[root == max(r, q)] = min(r, q)

            def fit(a: int, others: np.ndarray, root=root, size=size) -> np.ndarray:
                return others[(root[others] != root[a]) & (np.minimum(size[others], size[a]) >= similarity * np.maximum(size[others], size[a]))]

            for q, x in BKTree(fp[tree]).search(fp[ask], radius) if len(tree) and len(ask) else []:
                for a, b in zip(ask[q].tolist(), tree[x], strict=True):
                    if a != b and len(b := fit(a, np.array([b]))):
                        join(a, b)
            for a in ask.tolist() if (root != root[0]).any() else []:
                far = fit(a, tree[tree > a] if tree is ask else tree)
                for cut in np.split(far, np.flatnonzero(np.diff(np.cumsum(size[far]) // piece)) + 1) if len(far) else []:
                    join(a, cut)
            linked = np.flatnonzero(root != np.arange(len(ids)))
            if len(linked):
                yield pa.RecordBatch.from_arrays([pa.array(ids[linked], pa.int64()), pa.array(ids[root[linked]], pa.int64())], ["a", "b"])

    return run


def near_duplicates(documents: DataFrame, k: int = 5, similarity: float = 0.8, radius: int = 24, most: int = 512, early: int = 4) -> DataFrame:
    """(doc_id, key, keeper) of every document but the first by doc_id and key of its group; keeper is the first one's doc_id.

    key is a digest of the text. Groups are of texts, each of which has an id of its own, so a doc_id that is null or that different
    texts share links nothing.

    Documents are linked if their words are the same, or if the Jaccard similarity of their distinct shingles of k words is at
    least `similarity`; a group is what links connect. At 0.8, fingerprints differ in ten bits or so, too many for blocks of equal
    bits, so a shard holds the documents that agree in a band of minima, which a pair at 0.8 misses once in some 300,000 times.
    Every pair of a shard whose sizes admit the similarity is verified on the shingles themselves, unless its rows are linked
    already; a BK-tree over the fingerprints of distinct shingles gives the pairs within the radius first. The `early` bands come
    first and link most of what is alike; of the others, only shards get shingles whose rows aren't all linked to one row so far.
    """
    docs = documents.select(_id("doc_id"), _key("text"), "text")
    sig = written(signatures(documents, k), "signatures")
    first = sig.groupBy("same").agg(F.min(F.struct("doc_id", "key")).alias("least"), F.first("fp").alias("fp"), F.first("size").alias("size"), F.first("bands").alias("bands"))
    first = written(first.withColumn("id", F.monotonically_increasing_id()), "first")
    columns = ["band", "i", "j", "part", "id", "fp", "size"]

    def wave(bands: F.Column, root: DataFrame | None) -> DataFrame:
        """The edges (a, b) that the shards of these bands give."""
        shards = first.select(F.explode(bands).alias("band"), "id", "fp", "size")
        if root is not None:
            mixed = shards.join(root, F.col("id") == F.col("node"), "left").select("band", F.coalesce("root", "id").alias("root"))
            mixed = mixed.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("band")
            shards = shards.join(mixed, "band", "left_semi")
        rows = in_parts(shards, ["band"], "id", most).select(columns)
        near = rows.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j").mapInArrow(_near(similarity), "band long, i long, j long, part long, id long, fp long, size long")
        near = written(near, "near")
        asked = written(first.join(near.select("id").distinct(), "id", "left_semi").select("id", "least.doc_id", "least.key"), "asked")
        held = shingle_sets(docs, k, Sieve(asked.select(_row().alias("h")))).join(asked, ["doc_id", "key"])  # texts stay where they are
        whole = near.join(held.dropDuplicates(["id"]), "id").select("band", "i", "j", "part", "id", "fp", "shingles")
        edges = whole.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j").mapInArrow(_verified(radius, similarity), "a long, b long")
        return written(edges, "edges")

    one = wave(F.slice("bands", 1, early), None)
    give_back(docs.sparkSession)
    ends = one.select(F.col("a").alias("node"), F.col("b").alias("root")).union(one.select("b", "b"))  # what a row is linked to so far: not its whole group, but of it
    two = wave(F.slice("bands", early + 1, BANDS), written(ends.groupBy("node").agg(F.min("root").alias("root")), "ends"))
    give_back(docs.sparkSession)
    root = written(connected_components(one.union(two)), "roots")
    group = written(first.join(root, F.col("id") == F.col("node"), "left").select("same", "least", F.coalesce("root", "id").alias("root")), "groups")
    group = group.select("same", "root").join(group.groupBy("root").agg(F.min("least").alias("least")), "root").select("same", "least")
    return sig.select("doc_id", "key", "same").join(group, "same").filter(F.struct("doc_id", "key") != F.col("least")).select("doc_id", "key", F.col("least.doc_id").alias("keeper")).distinct()


def deduplicated(documents: DataFrame, k: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of documents, with all their columns, but one of each group only; of rows that repeat a doc_id and its text, one.

    Rows that are neither removed nor repeated aren't shuffled, except for the few that pass the sieve by chance.
    """
    gone = written(near_duplicates(documents, k, similarity).select("doc_id", "key"), "gone")
    repeated = documents.select(_id("doc_id"), _key("text")).groupBy("doc_id", "key").count().filter("count > 1").select("doc_id", "key")
    doubtful = Sieve(written(gone.union(repeated).select(_row().alias("h")), "doubtful"))
    rows = documents.select(F.struct("*").alias("whole"), _id("doc_id"), _key("text")).withColumn("doubt", doubtful.column(_row()))
    kept = rows.filter("doubt").join(gone, ["doc_id", "key"], "left_anti").dropDuplicates(["doc_id", "key"])
    return rows.filter("not doubt").select("whole.*").union(kept.select("whole.*"))


def op2_simhash(spark, sf_dir: str) -> DataFrame:
    """Whole documents table: doc_id, fingerprint, component_id."""
    found = components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
