"""Quality classifier: an interpolated modified Kneser-Ney model of characters, trained on trusted text.

Trusted documents give counts of n-grams over any code points, so the model grows with what is trusted. Scoring joins the sharded
model with the distinct n-grams of each chunk of documents, some tens of megabytes of whole texts in the shared folder: n-grams and
their probabilities travel, texts don't. Every document gets a perplexity, and is kept unless that exceeds its language's limit, a
quantile over the trusted documents that the model hasn't seen.

Null and empty texts have no perplexity (null) and are kept = false, since there is nothing to train on in them. Null is a language
like any other. Repeated rows of a document count as often as they come, and labels that disagree on one trust it if any does. A
text at the limit itself is kept. Very long texts are counted and scored in segments that overlap by the context, so that the result
is that of the whole. An empty table gives an empty result; without trusted rows everything that has text is kept. Only the named
columns are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import Sieve, evict, scratch, small_table, written

ORDER = 5
#: Before a text stand ORDER - 1 of this symbol, which isn't a code point and is never predicted.
START = 0x110000
#: An n-gram's key has so many bits. A foreign n-gram takes a model's place once in 2 ** KEY / (the model's n-grams).
KEY = 48
#: Costs are sent as whole numbers of this fraction of a bit; ABSENT stands for none.
FRACTION, ABSENT = 1024, 0xFFFF
#: Bits of a character that the model has never seen, beside the weight of the unseen: any code point alike.
UNSEEN = float(np.log2(START))


def segments(texts: list[str | None], most: int = 250_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(symbols, at, owner) of runs of about `most` characters: at tells where symbols has characters of the texts, owner of which.

    Before each of a segment's characters stand ORDER - 1 others or START.
    """
    part, where, owner, size = [], [], [], 0
    for i, t in enumerate(texts):
        if not t:
            continue
        whole = np.concatenate([np.full(ORDER - 1, START, np.uint32), np.frombuffer(t.encode("utf-32-le", "replace"), np.uint32)])
        for s in range(0, len(whole) - ORDER + 1, most):
            cut = whole[s : s + most + ORDER - 1]
            where.append(np.arange(size + ORDER - 1, size + len(cut)))
            owner.append(np.full(len(cut) - ORDER + 1, i))
            part.append(cut)
            size += len(cut)
            if size >= most:
                yield np.concatenate(part), np.concatenate(where), np.concatenate(owner)
                part, where, owner, size = [], [], [], 0
    if part:
        yield np.concatenate(part), np.concatenate(where), np.concatenate(owner)


def raw_keys(symbols: np.ndarray) -> list[np.ndarray]:
    """For each order from 1, a number of the n-gram that ends at each symbol, from which mixed() makes its key."""
    out, c = [], symbols.astype(np.uint64) + np.uint64(1)
    for _ in range(ORDER):
        raw = c.copy()
        if out:
            raw[1:] += out[-1][:-1] * np.uint64(0x9E3779B97F4A7C15)
        out.append(raw)
    return out


def mixed(raw: np.ndarray, order: int) -> np.ndarray:
    """The keys of n-grams of one order."""
    x = raw + np.uint64(order * 0x632BE59BD9B4E019 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) >> np.uint64(64 - KEY)


def keys_at(raw: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    """Rows of keys: of each order's n-gram that ends at the places, then of each order but the highest of what stands before its last character."""
    return np.stack([mixed(r[at], k + 1) for k, r in enumerate(raw)] + [mixed(r[at - 1], k + 1) for k, r in enumerate(raw[:-1])])


def firsts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct value stands first, and for each value the number of its place in that list; by hashing, not sorting."""
    code = pa.array(x).dictionary_encode().indices.to_numpy()
    return np.flatnonzero(np.r_[True, code[1:] > np.maximum.accumulate(code)[:-1]]), code


def trusted_ids(labels: DataFrame) -> DataFrame:
    """(doc_id, train): three quarters of the trusted documents train, by a hash; the others never do."""
    good = labels.filter("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id")).distinct().dropna()
    h = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 40)).cast("double") / float(1 << 40)
    return good.withColumn("train", h < 0.75)


#: Of an n-gram of the highest order: its own key, those of its endings, and of each of these the key of what stands before its last character.
GRAMS, BEFORE = [f"g{k}" for k in range(1, ORDER + 1)], [f"b{k}" for k in range(2, ORDER + 1)]
#: A symbol has so many bits; a long holds three.
BITS, SPLIT = 21, 3


def counted(texts: DataFrame, most: int = 300_000) -> DataFrame:
    """(g1.., b2.., n) over all rows of texts; a task sums its counts before it sends them, whenever it holds `most` n-grams.

    What is shuffled is the n-grams themselves, as two longs each; their keys are made once they are counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, times = np.zeros((2, 0), np.int64), np.zeros(0, np.int64)

        def out() -> Iterator[pa.RecordBatch]:
            for i in range(0, len(times), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(seen[0, i : i + 50_000]), pa.array(seen[1, i : i + 50_000]), pa.array(times[i : i + 50_000])], ["a", "b", "n"])

        evict()
        for b in (s for x in batches for s in slices(x, 0)):
            for symbols, at, _ in segments(b.column(0).to_pylist()):
                first, code = firsts(raw_keys(symbols)[-1][at])
                first, wide = at[first], symbols.astype(np.int64)
                part = lambda places, wide=wide, first=first: sum(wide[first - p] << (BITS * i) for i, p in enumerate(places))
                seen = np.concatenate([seen, np.stack([part(range(SPLIT)), part(range(SPLIT, ORDER))])], axis=1)
                times = np.concatenate([times, np.bincount(code)])
                if len(times) >= most:
                    order = np.lexsort(seen)
                    new = np.flatnonzero(np.r_[True, (seen[:, order[1:]] != seen[:, order[:-1]]).any(axis=0)])
                    seen, times = seen[:, order[new]], np.add.reduceat(times[order], new)
                    if len(times) >= most // 2:
                        yield from out()
                        seen, times = seen[:, :0], times[:0]
        yield from out()
        evict()

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            a, b = x.column(0).to_numpy(), x.column(1).to_numpy()
            last_first = [a >> (BITS * i) & (2**BITS - 1) for i in range(SPLIT)] + [b >> (BITS * i) & (2**BITS - 1) for i in range(ORDER - SPLIT)]
            symbols = np.stack(last_first[::-1], axis=1).ravel().astype(np.uint32)
            k = keys_at(raw_keys(symbols), np.arange(1, len(a) + 1) * ORDER - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*map(pa.array, k), x.column(2)], [*GRAMS, *BEFORE, "n"])

    found = texts.select("text").mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    return found.mapInArrow(keyed, ", ".join(f"{c} long" for c in [*GRAMS, *BEFORE, "n"]))


def discounts(n: list[int]) -> list[float]:
    """Of modified Kneser-Ney, for counts of 1, 2 and 3 or more, from the numbers of n-grams seen 1 to 4 times."""
    n = [max(1, x) for x in n]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(k + 0.95, max(0.05, k + 1 - (k + 2) * y * n[k + 1] / n[k])) if k < 2 else min(2.95, max(0.05, 3 - 4 * y * n[3] / n[2])) for k in range(3)]


def model(texts: DataFrame) -> tuple[DataFrame, float]:
    """(key, p, rest) of every n-gram of the texts, and the weight of the unseen at order 1.

    p is the interpolated probability of an n-gram's last character after those before it; rest is the weight of the lower order
    after the n-gram as a context. Below the highest order, an n-gram counts once for each character seen before it. Everything but
    the numbers of n-grams seen one to four times stays in Spark.
    """
    level = written(counted(texts), "counts")
    levels, floor = [], 1.0
    for k in range(ORDER, 0, -1):
        tally = {r["n"]: r["c"] for r in level.filter("n <= 4").groupBy("n").agg(F.count("*").alias("c")).collect()}
        d = discounts([tally.get(i, 0) for i in (1, 2, 3, 4)])
        cut = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        row = level.withColumn("cut", cut)
        if k > 1:
            sums = row.groupBy(f"b{k}").agg(F.sum("n").alias("total"), (F.sum("cut") / F.sum("n")).alias("rest"))
            levels.append((row.join(sums, f"b{k}").select(F.col(f"g{k}").alias("key"), F.col(f"g{k - 1}").alias("lower"), ((F.col("n") - F.col("cut")) / F.col("total")).alias("share"), "rest"), sums.select(F.col(f"b{k}").alias("key"), "rest")))
            lower = [c for j in range(1, k - 1) for c in (f"g{j}", f"b{j + 1}")]
            level = written(level.groupBy(f"g{k - 1}").agg(*(F.min(c).alias(c) for c in lower), F.count("*").alias("n")), f"level{k - 1}")
        else:
            got = row.agg(F.sum("n").alias("total"), F.sum("cut").alias("cut")).first()
            total = float(got["total"] or 1)
            floor = (got["cut"] or total) / total
            p = row.select(F.col("g1").alias("key"), ((F.col("n") - F.col("cut")) / total + floor / START).alias("p"))
    out = p.withColumn("rest", F.lit(None).cast("double"))
    for rows, contexts in levels[::-1]:
        p = written(rows.join(p.withColumnRenamed("key", "lower"), "lower").select("key", (F.col("share") + F.col("rest") * F.col("p")).alias("p")), "level")
        out = out.union(p.withColumn("rest", F.lit(None).cast("double"))).union(contexts.select("key", F.lit(None).cast("double").alias("p"), "rest"))
    return out.groupBy("key").agg(F.max("p").alias("p"), F.max("rest").alias("rest")), floor


# ---- scoring


def packed(k: np.ndarray) -> bytes:
    """Keys in KEY // 8 bytes each."""
    return np.ascontiguousarray(k.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : KEY // 8]).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // (KEY // 8), 8), np.uint8)
    out[:, : KEY // 8] = np.frombuffer(data, np.uint8).reshape(-1, KEY // 8)
    return out.view("<u8").ravel()


class Table:
    """Costs by key: open addressing in arrays, looked up for many keys at once."""

    def __init__(self, k: np.ndarray, cost: np.ndarray):
        """cost: for each key two numbers, of p and of rest."""
        self.mask = np.uint64((1 << max(4, (4 * len(k)).bit_length())) - 1)
        self.key, self.cost = np.full(int(self.mask) + 1, 2**64 - 1, np.uint64), np.full((int(self.mask) + 1, 2), ABSENT, np.uint16)
        slot, left = k & self.mask, np.arange(len(k))
        while len(left):
            free = self.key[slot[left]] == 2**64 - 1
            self.key[slot[left[free]]] = k[left[free]]
            there = self.key[slot[left]] == k[left]
            self.cost[slot[left[there]]] = cost[left[there]]
            left = left[~there]
            slot[left] = (slot[left] + np.uint64(1)) & self.mask

    def get(self, k: np.ndarray, which: int) -> np.ndarray:
        """The cost of each key, ABSENT where there is none."""
        out, slot, left = np.full(len(k), ABSENT, np.uint16), k & self.mask, np.arange(len(k))
        while len(left):
            at = self.key[slot]
            hit = at == k[left]
            out[left[hit]] = self.cost[slot[hit], which]
            go = ~hit & (at != 2**64 - 1)
            left, slot = left[go], (slot[go] + np.uint64(1)) & self.mask
        return out


def costs(texts: list[str | None], table: Table, floor: float) -> np.ndarray:
    """The model's bits for each text: p of the longest n-gram it has, after the weights of the contexts that it has of longer ones."""
    total = np.zeros(len(texts))
    for symbols, at, owner in segments(texts):
        raw, cost, left = raw_keys(symbols), np.zeros(len(at), np.int64), np.arange(len(at))
        for order in range(ORDER, 0, -1):
            p = table.get(mixed(raw[order - 1][at[left]], order), 0)
            cost[left] += np.where(p == ABSENT, 0, p)
            left = left[p == ABSENT]
            if order > 1 and len(left):
                rest = table.get(mixed(raw[order - 2][at[left] - 1], order - 1), 1)
                cost[left] += np.where(rest == ABSENT, 0, rest)
        bits = cost / FRACTION
        bits[left] += UNSEEN - np.log2(floor)
        total += np.bincount(owner, bits, len(texts))
    return total


def slices(batch: pa.RecordBatch, text: int, most: int = 500_000) -> Iterator[pa.RecordBatch]:
    """The batch in slices of whole rows whose texts have about `most` bytes together."""
    end, at = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(text)).cast(pa.int64()), 0)).to_numpy(), 0
    while at < len(end):
        to = int(np.searchsorted(end, (end[at - 1] if at else 0) + most)) + 1
        yield batch.slice(at, to - at)
        at = to


#: Keys of a row that travels; readers hold thousands of rows at a time.
PIECE = 2048


def asked(rows: DataFrame, text: int, shards: int, most: int = 48_000_000) -> DataFrame:
    """(chunk, shard, keys): writes the rows to chunks, files of about `most` characters, and gives each one's distinct n-grams by shard.

    Each chunk has a row with shard -1, too. A task that runs again writes new chunks; only those of the run that succeeds are listed.
    """
    root = scratch(rows.sparkSession, "chunks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evict()
        store, base = fs.FileSystem.from_uri(root)
        store.create_dir(base, recursive=True)
        name = writer = sink = None
        known, parts, size = np.zeros(0, np.uint64), [], 0

        def done() -> pa.RecordBatch:
            writer.close()
            sink.close()
            seen = np.unique(np.concatenate(parts or [known]))
            shard = (seen % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            cut = np.searchsorted(shard[order], np.arange(shards + 1))
            pieces = [(s, order[i : min(i + PIECE, cut[s + 1])]) for s in np.flatnonzero(np.diff(cut)).tolist() for i in range(cut[s], cut[s + 1], PIECE)]
            return pa.RecordBatch.from_arrays([pa.array([name] * (len(pieces) + 1)), pa.array([-1, *(s for s, _ in pieces)], pa.int64()), pa.array([None, *(packed(seen[at]) for _, at in pieces)], pa.binary())], ["chunk", "shard", "keys"])

        for b in (s for x in batches for s in slices(x, text)):
            if writer is None:
                name = uuid.uuid4().hex[:20]
                sink = store.open_output_stream(f"{base}/{name}")
                writer = pa.ipc.new_stream(sink, b.schema, options=pa.ipc.IpcWriteOptions(compression="zstd"))
            writer.write_batch(b)
            for symbols, at, _ in segments(b.column(text).to_pylist()):
                raw = raw_keys(symbols)
                whole = raw[-1][at]
                new = firsts(whole)[0]  # the highest order's n-grams tell all others
                if len(known):
                    new = new[known[np.minimum(np.searchsorted(known, whole[new]), len(known) - 1)] != whole[new]]
                known = np.sort(np.concatenate([known, whole[new]]))
                parts.append(np.unique(keys_at(raw, at[new])))
                size += len(at)
                if len(parts) > 1 and sum(map(len, parts[1:])) > len(parts[0]):
                    parts = [np.unique(np.concatenate(parts))]
            if size >= most:
                yield done()
                writer, known, parts, size = None, known[:0], [], 0
        if writer is not None:
            yield done()
        evict()

    return written(rows.mapInArrow(run, "chunk string, shard long, keys binary"), "asked").withColumn("root", F.lit(root))


def _blocks(table: DataFrame, shards: int) -> DataFrame:
    """(shard, chunk null, keys, costs): the model's rows of a shard, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shard, key = b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.uint64)
            cost = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns[2:]], axis=1).astype(np.uint16)
            has = np.unique(shard)
            rows = [np.flatnonzero(shard == s) for s in has]
            yield pa.RecordBatch.from_arrays([pa.array(has), pa.nulls(len(has), pa.string()), pa.array([packed(key[r]) for r in rows], pa.binary()), pa.array([cost[r].tobytes() for r in rows], pa.binary())], ["shard", "chunk", "keys", "costs"])

    code = lambda c: F.coalesce(F.least(F.lit(ABSENT - 1), F.round(-F.log2(F.greatest(F.col(c), F.lit(1e-18))) * FRACTION)), F.lit(ABSENT)).cast("int").alias(c)
    rows = table.select(F.pmod("key", F.lit(shards)).alias("shard"), "key", code("p"), code("rest"))
    return rows.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "shard long, chunk string, keys binary, costs binary")


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, chunk, keys, costs) by shard, the model's first, to (chunk, keys, costs) of the n-grams that it has."""
    now, k, c, table = None, [], [], None
    for b in batches:
        out = []
        for shard, chunk, wanted, cost in zip(*(x.to_pylist() for x in b.columns), strict=True):
            if shard != now:
                now, k, c, table = shard, [], [], None
            if chunk is None:
                k.append(unpacked(wanted))
                c.append(np.frombuffer(cost, np.uint16).reshape(-1, 2))
                continue
            if table is None:
                table = Table(np.concatenate(k), np.concatenate(c)) if k else Table(np.zeros(0, np.uint64), np.zeros((0, 2), np.uint16))
            want = unpacked(wanted)
            cost = np.stack([table.get(want, 0), table.get(want, 1)], axis=1)
            hit = (cost != ABSENT).any(axis=1)
            out.append((chunk, packed(want[hit]), cost[hit].tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else ([], [], []), (pa.string(), pa.binary(), pa.binary()), strict=True)], ["chunk", "keys", "costs"])


def scored(rows: DataFrame, table: DataFrame, floor: float, most: int = 200_000) -> DataFrame:
    """The rows with n, the characters of their text, and bits, what the model needs for them. table: (key, p, rest).

    The model is cut into shards of about `most` n-grams, however many it has. A shard answers each chunk once for each n-gram,
    however often it stands there, so frequent n-grams make no shard hot.
    """
    table = written(table, "model")
    shards = -(-max(1, table.count()) // most)
    names = [f"c{i}" for i in range(len(rows.columns))]
    plain, text = rows.toDF(*names), rows.columns.index("text")
    fields = [f"{n} {f.dataType.simpleString()}" for n, f in zip(names, rows.schema, strict=True)]
    ask = asked(plain, text, shards)
    both = _blocks(table, shards).union(ask.filter("shard >= 0").select("shard", "chunk", "keys", F.lit(None).cast("binary")))
    answers = written(both.repartition("shard").sortWithinPartitions("shard", F.col("chunk").asc_nulls_first()).mapInArrow(_answers, "chunk string, keys binary, costs binary"), "answers")
    chunks = ask.filter("shard < 0").select("chunk", "root")
    root = (chunks.select("root").first() or [""])[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evict()

        def told(chunk: str, k: list[bytes], c: list[bytes]) -> Iterator[pa.RecordBatch]:
            costs_of = Table(np.concatenate([unpacked(x) for x in k]) if k else np.zeros(0, np.uint64), np.frombuffer(b"".join(c), np.uint16).reshape(-1, 2))
            store, base = fs.FileSystem.from_uri(root)
            with store.open_input_stream(f"{base}/{chunk}") as f, pa.ipc.open_stream(f) as parts:
                for b in parts:
                    texts = b.column(text).to_pylist()
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array([len(t or "") for t in texts], pa.int64()), pa.array(costs(texts, costs_of, floor))], [*names, "n", "bits"])

        now, k, c = None, [], []
        for b in batches:
            for chunk, wanted, cost in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if chunk != now:
                    if now is not None:
                        yield from told(now, k, c)
                    now, k, c = chunk, [], []
                if wanted:
                    k.append(wanted)
                    c.append(cost)
        if now is not None:
            yield from told(now, k, c)
        evict()

    null = F.lit(None).cast("binary")
    tasks = chunks.select("chunk", null.alias("keys"), null.alias("costs")).union(answers)
    parts = max(1, min(100_000, 2 * chunks.count()))  # a partition that AQE may not join with others: a chunk's work isn't in the size of its row
    out = tasks.repartition(parts, "chunk").sortWithinPartitions("chunk").mapInArrow(run, ", ".join([*fields, "n long", "bits double"]))
    return out.toDF(*rows.columns, "n", "bits")


class Judge:
    """The model and the limits; verdict() applies them to rows with lang, n and bits.

    prior: so many characters of a language's mean are added to each text, because few characters say little. A document is kept
    unless its bits for a character, so smoothed, exceed slack times the quantile over its language's trusted rows that didn't train;
    where a language has none, the quantile over all languages holds.
    """

    def __init__(self, documents: DataFrame, labels: DataFrame, keep: bool, quantile: float = 0.995, slack: float = 1.08, prior: float = 60.0, max_langs: int = 10_000):
        """keep: whether rows is to have all columns of documents, else doc_id and lang only."""
        spark, self.prior = documents.sparkSession, prior
        ids = written(trusted_ids(labels), "trusted")
        self.names = [f"c{i}" for i in range(len(documents.columns))]
        at = {c: self.names[documents.columns.index(c)] for c in ("doc_id", "text", "lang")}
        train = ids.filter("train").select("doc_id")
        trusted = Sieve(train.select(F.xxhash64("doc_id").alias("h")))
        texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("length(text) > 0").filter(trusted.column(F.xxhash64("doc_id")))
        table, floor = model(texts.join(train, "doc_id", "left_semi"))  # only texts that pass are shuffled
        if keep:  # under names that can't clash
            rows = scored(documents.toDF(*["text" if n == at["text"] else n for n in self.names]), table, floor).withColumnRenamed("text", at["text"])
        else:
            rows = scored(documents.select("doc_id", "lang", "text"), table, floor).drop("text")
            at = {"doc_id": "doc_id", "lang": "lang"}
        self.rows = written(rows, "scores")
        self.scores = self.rows.select(F.col(at["doc_id"]).cast("long").alias("doc_id"), F.col(at["lang"]).alias("lang"), "n", "bits")
        fresh = self.scores.join(ids.filter("not train").select("doc_id"), "doc_id", "left_semi").filter("n > 0")
        means = fresh.groupBy("lang").agg((F.sum("bits") / F.sum("n")).alias("mean")).limit(max_langs + 1).collect()
        if len(means) > max_langs:
            raise ValueError(f"over {max_langs} languages; their limits are broadcast")
        self.lang, self.mean = at["lang"], fresh.agg((F.sum("bits") / F.sum("n")).alias("mean")).first()["mean"] or 0.0
        self.limits = small_table(spark, [tuple(r) for r in means], "lang_m string, mean double")
        checked = self.smoothed(fresh, "lang")
        own = checked.groupBy("lang").agg((F.percentile_approx("excess", quantile, 10_000) * slack).alias("own")).collect()
        whole = checked.agg(F.percentile_approx("excess", quantile, 10_000)).first()[0]
        self.whole = float("inf") if whole is None else whole * slack
        limit = {r["lang"]: r["own"] for r in own}
        self.limits = small_table(spark, [(r["lang"], r["mean"], limit[r["lang"]]) for r in means], "lang_m string, mean double, own double")

    def smoothed(self, scores: DataFrame, lang: str) -> DataFrame:
        out = scores.join(F.broadcast(self.limits), scores[lang].eqNullSafe(self.limits["lang_m"]), "left").drop("lang_m")
        return out.withColumn("excess", (F.col("bits") + self.prior * F.coalesce("mean", F.lit(self.mean))) / (F.col("n") + self.prior)).drop("mean")

    def verdict(self) -> DataFrame:
        """The rows with excess, threshold and keep."""
        out = self.smoothed(self.rows, self.lang).withColumn("threshold", F.coalesce("own", F.lit(self.whole))).drop("own")
        return out.withColumn("keep", (F.col("n") > 0) & (F.col("excess") <= F.col("threshold")))


def judged(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, lang, n_chars, perplexity, excess, threshold, keep): what each document's whole text scores, and the decision."""
    ppl = F.when(F.col("n") > 0, F.pow(F.lit(2.0), F.col("bits") / F.col("n")))
    return Judge(documents, labels, keep=False).verdict().select("doc_id", "lang", F.col("n").alias("n_chars"), ppl.alias("perplexity"), "excess", "threshold", "keep")


def kept(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of documents, with all their columns, that the judge keeps."""
    judge = Judge(documents, labels, keep=True)
    return judge.verdict().filter("keep").select(*[F.col(n).alias(c) for n, c in zip(judge.names, documents.columns, strict=True)])


def op8_quality(spark, sf_dir: str) -> DataFrame:
    """Whole documents table: doc_id, lang, n_chars, perplexity, excess and threshold in bits for a character, keep."""
    return judged(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
