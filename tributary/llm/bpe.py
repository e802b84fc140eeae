"""Byte-level BPE by recursive SQL in DuckDB, over the distinct words of each batch.

Null and empty texts have no tokens. Rows repeat as they come, and an empty table gives an empty result. Only doc_id and text are
read. Texts are whole: a batch is cut into pieces of whole documents, and what comes out of a piece is handed on before the next.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import evict, resident

VOCABULARY = "byte_bpe_50k.tiktoken"

#: Rows (w, pos, tok) are the tokens of word w so far, each with the place and id of the next one and, as key, its pair's rank and
#: place. Each round contracts the leftmost pair of minimum rank in each word: the least key. Only pairs beside a contraction are
#: joined with the merge table again. A word without a pair in that table has reached its fixpoint; its rows stop being live.
ENCODE = """
WITH RECURSIVE s(w, pos, tok, npos, ntok, key, live) AS (
  SELECT b.w, b.pos, b.tok, b.pos + 1, b.ntok, m.rank * 4294967296::BIGINT + b.pos, true
  FROM base b LEFT JOIN merges m ON m.a = b.tok AND m.b = b.ntok
  UNION ALL
  SELECT u.w, u.pos, u.tok, u.npos, u.ntok, CASE WHEN u.changed THEN m.rank * 4294967296::BIGINT + u.pos ELSE u.key END, u.live
  FROM (
    SELECT r.w, r.pos, r.key, t.w IS NOT NULL AS live, coalesce(r.pos = t.pos OR r.npos = t.pos, false) AS changed,
      CASE WHEN r.pos = t.pos THEN t.tok ELSE r.tok END AS tok,
      CASE WHEN r.pos = t.pos THEN t.npos ELSE r.npos END AS npos,
      CASE WHEN r.pos = t.pos THEN t.ntok WHEN r.npos = t.pos THEN t.tok ELSE r.ntok END AS ntok
    FROM s r LEFT JOIN (
      SELECT b.w, (b.key % 4294967296)::INTEGER AS pos, (b.key // 4294967296)::INTEGER AS tok, b.gone, x.npos, x.ntok
      FROM (SELECT w, min(key) AS key, arg_min(npos, key) AS gone FROM s WHERE live GROUP BY w HAVING min(key) IS NOT NULL) b
      JOIN s x ON x.w = b.w AND x.pos = b.gone
    ) t ON t.w = r.w
    WHERE r.live AND r.pos IS DISTINCT FROM t.gone
  ) u LEFT JOIN merges m ON m.a = CASE WHEN u.changed THEN u.tok END AND m.b = u.ntok
)
SELECT w, list(tok ORDER BY pos) AS ids FROM s WHERE NOT live GROUP BY w
"""

#: Rows (w, pos, tok) to the bytes of each w, in the order of pos.
DECODE = "SELECT w, string_agg(v.piece, '' ORDER BY t.pos) AS bytes FROM tokens t JOIN vocabulary v ON v.id = t.tok GROUP BY w"


class Codec:
    """One in each Python worker: the merge table in DuckDB, and the words that it has encoded lately."""

    def __init__(self, ranks: bytes, pattern: str, remember: int = 500_000, longest: int = 256):
        """longest: words of more bytes would take a round for each merge; the same merges are then done by a loop, one by one."""
        self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        self.split = regex.compile(pattern).findall
        self.remember, self.longest, self.known, self.odd = remember, longest, {}, {}
        self.byte = np.array([self.rank[bytes([i])] for i in range(256)], np.int32)
        merges = [(self.rank[t[:i]], self.rank[t[i:]], r) for t, r in self.rank.items() for i in range(1, len(t)) if t[:i] in self.rank and t[i:] in self.rank]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "150MB", "preserve_insertion_order": False})
        a, b, rank = (pa.array(x, pa.int32()) for x in zip(*merges, strict=True))
        self._table("merges", {"a": a, "b": b, "rank": rank})
        self._table("vocabulary", {"id": pa.array(self.rank.values(), pa.int32()), "piece": pa.array([t.hex() for t in self.rank])})

    def __del__(self):
        if db := getattr(self, "db", None):
            db.close()

    def _table(self, name: str, columns: dict) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _loop(self, word: bytes) -> list[int]:
        """The same merges for one long word, with a heap of pairs over a linked list."""
        from heapq import heapify, heappop, heappush

        n, rank = len(word), self.rank
        end, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        alive = [True] * n
        pair = lambda i: rank.get(word[i : end[end[i]]]) if end[i] < n else None
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := pair(i)) is not None]
        heapify(heap)
        while heap:
            _, i, stop = heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue
            j = end[i]
            alive[j], end[i] = False, stop
            if stop < n:
                before[stop] = i
            for k in (before[i], i):
                if k >= 0 and (r := pair(k)) is not None:
                    heappush(heap, (r, k, end[end[k]]))
        return [rank[word[i : end[i]]] for i in range(n) if alive[i]]

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word. A word that is a token itself isn't split, as in tiktoken."""
        ids: list = [[r] if (r := self.rank.get(w)) is not None else None for w in words]
        for i, w in enumerate(words):
            if ids[i] is None and len(w) > self.longest:
                ids[i] = self._loop(w)
        left = [i for i, x in enumerate(ids) if x is None]
        if left:
            size = np.array([len(words[i]) for i in left])
            end = np.cumsum(size)
            tok = self.byte[np.frombuffer(b"".join(words[i] for i in left), np.uint8)]
            last = np.zeros(len(tok), bool)
            last[end - 1] = True
            pos = (np.arange(len(tok)) - np.repeat(end - size, size)).astype(np.int32)
            self._table("base", {"w": pa.array(np.repeat(np.arange(len(left), dtype=np.int32), size)), "pos": pa.array(pos), "tok": pa.array(tok), "ntok": pa.array(np.roll(tok, -1), mask=last)})
            out = self.db.sql(ENCODE).to_arrow_table()
            for w, x in zip(out.column("w").to_pylist(), out.column("ids").to_pylist(), strict=True):
                ids[left[w]] = x
        return ids

    def decode_many(self, ids: list[list[int]]) -> list[bytes]:
        """The bytes of each list of ids."""
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        start = np.cumsum(size) - size
        tok = np.fromiter((x for i in ids for x in i), np.int32, int(size.sum()))
        self._table("tokens", {"w": pa.array(np.repeat(np.arange(len(ids)), size)), "pos": pa.array(np.arange(len(tok)) - np.repeat(start, size)), "tok": pa.array(tok)})
        out = self.db.sql(DECODE).to_arrow_table()
        found = dict(zip(out.column("w").to_pylist(), map(bytes.fromhex, out.column("bytes").to_pylist()), strict=True))
        return [found.get(i, b"") for i in range(len(ids))]

    def learn(self, texts: list[str]) -> list[list[str]]:
        """The words of each text; afterwards known has the ids of each as text, and odd the bytes of those that decode to others."""
        if len(self.known) > self.remember:
            self.known.clear()
            self.odd.clear()
        split = [self.split(t) for t in texts]
        new = list(set(chain.from_iterable(split)).difference(self.known))
        if new:
            raw = [w.encode() for w in new]
            ids = self.encode_words(raw)
            for w, i, before, after in zip(new, ids, raw, self.decode_many(ids), strict=True):
                self.known[w] = " ".join(map(str, i))
                if before != after:
                    self.odd[w] = after
        return split

    def ids(self, words: list[str]) -> str:
        """The ids of a text's words, joined by spaces."""
        return " ".join(map(self.known.__getitem__, words))

    def bytes(self, words: list[str]) -> bytes:
        """What the ids of a text's words decode to."""
        return b"".join([self.odd.get(w) or w.encode() for w in words]) if self.odd else "".join(words).encode()


def pieces(batch: pa.RecordBatch, column: int, most: int = 500_000) -> Iterator[pa.RecordBatch]:
    """The batch in slices of whole rows whose texts have about `most` bytes together."""
    end = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(column)).cast(pa.int64()), 0)).to_numpy()
    at = 0
    while at < len(end):
        to = int(np.searchsorted(end, (end[at - 1] if at else 0) + most)) + 1
        yield batch.slice(at, to - at)
        at = to


def encoded(documents: DataFrame, ranks: bytes | None = None, pattern: str = public_tokenizers.PATTERN, with_ids: bool = False, keep: tuple[str, ...] = ("doc_id",), remember: int = 500_000) -> DataFrame:
    """(*keep, n_tokens, ids_sha256, decoded_sha256[, ids binary]): a narrow pass. ids: little-endian 32-bit numbers.

    ranks: the content of a tiktoken rank file, by default VOCABULARY; its fixed size makes it safe to broadcast. remember: the
    words that a worker keeps between tasks; with 0 it keeps nothing, for jobs whose other stages need the memory.
    """
    ranks = ranks or open(public_tokenizers.path(VOCABULARY), "rb").read()
    spark = documents.sparkSession
    shared, key = spark.sparkContext.broadcast(ranks), ("bpe", hash((ranks, pattern)))
    kept = documents.select(*keep, F.coalesce("text", F.lit("")).alias("text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = resident(key, lambda: Codec(shared.value, pattern, remember or 150_000))
        for batch in chain.from_iterable(pieces(b, len(keep)) for b in batches):
            n, ids_sha, out_sha, ids = [], [], [], []
            for ws in codec.learn(batch.column(len(keep)).to_pylist()):
                text = codec.ids(ws)
                n.append(text.count(" ") + 1 if text else 0)
                ids_sha.append(hashlib.sha256(text.encode()).hexdigest())
                out_sha.append(hashlib.sha256(codec.bytes(ws)).hexdigest())
                if with_ids:
                    ids.append(np.array(text.split(), "<i4").tobytes())
            columns = [*batch.columns[: len(keep)], pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(out_sha, pa.string())]
            names = [*keep, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns, names = [*columns, pa.array(ids, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)
        if not remember:
            del codec
            evict()

    return kept.mapInArrow(run, f"{fields}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids)


def decoded(ids: DataFrame, ranks: bytes | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, ids binary), as encoded(..., with_ids=True) gives them; null ids give a null text."""
    ranks = ranks or open(public_tokenizers.path(VOCABULARY), "rb").read()
    shared, key = ids.sparkSession.sparkContext.broadcast(ranks), ("bpe", hash((ranks, public_tokenizers.PATTERN)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = resident(key, lambda: Codec(shared.value, public_tokenizers.PATTERN))
        for batch in batches:
            rows = [None if x is None else np.frombuffer(x, "<i4").tolist() for x in batch.column(1).to_pylist()]
            out = codec.decode_many([x or [] for x in rows]) if rows else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if x is None else b.decode("utf-8", "replace") for x, b in zip(rows, out, strict=True)], pa.string())], ["doc_id", "text"])

    return ids.select(F.col("doc_id").cast("long"), F.col("ids").cast("binary")).mapInArrow(run, "doc_id long, text string")


def op5_bpe(spark, sf_dir: str) -> DataFrame:
    """Whole documents table: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"))
