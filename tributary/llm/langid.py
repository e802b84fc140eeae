"""Language identification by cross-parsing: a text is cut into the longest matches with a language's sample.

A text of null or without a letter is `und` with score 0, as is every text where no labelled row is there to learn from. Ties go to
the language that comes first by code point. Rows repeat as they come; an empty table gives an empty result. Only doc_id, text and
lang are read. Texts are parsed whole, as the bytes of their letters in lower case, so that no script lacks symbols.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import evict, resident

SEGMENT = 256


class Automaton:
    """The suffix automaton of a sample as a table: where a byte leads, and whether a phrase ends before it.

    A state stands for the strings that end at the same places of the sample. From it the table follows the longest match; a
    byte that can't go on with it begins a phrase from the root. Bytes that the sample lacks are of class 0.
    """

    def __init__(self, sample: bytes):
        has = np.unique(np.frombuffer(sample, np.uint8))
        self.classes = len(has) + 1
        self.code = np.zeros(256, np.int32)
        self.code[has] = np.arange(1, self.classes)
        link, size, move = [-1], [0], [{}]
        last = 0
        for c in self.code[np.frombuffer(sample, np.uint8)].tolist():
            now = len(size)
            size.append(size[last] + 1)
            link.append(0)
            move.append({})
            p = last
            while p >= 0 and c not in move[p]:
                move[p][c] = now
                p = link[p]
            if p >= 0:
                q = move[p][c]
                if size[p] + 1 == size[q]:
                    link[now] = q
                else:
                    twin = len(size)
                    size.append(size[p] + 1)
                    link.append(link[q])
                    move.append(dict(move[q]))
                    while p >= 0 and move[p].get(c) == q:
                        move[p][c] = twin
                        p = link[p]
                    link[q] = link[now] = twin
            last = now
        root = np.zeros(self.classes, np.int32)
        for c, to in move[0].items():
            root[c] = to
        table = np.empty((len(size), self.classes), np.int32)
        table[:] = root * self.classes * 2 + 1  # the next state's row, doubled, and in the lowest bit whether a phrase ends
        for state, to in enumerate(move):
            if to:
                table[state, list(to)] = np.fromiter(to.values(), np.int64, len(to)) * self.classes * 2
        table[0, 0] = 1
        self.table = table.ravel()

    def phrases(self, segments: np.ndarray, follows: np.ndarray) -> np.ndarray:
        """segments: bytes in SEGMENT rows, a column for each segment; follows: whether it goes on where the last one ends.

        The number of phrases that end in each column, as one parse of the whole text has them. All columns are parsed from the root
        first; then each is parsed again from the state in which the last one ends, until it meets the states of its first parse,
        after which nothing differs. A column that never does hands its new end on.
        """
        height, n = segments.shape
        grid = self.code[segments]
        at, count = np.zeros(n, np.int32), np.zeros(n, np.int32)
        states, counts = np.empty((height, n), np.int32), np.empty((height, n), np.int16)
        for i, row in enumerate(grid):
            step = self.table[at + row]
            count += step & 1
            at = step >> 1
            states[i], counts[i] = at, count
        first, end, total = count.copy(), at, count
        todo = np.flatnonzero(follows)
        todo = todo[end[todo - 1] != 0]
        while len(todo):
            live, at, count, before = todo, end[todo - 1], np.zeros(len(todo), np.int32), end[todo]
            for i in range(height):
                step = self.table[at + grid[i, live]]
                count += step & 1
                at = step >> 1
                met = at == states[i, live]
                if met.any():
                    done = live[met]
                    total[done] = count[met] + first[done] - counts[i, done]
                    end[done] = states[-1, done]
                    live, at, count = live[~met], at[~met], count[~met]
                    if not len(live):
                        break
            total[live], end[live] = count, at
            changed = todo[end[todo] != before] + 1
            todo = changed[(changed < n)]
            todo = todo[follows[todo]]
        return total


_ASCII = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 else 32 for c in range(128)) + bytes(range(128, 256))
_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """What is compared: letters in lower case, and one space for each run of anything else."""
    if text.isascii():
        return b" ".join(text.encode().translate(_ASCII).split())
    out = _OTHER.sub(" ", text.lower()).strip()
    return out.encode("utf-8", "replace") if any(map(str.isalpha, out)) else b""


class Model:
    """Automata of the languages' samples."""

    def __init__(self, samples: dict[str, bytes]):
        self.langs = sorted(samples)
        self.automata = [Automaton(samples[x]) for x in self.langs]
        self.bits = np.array([np.log2(max(2, len(samples[x]))) for x in self.langs])

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float], list[int]]:
        """Of each text, the language with the fewest phrases times bits for a phrase, one less its ratio to the second, its bits, and its bytes."""
        langs, scores, bits, sizes = ["und"] * len(texts), [0.0] * len(texts), [0.0] * len(texts), [0] * len(texts)
        given = [letters(t) if t else b"" for t in texts]
        use = [i for i, x in enumerate(given) if x]
        if not use or not self.langs:
            return langs, scores, bits, sizes
        cuts = np.array([-(-len(given[i]) // SEGMENT) for i in use])
        begin = np.cumsum(cuts) - cuts
        owner = np.repeat(np.arange(len(use)), cuts)
        follows = np.ones(len(owner), bool)
        follows[begin] = False
        grid = np.frombuffer(b"".join(given[i].ljust(k * SEGMENT, b"\xff") for i, k in zip(use, cuts.tolist(), strict=True)), np.uint8).reshape(-1, SEGMENT)
        over = cuts * SEGMENT - np.array([len(given[i]) for i in use])  # each byte past the end is of class 0, which ends one phrase
        grid = np.ascontiguousarray(grid.T)
        cost = np.stack([np.bincount(owner, a.phrases(grid, follows), len(use)) - over + 1 for a in self.automata]) * self.bits[:, None]
        order = np.argsort(cost, axis=0, kind="stable")
        best = np.take_along_axis(cost, order[:1], 0)[0]
        second = np.take_along_axis(cost, order[1:2], 0)[0] if len(self.langs) > 1 else best * 2
        for i, o, b, s in zip(use, order[0], best.tolist(), second.tolist(), strict=True):
            langs[i], scores[i], bits[i], sizes[i] = self.langs[o], 1 - b / s, b, len(given[i])
        return langs, scores, bits, sizes


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def samples(documents: DataFrame, chars: int = 24_000, passage: int = 1_000, together: int = 960_000) -> dict[str, bytes]:
    """Of each language, passages of labelled rows, in the order of a hash, until they have `chars` characters.

    A passage is a stretch of `passage` characters anywhere in a row's text. The bounds of the sample are parameters: `chars` for a
    language, `together` for all, which share it alike where they are many.
    """
    learn = documents.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id"))
    learn = learn.select("lang", "doc_id", "text", F.ceil(F.length("text") / passage).cast("int").alias("n")).filter("n > 0")
    count = {r["lang"]: r["n"] for r in learn.groupBy("lang").agg(F.sum("n").alias("n")).limit(together // 100 + 1).collect()}
    if len(count) * 100 > together:
        raise ValueError(f"{len(count)} languages and more; {together} characters are kept of all")
    if not count:
        return {}
    chars = min(chars, together // len(count))
    wanted = F.create_map(*[x for k, n in count.items() for x in (F.lit(k), F.lit(min(1.0, 3.0 * (chars / passage + 8) / n)))])
    each = learn.select("lang", "text", "doc_id", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i")).withColumn("h", F.xxhash64("doc_id", "i", F.lit("langid")))
    some = each.filter(F.col("h").cast("double") / 2.0**64 + 0.5 <= F.element_at(wanted, F.col("lang")))
    found: dict[str, list] = {}
    for r in some.select("lang", "h", F.substr("text", F.col("i") * passage + 1, F.lit(passage)).alias("t")).collect():
        found.setdefault(r["lang"], []).append((r["h"], r["t"]))
    out = {}
    for lang, rows in sorted(found.items()):
        parts, size = [], 0
        for _, t in sorted(rows):
            if size < chars:
                parts.append(letters(t))
                size += len(t)
        if any(parts):
            out[lang] = b" ".join(parts) + b" "
    return out


def predict(spark, given: dict[str, bytes], piece: int = 2_000_000) -> Callable:
    """A function of a text column to (lang_pred, score, bits, size): bits are those of the parse, size the bytes parsed. The samples, whose size has a bound, are broadcast."""
    shared, key = spark.sparkContext.broadcast(given), ("langid", hash(tuple(sorted(given.items()))))

    fields = [("lang_pred", pa.string()), ("score", pa.float64()), ("bits", pa.float64()), ("size", pa.int64())]

    @F.arrow_udf("lang_pred string, score double, bits double, size long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = resident(key, lambda: Model(shared.value))
        for texts in batches:
            out, part, size = ([], [], [], []), [], 0
            for i, t in enumerate(texts):
                part.append(t.as_py())
                size += len(part[-1] or "")
                if size >= piece or i + 1 == len(texts):
                    for x, y in zip(out, model.predict(part), strict=True):
                        x += y
                    part, size = [], 0
            yield pa.StructArray.from_arrays([pa.array(x, t) for x, (_, t) in zip(out, fields, strict=True)], [n for n, _ in fields])
        del model
        evict()

    return run.asNondeterministic()  # else the optimizer runs it once for a filter and once more for what is selected


def known(documents: DataFrame, quantile: float = 0.999, slack: float = 1.25, prior: float = 60.0) -> DataFrame:
    """The rows of documents, with all their columns, whose text is in a language; a null lang is filled with it.

    A text without a letter goes, and one that the nearest language's automaton parses worse than nearly all labelled text: bits for
    a byte, with `prior` bytes at the mean added since short texts say little, over `slack` times the quantile of labelled rows.
    """
    guess = predict(documents.sparkSession, samples(documents))
    labelled = documents.filter("lang is not null").select(guess("text").alias("guess")).select("guess.*").filter("size > 0")
    mean = F.lit(prior) * F.sum("bits") / F.sum("size")
    rates = labelled.agg(mean.alias("more"), F.percentile_approx(F.col("bits") / F.col("size"), quantile, 10_000).alias("long")).first()
    rows = documents.select(F.struct("*").alias("whole"), guess("text").alias("guess")).filter("guess.lang_pred <> 'und'")
    if rates["more"] is not None:
        smooth = lambda b, n: (b + F.lit(rates["more"])) / (n + F.lit(prior))
        rows = rows.filter(smooth(F.col("guess.bits"), F.col("guess.size")) <= slack * rates["long"])
    filled = F.coalesce("whole.lang", "guess.lang_pred")
    return rows.select(*[filled.alias("lang") if c == "lang" else F.col("whole").getField(c).alias(c) for c in documents.columns])


def op6_langid(spark, sf_dir: str) -> DataFrame:
    """Whole documents table: doc_id, held_out, lang_pred, score."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = docs.select("doc_id", held_out("doc_id").alias("held_out"), predict(spark, samples(docs))("text").alias("guess"))
    return out.select("doc_id", "held_out", "guess.lang_pred", "guess.score")
