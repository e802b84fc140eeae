"""Mixing sources to target weights by entropy balancing.

A source's documents get rates r = min(3, exp(lambda * size / mean size)), those nearest to even by entropy whose words meet the
source's target; lambda solves the convex dual by Newton steps, whose sums Spark takes over all documents. The rates are rounded
into copies. All sums are of integers, so reruns agree.

Null texts have size 0; documents of size 0 keep rate 1 and take no words. Null is a source like any other, and comes last. Rows
with the same doc_id and size are copies of a document and share its fate. An empty table gives an empty result. Other columns aren't read.
"""

from __future__ import annotations

from math import exp, log

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import small_table, written

#: No document is taken more often than this, and no source's target exceeds so many times its size.
MOST = 3
#: Rates and shares are summed as integers of this fraction.
ONE = 1 << 30
#: Stands for an infinite lambda in a table.
ENDLESS = 1e300


def sizes(documents: DataFrame, *keep: str) -> DataFrame:
    """(*keep, source, size): size is the number of runs of other characters than the ASCII white space."""
    words = F.when(F.col("text").isNull() | (F.col("text") == ""), 0).otherwise(F.regexp_count(F.col("text"), F.lit("[^\\x20\\x09-\\x0D]+")))
    return documents.select(*keep, "source", words.cast("long").alias("size"))


def targets(size: list[tuple[str | None, int]]) -> dict[str | None, float]:
    """Each source's words in the mix: shares by weight of all words, stopped at MOST times a source's size, the excess reshared."""
    order = sorted((s for s, _ in size if s is not None)) + [None] * any(s is None for s, _ in size)
    weight, left = {s: 1 + i % 3 for i, s in enumerate(order)}, float(sum(n for _, n in size))
    most, out = {s: MOST * n for s, n in size}, {}
    open_ = list(order)
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > most[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = float(most[s])
        left -= sum(most[s] for s in over)
        open_ = [s for s in open_ if s not in out]
    return out


def _numbered(docs: DataFrame, ids: dict) -> DataFrame:
    """Adds sid, the number of the source. What else is told of sources is joined by number: a table by text takes a whole page of each executor's memory."""
    table = small_table(docs.sparkSession, list(ids.items()), "s string, sid long")
    return docs.join(F.broadcast(table), docs["source"].eqNullSafe(table["s"])).drop("s")  # a row for each source, whose number planned() has checked


def _state(spark, rows: list[tuple], columns: str) -> DataFrame:
    """A small table of one row for each source, whose number planned() has checked."""
    return F.broadcast(small_table(spark, rows, f"sid long, {columns}"))


def solve(histogram: DataFrame, stats: dict, target: dict, steps: int = 40, close: float = 1e-6) -> dict:
    """lambda of each source, by its number. histogram: (sid, size, n), far smaller than the documents.

    Newton steps on the logarithm of the mix's words, kept in a bracket that each step narrows; where the target needs all of
    every document MOST times, lambda is infinite.
    """
    spark = histogram.sparkSession
    out, open_ = {}, {}
    for s, (words, n) in stats.items():
        if not words:
            out[s] = 0.0
        elif target[s] >= MOST * words * (1 - close):
            out[s] = float("inf")
        elif target[s] <= 0:
            out[s] = float("-inf")
        else:
            open_[s] = (0.0, None, None)
    for _ in range(steps):
        if not open_:
            return out
        state = _state(spark, [(s, x, stats[s][0] / stats[s][1]) for s, (x, _, _) in open_.items()], "lam double, mean double")
        x = F.col("size") / F.col("mean")
        rate = F.least(F.lit(float(MOST)), F.exp(F.least(F.lit(50.0), F.col("lam") * x)))
        slope = F.when(rate < MOST, rate * x).otherwise(0.0)
        fixed = lambda c: F.sum((F.round(c * ONE).cast("decimal(20,0)") * (F.col("size") * F.col("n")).cast("decimal(18,0)")))
        got = histogram.filter("size > 0").join(state, "sid").groupBy("sid").agg(fixed(rate).alias("g"), fixed(slope).alias("d")).collect()
        for r in got:
            s, g, d = r["sid"], float(r["g"]) / ONE, float(r["d"]) / ONE
            lam, lo, hi = open_[s]
            if abs(g - target[s]) <= close * target[s] + 1e-6:
                out[s] = lam
                del open_[s]
                continue
            lo, hi = (lam, hi) if g < target[s] else (lo, lam)
            new = lam + log(target[s] / g) * g / d if g > 0 and d > 0 else None
            if new is None or lo is not None and new <= lo or hi is not None and new >= hi:
                new = (lo + hi) / 2 if lo is not None and hi is not None else (lo * 2 + 1 if hi is None else hi * 2 - 1)
            open_[s] = (new, lo, hi)
    return out | {s: x for s, (x, _, _) in open_.items()}


class Plan:
    """What decides each document's copies, given its source, size and doc_id: a few numbers for each source."""

    def __init__(self, ids: dict, base: list[tuple]):
        self.ids, self.base, self.steps = ids, base, []

    def applied(self, docs: DataFrame) -> DataFrame:
        """Adds source_size, target, rate and copies to docs with doc_id, sid and size; no shuffle."""
        out = docs.join(_state(docs.sparkSession, self.base, "source_size long, target double, lam double, mean double"), "sid")
        power = F.when(F.col("size") == 0, 0.0).otherwise(F.least(F.lit(50.0), F.greatest(F.lit(-700.0), F.col("lam") * (F.col("size") / F.col("mean")))))
        rate = F.when(F.col("lam") <= -ENDLESS, 0.0).otherwise(F.least(F.lit(float(MOST)), F.exp(power)))
        out = out.withColumn("rate", rate).drop("lam", "mean")
        up = F.when(F.col("size") * 100 <= F.col("target"), unit("round")).otherwise(0.0)  # a document of over a hundredth of the target is added later, if it fits
        out = out.withColumn("copies", F.least(F.lit(MOST), F.floor(F.round(F.col("rate"), 9) + up)).cast("int"))
        for salt, rows in self.steps:
            out = self._step(out, salt, rows).drop("turn", "able")
        return out

    @staticmethod
    def _able(docs: DataFrame, salt: str, rows: list[tuple], how: str) -> DataFrame:
        """Joins low, up and room, and adds turn and able: whether a document may be added or taken away once."""
        state = _state(docs.sparkSession, rows, "low double, up int, room long")
        able = F.col("size").between(1, F.col("room")) & F.when(F.col("up") > 0, F.col("copies") < MOST).otherwise(F.col("copies") > 0)
        return docs.join(state, "sid", how).withColumn("turn", unit(salt)).withColumn("able", able)

    def _step(self, docs: DataFrame, salt: str, rows: list[tuple]) -> DataFrame:
        out = self._able(docs, salt, rows, "left")
        step = F.when(F.col("able") & (F.col("turn") < F.col("low")), F.col("up")).otherwise(0)
        return out.withColumn("copies", F.col("copies") + F.coalesce(step, F.lit(0))).drop("low", "up", "room")

    def close(self, docs: DataFrame, salt: str, gap: dict, bins: int = 2048, rounds: int = 2) -> DataFrame:
        """Adds a step: documents no larger than a source's gap are added or taken away in the order of a hash, until it closes.

        The place where it does is found by running sums over bins, each round within the bin that the last one found; a row for each
        source comes back. gap: words by source.
        """
        low, left = {s: 0.0 for s, g in gap.items() if g}, {s: abs(g) for s, g in gap.items() if g}
        if not left:
            return docs
        rows, wide = lambda: [(s, low[s], 1 if gap[s] > 0 else -1, abs(gap[s])) for s in left], 1.0
        for _ in range(rounds):
            bin_ = F.floor((F.col("turn") - F.col("low")) / (wide / bins)).cast("int")
            here = self._able(docs, salt, rows(), "inner").filter(F.col("able") & (F.col("turn") >= F.col("low")) & (F.col("turn") < F.col("low") + wide))
            sums = here.groupBy("sid", bin_.alias("bin")).agg(F.sum("size").alias("words"))
            upto = sums.withColumn("upto", F.sum("words").over(Window.partitionBy("sid").orderBy("bin")))  # `bins` rows a source at most
            past = upto.join(_state(docs.sparkSession, list(left.items()), "open long"), "sid").groupBy("sid")
            cut = {r["sid"]: r for r in past.agg(F.min(F.when(F.col("upto") > F.col("open"), F.col("bin"))).alias("at"), F.max(F.when(F.col("upto") <= F.col("open"), F.col("upto"))).alias("used")).collect()}
            wide /= bins
            for s in left:
                r = cut.get(s)
                left[s] -= (r["used"] or 0) if r else 0
                low[s] += (bins if r is None or r["at"] is None else r["at"]) * wide
        self.steps.append((salt, rows()))
        return self._step(docs, salt, rows()).drop("turn", "able")


def unit(salt: str) -> F.Column:
    """A number in [0, 1) that only the document, by its id and size, decides."""
    return F.pmod(F.xxhash64("doc_id", "size", F.lit(salt)), F.lit(1 << 40)).cast("double") / float(1 << 40)


def planned(documents: DataFrame, max_sources: int = 100_000, passes: int = 8, close: float = 1e-4) -> tuple[Plan, DataFrame]:
    """The plan, and (doc_id, source, size, source_size, target, rate, copies) of each row.

    One row for each source is held on the driver and broadcast; more than max_sources raise an error. Copies are added or taken
    away until each source is within `close` of its target, or nothing changes, in so many passes at most.
    """
    raw = written(sizes(documents, "doc_id"), "sizes")
    rows = raw.groupBy("source").agg(F.sum("size").alias("words"), F.count_if(F.col("size") > 0).alias("n")).limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError(f"over {max_sources} sources")
    ids = {s: i for i, s in enumerate(sorted((r["source"] for r in rows), key=lambda s: (s is None, s or "")))}
    stats = {ids[r["source"]]: (r["words"], r["n"]) for r in rows}
    target = {ids[s]: x for s, x in targets([(r["source"], r["words"]) for r in rows]).items()}
    docs = written(_numbered(raw, ids), "numbered")
    lam = solve(written(docs.groupBy("sid", "size").agg(F.count("*").alias("n")), "histogram"), stats, target)
    plan = Plan(ids, [(s, w, float(target[s]), max(-ENDLESS, min(ENDLESS, lam[s])), w / n if n else 1.0) for s, (w, n) in stats.items()])
    out, before = written(plan.applied(docs), "copies"), None
    for n in range(passes):
        got = {r["sid"]: r["words"] for r in out.groupBy("sid").agg(F.sum(F.col("copies") * F.col("size")).alias("words")).collect()}
        gap = {s: g for s in got if abs(g := round(target[s]) - got[s]) > close * target[s]}
        if not gap or gap == before:
            break
        out, before = written(plan.close(out, f"pass {n}", gap), "copies"), gap
    return plan, out


def mixed(documents: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies, taken) for each row of documents."""
    return planned(documents)[1].withColumn("taken", (F.col("copies") * F.col("size")).cast("long"))


def repeated(documents: DataFrame) -> DataFrame:
    """The mix itself: each row of documents, with all its columns, as often as its copies say. The texts aren't shuffled."""
    plan, _ = planned(documents)
    whole = documents.select(F.struct("*").alias("whole"), "doc_id", "text", "source")
    out = plan.applied(_numbered(sizes(whole, "doc_id", "whole"), plan.ids))
    return out.filter("copies > 0").select("whole", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("whole.*")


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    """Whole documents table: doc_id, size, source_size, target, taken; and the rate and copies behind it."""
    return mixed(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")
