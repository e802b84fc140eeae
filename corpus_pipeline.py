"""The corpus pipeline: quality, language, near-duplicates, mixing, tokens. Each stage is written and read again as the next one's documents.

A stage bounds the session's Arrow batches, and leaves them bounded: its result is computed by whoever writes it. It begins with the
executors giving back the heap that the one before needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary.llm import bpe, langid, mixing, quality, simhash
from tributary.llm.common import give_back, small_batches, written


def _begin(spark: SparkSession) -> None:
    small_batches(spark)
    give_back(spark)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose perplexity exceeds their language's limit, and those without text."""
    _begin(spark)
    return quality.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def spoken(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in which no language is found; fills a null lang with the prediction."""
    _begin(spark)
    return langid.known(docs)


def single(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of exact or near copies (five words, similarity 0.8)."""
    _begin(spark)
    return simhash.deduplicated(docs)


def in_proportion(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that each source's words meet its target."""
    _begin(spark)
    return mixing.repeated(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of each document of the mix, with the digests of its ids and of what they decode to."""
    _begin(spark)
    return bpe.encoded(docs, with_ids=True, keep=("doc_id", "lang", "source"), remember=0)


STAGES = [
    ("quality classifier", good),
    ("language ID", spoken),
    ("SimHash near-dedup", single),
    ("mixing sources", in_proportion),
    ("byte-level BPE", tokens),
]

#: SQL can't express the model, the automata and the trees; tests/llm compares each stage's operator with brute force, and tokens with tiktoken.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table: the tokens of the mix."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = written(docs, f"stage{n}")
    return docs
