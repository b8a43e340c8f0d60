"""Helpers the training-data operators share: reading tables, sizing, scratch tables, text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.plans.scratch import dropped, saved

__all__ = ["WORD", "WS", "dropped", "let", "measure", "saved", "sized_for_join", "split_count", "table"]

#: ASCII white space; a word is a maximal run of anything else.
WS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """Evaluate `value` once and hand it to `body` as a lambda variable; keeps a costly expression from being inlined twice."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def measure(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """Rows and UTF-8 bytes of text: two numbers that size partitions and buckets."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0)).alias("b")).first()
    return int(row["n"]), int(row["b"])


def split_count(total: int, target: int, least: int = 1, most: int = 1 << 20) -> int:
    return max(least, min(most, -(-total // target)))


#: Narrow rows (a few numbers each) that may be broadcast: some tens of MB.
BROADCAST_ROWS = 1_000_000


def sized_for_join(narrow: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The side of a join, to be broadcast if it has at most so many rows by count, else joined by sort-merge."""
    return F.broadcast(narrow) if narrow.count() <= most else narrow.hint("merge")
