"""Markdown files as they arrive: the row-wise operators run unchanged on a stream, as none of them needs state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from inkmill.functions import text as T
from inkmill.sources.files import file_path


def markdown_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """path, documento, text of new .md files below the path."""
    rows = spark.readStream.format("text").options(wholetext=True, recursiveFileLookup=True, pathGlobFilter=f"*{T.MARKDOWN}", maxFilesPerTrigger=files_per_batch).load(path)
    rows = rows.select(file_path().alias("path"), T.normalize_newlines(F.col("value")).alias("text"))
    return rows.select("path", T.base_name(F.col("path")).alias("documento"), "text")


def run(rows: DataFrame, operator: Callable[[DataFrame], DataFrame], output: str, checkpoint: str) -> StreamingQuery:
    """Write operator(rows) to Parquet and stop when what is there has been read."""
    return operator(rows).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(output)
