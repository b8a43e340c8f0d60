"""Reasoning traces for rows of instruction, answer and source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.operators.generate import generate


def by_position(df: DataFrame) -> DataFrame:
    """The three columns under their names; any other number of columns is an error."""
    if len(df.columns) != 3:
        raise ValueError(f"expected 3 columns, got {len(df.columns)}: {df.columns}")
    return df.toDF("instruction", "answer", "source")


def reasoning_rows(rows: DataFrame, backend: Callable[[], object], workers: int = 1, keep: tuple[str, ...] = ()) -> DataFrame:
    """expected_answer, problem, generated_solution of the rows whose generation succeeds; `keep` names columns to carry along."""
    return traced(ask_reasoning(rows, backend, workers, keep), keep)


def ask_reasoning(rows: DataFrame, backend: Callable[[], object], workers: int = 1, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every row with its generated_solution, error and seconds."""
    done = generate(rows.select(*keep, "instruction", "answer", "source"), backend, "reasoning", ["instruction", "answer", "source"], "generated_solution", "string", workers)
    return done.withColumnsRenamed({"generated_solution_error": "error", "generated_solution_seconds": "seconds"})


def traced(asked: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return asked.filter("error IS NULL").select(*keep, F.col("answer").alias("expected_answer"), F.col("instruction").alias("problem"), "generated_solution")
