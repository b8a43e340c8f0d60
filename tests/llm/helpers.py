from __future__ import annotations

import re

import pandas as pd

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def documents(sf: str) -> pd.DataFrame:
    return pd.read_parquet(f"{sf}/documents.parquet")


def frame(spark, texts, **columns):
    """A documents table of the given texts, ids from 0."""
    rows = [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def save(df, path) -> str:
    df.write.mode("overwrite").parquet(f"{path}/documents.parquet")
    return str(path)


#: Nulls, empty and blank texts, ties, repeats and one very long text.
ODD = [None, "", "   \n\t ", "one", "one", "the same words here", "the same words here", "x" * 50_000, "a b " * 20_000, "Ünï çödé ß 日本 🙂 \x00 \x1c end", "1" * 30_000, "@" * 3000, "a@b.c" * 500]
