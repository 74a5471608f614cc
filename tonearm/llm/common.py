"""Reading, intermediate tables and text pieces shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonearm.session import work_dir

#: White space of the word definitions: space and the code points 9 to 13.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back, which cuts the lineage."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole(text: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def as_row(df: DataFrame) -> Column:
    """All columns in one struct, so that working columns never clash with them."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")


def from_row(df: DataFrame, changed: dict[str, Column] | None = None) -> list[Column]:
    """The columns of ``df`` out of such a struct, some of them changed, in their old types."""
    changed = changed or {}
    return [
        (changed[f.name].cast(f.dataType) if f.name in changed else F.col("row")[f.name]).alias(f.name) for f in df.schema
    ]


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, all else unchanged."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def fingerprint(text: Column) -> Column:
    """Tells rows apart that share a doc_id but not a text."""
    return F.xxhash64(text)


def same_row(a: DataFrame, b: DataFrame, *keys: str) -> Column:
    """Equality of keys for a join; null equals null."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & a[k].eqNullSafe(b[k])
    return cond


def slices(frames: Iterable[pd.DataFrame], chars: int = 2_000_000) -> Iterator[pd.DataFrame]:
    """Cut Arrow batches so that each slice holds about ``chars`` characters of text."""
    for pdf in frames:
        if not len(pdf):
            continue
        ends = pdf["text"].str.len().cumsum() // chars
        for _, part in pdf.groupby(ends, sort=False):
            yield part.reset_index(drop=True)
