"""Column naming for the OLAP layer."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def snake(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()


def snake_case(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: snake(c) for c in df.columns if snake(c) != c})


def to_message(df: DataFrame, internal: tuple[str, ...] = ()) -> DataFrame:
    """One snake_case JSON text per row in column `value`, without internal columns."""
    out = snake_case(df.drop(*internal))
    return out.select(F.to_json(F.struct("*")).alias("value"))
