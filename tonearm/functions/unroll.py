"""Several rows from one, with their values made once."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unroll(df: DataFrame, keep: list[str], rows: list[dict[str, str]]) -> DataFrame:
    """`keep` columns plus one output row per entry of `rows` (column name to expression).

    The values are made in a projection and `stack` only arranges them. `stack` also
    ends the reach of later filters: a filter pushed further would repeat the making of
    a value (such as parsing a text) for each use, and for `explode` and `inline` of a
    column Spark even adds such filters itself.
    """
    names = list(rows[0])
    made = df.selectExpr(
        *keep, *[f"{row[n]} AS `_{i}_{n}`" for i, row in enumerate(rows) for n in names]
    )
    refs = ", ".join(f"`_{i}_{n}`" for i in range(len(rows)) for n in names)
    columns = ", ".join(f"`{n}`" for n in names)
    return made.selectExpr(*keep, f"stack({len(rows)}, {refs}) AS ({columns})")


def once(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """A projection whose expressions later filters and projections do not repeat."""
    return unroll(df, [], [columns])
