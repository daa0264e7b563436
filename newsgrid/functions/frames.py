"""DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def staged(df: DataFrame, columns: dict) -> DataFrame:
    """Add or replace columns through a one-row generator.

    Later filters cannot be substituted through it, so a rule that reads an earlier rule several
    times costs one evaluation instead of an expression that grows with every stage.
    """
    row = F.struct(*[c.alias(f"_s_{name}") for name, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    made = df.select("*", F.inline(F.array(row)))
    return made.select(*kept, *[F.col(f"_s_{name}").alias(name) for name in columns])
