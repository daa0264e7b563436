"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsgrid.session import cut_lineage, shared_dir

__all__ = ["column_map", "cut_lineage", "fresh_path", "ranked_by_position", "ranked_within", "salted", "table"]

BUCKETS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh_path(spark: SparkSession, kind: str) -> str:
    """A new path in the folder all executors share."""
    return f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def column_map(rows_of):
    """A ``mapInPandas`` function that makes one frame of ``rows_of(frame)`` from each batch."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield rows_of(frame)

    return run


def ranked_within(df: DataFrame, group: str, order: list[Column | str], name: str, buckets: int = BUCKETS) -> DataFrame:
    """Number the rows of each group from 0 without sorting any group in one task.

    Rows fall into hash buckets of their order columns; a window numbers one bucket, and the bucket's
    start is a running sum over at most ``buckets`` counts a group. ``df`` is read twice.
    """
    held = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = held.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_count"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(group).alias("_group"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy(group, "_bucket").orderBy(*order)) - 1
    joined = held.withColumn("_within", within).join(starts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_bucket") == F.col("_b")))
    return joined.withColumn(name, F.col("_start") + F.col("_within")).drop("_bucket", "_b", "_group", "_start", "_within")


def ranked_by_position(df: DataFrame, group: str, position: str, ties: list[str], name: str, buckets: int = BUCKETS) -> DataFrame:
    """Number the rows of each group from 0 by ``position`` (a long from 0 on, not null), then ``ties``.

    Equal ranges of positions are the buckets, so numbers rise with the position and no group is sorted
    in one task. ``df`` is read three times.
    """
    top = df.agg(F.max(position).alias("top")).collect()[0]["top"]
    width = (top or 0) // buckets + 1
    held = df.withColumn("_bucket", F.floor(F.col(position) / width).cast("int"))
    counts = held.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_count"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(group).alias("_group"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy(group, "_bucket").orderBy(position, *ties)) - 1
    joined = held.withColumn("_within", within).join(starts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_bucket") == F.col("_b")))
    return joined.withColumn(name, F.col("_start") + F.col("_within")).drop("_bucket", "_b", "_group", "_start", "_within")


def salted(keys: DataFrame, salts: int) -> DataFrame:
    """Repeat a table of distinct keys once per salt, so that a hot key's matches meet it in many tasks."""
    return keys.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
