"""Outputs: feed and archive tables, elided rewrites, gated publication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsgrid.operators.aggregates import feed_stats
from newsgrid.operators.filters import retention_window
from newsgrid.operators.quality import publish_gate
from newsgrid.sources.store import TableStore

def feed_store(stories: DataFrame, path: str) -> TableStore:
    """The store of a feed: ``archive`` by publication day, ``current`` and the one-row ``status``."""
    status = feed_stats(stories).withColumn("as_of", F.lit("")).schema
    return TableStore(stories.sparkSession, path, {"archive": stories.schema, "current": stories.schema, "status": status})


def write_feed(stories: DataFrame, path: str, as_of: str, current_days: int = 7) -> dict[str, int]:
    """Archive, current window and status in one commit; only days whose stories changed are written.

    Returns the number of partitions written of each table. Stories without a date are a day of their own.
    """
    day = F.coalesce(F.unix_date(F.col("published_at").cast("date")), F.lit(-(1 << 31)))
    current = retention_window(stories, as_of, current_days, "published_at", False)
    status = feed_stats(current).withColumn("as_of", F.lit(as_of))
    return feed_store(stories, path).commit({"archive": (stories, day), "current": (current, F.lit(0)), "status": (status, F.lit(0))})


def write_if_changed(fresh: DataFrame, path: str) -> bool:
    """Write unless the stored table already holds exactly these rows; tells whether it wrote.

    Rows are compared by the digest beside the stored table, which is not read.
    """
    return TableStore(fresh.sparkSession, path, {"rows": fresh.schema}).commit({"rows": (fresh, F.lit(0))})["rows"] > 0


def read_written(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table ``write_if_changed`` stored last."""
    return TableStore(spark, path, {"rows": schema}).read("rows")


def publish(stories: DataFrame, violations: DataFrame, path: str, as_of: str) -> bool:
    """Write the feed only when no error-level violation exists."""
    if not publish_gate(violations).first()["publish_allowed"]:
        return False
    write_feed(stories, path, as_of)
    return True
