"""Session defaults for local runs; on a cluster the submitter's settings win."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "newsgrid") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; only a local session without one gets a new temporary one."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if context.master.partition("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="newsgrid-"))
        named = context.getCheckpointDir()
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The files outlive any executor, and unlike a checkpointed plan the re-read table carries no
    constraints or statistics of the steps before it, so plans stay small over many iterations.
    """
    return Pile(df.sparkSession).put(df)


class Pile:
    """Rows added over many rounds, read back as one table, so that the plans of all rounds have one shape."""

    def __init__(self, spark: SparkSession):
        self.spark, self.schema, self.paths = spark, None, []

    def put(self, df: DataFrame) -> DataFrame:
        """Add the rows of ``df`` and give them back as a table of their own."""
        path = f"{shared_dir(self.spark).rstrip('/')}/newsgrid-{uuid.uuid4().hex}"
        df.write.parquet(path)
        self.schema = self.schema or df.schema
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def all(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*self.paths)
