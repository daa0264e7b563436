"""Tables kept by partition under one manifest: what did not change is not written again.

A commit writes the changed partitions of its tables into a folder of its own number and then one small
manifest that names, for every partition, the commit that holds it. Readers follow the newest manifest, so
they see the tables before a commit or after it, never half of it. A commit reads the manifests
before its own number only, so a replayed one does the same again and changes nothing.

Whether a partition changed is told by an order-free digest of its rows (their number, and two sums over
row hashes), stored in the manifest; stored rows are not read for it. The manifest has one row
a partition and passes through the driver: partition by days or a fixed number of buckets.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "table string, part long, held long, n long, digest string"
FILE_ROWS = 1_000_000


def digest() -> list[Column]:
    """Number of rows and an order-free digest of them."""
    row = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    parts = [F.sum(F.shiftrightunsigned(F.xxhash64(F.lit(seed), row), 20)).cast("string") for seed in (0, 1)]
    return [F.count(F.lit(1)).alias("n"), F.concat_ws("-", *parts).alias("digest")]


class TableStore:
    """Named tables under ``path``; ``schemas`` gives their columns, a commit their rows and partitions."""

    def __init__(self, spark: SparkSession, path: str, schemas: dict):
        self.spark, self.path, self.schemas = spark, path.rstrip("/"), schemas

    def manifest(self, before: int | None = None) -> tuple[int, list]:
        """(number, rows) of the newest commit, or of the newest before a number; (-1, []) if there is none."""
        try:
            rows = self.spark.read.schema(f"{MANIFEST}, number long").json(f"{self.path}/manifest")
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return -1, []
        held = rows if before is None else rows.filter(F.col("number") < before)
        newest = held.agg(F.max("number").alias("number")).first()["number"]
        return (-1, []) if newest is None else (newest, held.filter(F.col("number") == newest).drop("number").collect())

    def read(self, table: str, before: int | None = None, parts=None) -> DataFrame:
        """A table as of a commit; ``parts`` reads these partitions only."""
        rows = [r for r in self.manifest(before)[1] if r["table"] == table and r["part"] is not None and (parts is None or r["part"] in parts)]
        if not rows:
            return self.spark.createDataFrame([], self.schemas[table])
        folders = [f"{self.path}/{table}/commit={r['held']}/part={r['part']}" for r in rows]
        return self.spark.read.schema(self.schemas[table]).parquet(*folders)

    def commit(self, frames: dict, number: int | None = None, touched: dict | None = None) -> dict[str, int]:
        """Store ``frames``: table → (rows, partition column). Tells how many partitions of each were written.

        A table replaces the stored one; with ``touched[table]``, a list of partitions, only these. Tables
        that are not given stay.
        """
        before, old = self.manifest(number)
        number = before + 1 if number is None else number
        kept = [r for r in old if r["table"] not in frames]
        written = {}
        for table, (df, by) in frames.items():
            plain = df.select(*self.spark.createDataFrame([], self.schemas[table]).columns)
            parted = plain.withColumn("part", by.cast("long"))
            fresh = {r["part"]: r for r in parted.groupBy("part").agg(*digest()).collect()}
            stored = {r["part"]: r for r in old if r["table"] == table}
            changed = [p for p, r in fresh.items() if p not in stored or (stored[p]["n"], stored[p]["digest"]) != (r["n"], r["digest"])]
            if changed:
                rows = self.spark.createDataFrame([(p, -(-fresh[p]["n"] // FILE_ROWS)) for p in changed], "part long, files long")
                spread = parted.join(F.broadcast(rows), "part").withColumn("_file", F.pmod(F.xxhash64(*plain.columns), "files"))
                spread.repartition("part", "_file").drop("files", "_file").write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/{table}/commit={number}")
            others = [r for p, r in stored.items() if p not in fresh and touched and table in touched and p not in touched[table]]
            kept += others + [(table, p, number if p in changed else stored[p]["held"], r["n"], r["digest"]) for p, r in fresh.items()]
            written[table] = len(changed)
        rows = self.spark.createDataFrame([tuple(r) for r in kept] or [(None, None, None, None, None)], MANIFEST)
        rows.coalesce(1).write.mode("overwrite").json(f"{self.path}/manifest/number={number}")
        return written
