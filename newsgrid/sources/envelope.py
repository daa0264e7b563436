"""Envelope files: one JSON object per file whose row array becomes a table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def envelope_schema(row_schema: T.StructType, rows: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField("schema_version", T.IntegerType()),
            T.StructField("generated_at", T.StringType()),
            T.StructField(rows, T.ArrayType(row_schema)),
        ]
    )


def read_envelope(spark: SparkSession, path: str, row_schema: T.StructType, rows: str = "items") -> DataFrame:
    """Rows of every envelope under ``path``; a missing path or corrupt file contributes none."""
    try:
        files = spark.read.schema(envelope_schema(row_schema, rows)).option("mode", "PERMISSIVE").json(path, multiLine=True)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], row_schema)
    return files.select(F.inline(rows))


def envelope_rows(envelopes: DataFrame, column: str, row_schema: T.StructType, rows: str = "items") -> DataFrame:
    """Rows of envelopes landed as a text column, with the other columns kept; corrupt text gives none."""
    parsed = F.from_json(column, envelope_schema(row_schema, rows), {"mode": "PERMISSIVE"})
    kept = [c for c in envelopes.columns if c != column]
    return envelopes.select(*kept, parsed.alias("_e")).select(*kept, F.posexplode(f"_e.{rows}").alias("pos", "row")).select(
        *kept, "pos", "row.*"
    )
