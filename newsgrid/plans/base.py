"""Inputs several query modules share."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsgrid import dims, views
from newsgrid.functions.text import ws_clean
from newsgrid.operators.score import enrich, with_text
from newsgrid.session import cut_lineage


def scoring_input(spark, sf):
    """Stories with the one snippet their single raw item contributes."""
    snippet = F.array(F.substring(ws_clean("summary"), 1, 650))
    return views.stories(spark, sf).withColumn("snippets", snippet)


def texted(spark, sf):
    return with_text(scoring_input(spark, sf), dims.SAMPLE_CONFIG)


def whole_texted(spark, sf):
    """Stories tagged by their whole text; the cut of a snippet belongs to the scoring rules only."""
    return with_text(views.stories(spark, sf).withColumn("snippets", F.array(ws_clean("summary"))), dims.SAMPLE_CONFIG)


def enriched(spark, sf):
    return enrich(scoring_input(spark, sf), dims.SAMPLE_CONFIG, views.AS_OF)


def served_table(df):
    """The enriched stories as the stored table a feed is searched in."""
    return cut_lineage(df)


def joined(column: str, name: str):
    """An array column as one sorted, '|'-joined text, the form the checks compare."""
    return F.array_join(F.array_sort(column), "|").alias(name)
