"""newsgrid: news curation and market-series reconciliation as Spark DataFrame operators."""
