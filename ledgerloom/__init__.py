"""ledgerloom: data-quality, curation and rerun-safe loading operators on Spark DataFrames."""
