"""Chess-game corpora on Spark: sources, filters, deduplication, replay and position statistics as DataFrames."""
