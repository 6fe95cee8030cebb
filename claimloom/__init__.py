"""Document-to-claim-graph analytics expressed as Spark DataFrames."""
