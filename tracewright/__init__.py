"""Evidence-graph and timed-text analytics on Spark DataFrames."""
