"""Clinical-study analytics over entity-attribute-value facts, on Spark DataFrames."""
