"""Learning-platform warehouse, quality and anomaly engine on Spark DataFrames."""
