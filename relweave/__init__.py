"""relweave: relational and time-series feature engineering on Spark DataFrames."""
