"""crateloom: entity resolution and credit-graph analytics on Spark DataFrames."""
