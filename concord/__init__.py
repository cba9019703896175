"""Table reconciliation and corpus operators on Spark DataFrames."""
