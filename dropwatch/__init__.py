"""dropwatch: find significant drops in click traffic with Spark DataFrames."""
