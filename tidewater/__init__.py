"""Tidewater: a daily operations and finance warehouse built from Spark DataFrames."""
