"""tributary: fiscal-document analytics expressed as Spark DataFrames."""
