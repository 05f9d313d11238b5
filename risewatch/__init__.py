"""risewatch: technology-trend analytics on Spark DataFrames."""
