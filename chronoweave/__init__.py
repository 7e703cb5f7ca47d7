"""chronoweave: quality, alignment and repair of multi-stream recording sessions on Spark DataFrames."""
