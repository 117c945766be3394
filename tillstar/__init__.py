"""tillstar: a retail star-schema warehouse built from Spark DataFrames."""
