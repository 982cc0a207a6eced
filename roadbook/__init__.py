"""Fleet and delivery analytics on a bronze / silver / gold lake, as lazy Spark DataFrames."""
