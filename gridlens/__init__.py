"""Analytics for building and measuring visual training datasets, on Spark DataFrames."""
