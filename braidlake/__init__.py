"""braidlake: barcoded-sequence analytics on Spark DataFrames."""
