"""Document-to-facts analytics on Spark: word boxes, page text and statement values as DataFrames."""
