"""Robot-episode analytics on Spark: DataFrame in, DataFrame out."""
