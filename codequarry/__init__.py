"""Source-code corpus analytics on Spark: every operator is a lazy ``DataFrame -> DataFrame`` function."""
