"""A Spark-native engine for curating speech and text corpora."""
