"""A Spark-native engine for match histories and entity graphs."""
