"""Spark-native incremental ingestion of document collections."""
