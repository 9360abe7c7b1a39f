"""Spark-native keyword, vocabulary and document-record analytics."""
