"""Spark-native analytics over heterogeneous job postings and text corpora."""
