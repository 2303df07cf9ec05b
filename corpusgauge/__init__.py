"""Spark-native curation of labelled text tables and judging of text classifiers."""
