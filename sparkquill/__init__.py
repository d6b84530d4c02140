"""Spark-first building blocks for document question-answering datasets."""
