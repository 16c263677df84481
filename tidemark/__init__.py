"""Tidemark: a batch retail warehouse expressed as plain PySpark DataFrame operators."""
