"""Corpus preparation, co-occurrence statistics, embeddings and their evaluation on Spark."""
