"""Operators for training-data corpora: tables of documents, web pages, labels and benchmark items."""
