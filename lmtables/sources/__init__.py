"""Readers and writers of corpus, document and tensor tables."""
