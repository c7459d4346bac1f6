"""Readers: files, topics, catalogues, delimited files, SQL."""
