"""Readers: files, delimited text with a declared schema, sequences, other tables."""
