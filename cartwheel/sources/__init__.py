"""Readers: files, streams, named tables, and the mapping of the given tables to the commerce domain."""
