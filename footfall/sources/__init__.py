"""Readers and writers for snapshot tables, directories, delimited files and model logs."""
