"""Readers and writers: landing CSV, Parquet layers."""
