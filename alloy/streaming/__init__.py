"""Structured Streaming form of the landing ingestion."""
