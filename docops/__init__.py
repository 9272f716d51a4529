"""Keyed-document processing on Spark: bulk change logs, search, and index lifecycle."""
