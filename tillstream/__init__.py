"""Spark operators for retail point-of-sale documents, batch and streaming."""
