"""Structured Streaming: the batch transforms on files as they arrive."""
