"""Structured Streaming: message parsing, micro-batch scoring, running counts."""
