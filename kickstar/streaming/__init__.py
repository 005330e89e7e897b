"""Micro-batch (Structured Streaming) form of the incremental fact load."""
