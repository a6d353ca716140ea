"""Structured Streaming twins of the queue's barrier, retries and recovery."""
