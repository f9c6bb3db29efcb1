"""Structured Streaming form of the batch preparation (no new operator)."""
