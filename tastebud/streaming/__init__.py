"""Streaming adapters for the batch operators."""
