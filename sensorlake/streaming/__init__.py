"""Structured Streaming queries that keep the layers."""
