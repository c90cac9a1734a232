"""Structured Streaming: replay, landing, stateless cleaning."""
