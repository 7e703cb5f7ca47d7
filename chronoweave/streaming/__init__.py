"""Structured Streaming: arrival of sessions and event-time windows."""
