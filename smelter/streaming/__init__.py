"""Structured Streaming: file and Kafka sources, windows, state and sinks."""
