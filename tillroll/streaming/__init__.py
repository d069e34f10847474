"""Structured Streaming form of the pipeline (file stream, exactly-once sinks)."""
