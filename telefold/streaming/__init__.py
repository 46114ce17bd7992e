"""The fusion as Structured Streaming jobs."""
