"""Scans of raw frames, metadata, databases and streams."""
