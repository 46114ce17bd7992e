"""Telemetry fusion on Spark: raw signal messages in, wide unit-harmonised tables out."""
