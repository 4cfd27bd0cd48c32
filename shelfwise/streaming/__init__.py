"""Structured Streaming ingestion (validation + dead letters) and windowed monitors."""
