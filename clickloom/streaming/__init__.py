"""Structured Streaming queries over the ad click log."""
