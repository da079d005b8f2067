"""Structured Streaming form of the headline jobs."""
