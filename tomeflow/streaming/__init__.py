"""Interactions as a stream."""
