"""Relational, graph and aggregate operators."""
