"""Readers of catalogue, reader-data and rating files, and writers of tables."""
