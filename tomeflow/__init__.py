"""Integration and analysis of bibliographic and reader-interaction data on Spark."""
