"""Training-data operators: tokenisation, quality, dedup, scoring, extraction, formatting, packing."""
