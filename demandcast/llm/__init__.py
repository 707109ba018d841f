"""Training-data operators: dedup, tokenization, quality, search, mixing, formatting, archiving."""
