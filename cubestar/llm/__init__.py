"""Training-data operators: chat text, tokens, duplicates, quality, mixing, urls."""
