"""Training-data operators: cleaning, deduplication, tokenizing and screening of document tables."""
