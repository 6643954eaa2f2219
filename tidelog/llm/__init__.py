"""Training-data operators: dedup, tokenising, packing, sharding, search and media columns."""
