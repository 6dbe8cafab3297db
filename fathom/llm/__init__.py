"""Training-data operators: sanitising, deduplication, scoring, tokenising, packing, sharding, search."""
