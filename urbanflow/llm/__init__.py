"""Training-data operators: deduplication, filtering, mixing, packing, sharding, scoring."""
