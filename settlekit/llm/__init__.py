"""Training-data operators: search, filters, mixing, sharding, dedup, packing."""
