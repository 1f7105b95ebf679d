"""Training-data operators: sharding, filtering, deduplication, mixing and binary output."""
