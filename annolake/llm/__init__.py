"""Training-data operators: near and exact deduplication, classifiers, mixing, tokenising, sharding."""
