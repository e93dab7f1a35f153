"""Training-data operators: cleaning, deduplication, scanning, sharding, packing and formatting of text corpora."""
