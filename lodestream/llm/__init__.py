"""Training-data operators: archives, near-duplicates, mixing, quality, fingerprints, packing, extraction, search, secrets."""
