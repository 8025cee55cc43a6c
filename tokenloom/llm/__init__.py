"""Training-data operators: dedup, mixing, fingerprints, scoring, language, URLs, packing."""
