"""Training-data operators: text scans, tokenising, deduplication, scoring, mixing."""
