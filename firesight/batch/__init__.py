"""The batch job over the stored tables."""
