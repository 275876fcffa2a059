"""Training-data operators: search, filters, near duplicates, scoring, PII, tokens."""
