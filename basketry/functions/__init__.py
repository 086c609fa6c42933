"""Column expressions: cleaning, dates, masking, keys and aggregates."""
