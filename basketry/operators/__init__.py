"""DataFrame operators: masking, flattening, dedup, lookups, reports, retention."""
