"""Column-expression helpers (time buckets, text rules, keys, JSON)."""
