"""DataFrame operators: dedup, staging, lifecycle, facts, mart, upsert,
history, quality and dashboard queries."""
