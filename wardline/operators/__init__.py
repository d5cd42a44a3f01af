"""DataFrame operators: dedup, joins, ranking, upsert, history, spatial assignment, checks."""
