"""DataFrame -> DataFrame operators (filters, joins, aggregates, windows, merges, models)."""
