"""DataFrame operators: filters, joins, numbering, limits, aggregates, sets, records."""
