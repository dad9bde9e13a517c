"""DataFrame in, DataFrame out: projections, distribution, aggregates, windows, joins, patterns."""
