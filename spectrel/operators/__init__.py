"""DataFrame operators: batching and indexing, joins, hits, statistics, XML repair."""
