"""Training-data operators: scoring, packing, encoding, joins, search, archives and sharding."""
