"""DataFrame operators: table mapping, keyed lookups, joins, filters, profiles."""
