"""The given tables bound to registry shapes, the registered queries and their SQL."""
