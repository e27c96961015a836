"""DataFrame -> DataFrame operators (joins, aggregates, windows, top-k)."""
