"""DataFrame -> DataFrame operators: cleaning, star schema, marts, gates, ML, metrics."""
