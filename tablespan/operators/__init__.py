"""DataFrame-level operators: schema, statistics, layout, aggregates, as-of, comparison."""
