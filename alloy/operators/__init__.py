"""DataFrame → DataFrame operators: cleaning, dedup, aggregates, star joins, checks, indicators."""
