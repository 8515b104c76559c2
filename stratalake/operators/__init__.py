"""DataFrame operators: generation, lookups, numbering, quality, aggregation, text, vectors."""
