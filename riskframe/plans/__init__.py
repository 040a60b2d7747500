"""Plans: operator compositions bound to data (registered queries, full pipeline)."""
