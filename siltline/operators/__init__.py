"""DataFrame-to-DataFrame operators: conform, upsert, change feed."""
