"""Plans: the registered queries with their oracles, and the batch job."""
