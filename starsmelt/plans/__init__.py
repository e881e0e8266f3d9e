"""Plans: silver and gold builders, datasets, feeds, and the whole flow."""
