"""Plans: end-to-end jobs and the registry of checked queries."""
