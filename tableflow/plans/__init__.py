"""Plans: derived inputs over the driver tables and the period run."""
