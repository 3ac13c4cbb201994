"""Plans: compositions of operators into end-to-end jobs."""
