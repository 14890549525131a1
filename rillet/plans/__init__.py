"""Plans: the reference's jobs, dashboards, and the query registry."""
