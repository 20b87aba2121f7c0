"""Plans: read planning, size-checked broadcast, control table, pipeline jobs."""
