"""Jobs that run end to end, and the registry of queries with their SQL twins."""
