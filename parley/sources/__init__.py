"""Files, records, the given tables and word lists."""
