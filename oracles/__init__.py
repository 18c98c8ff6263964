"""Independent SQL statements that every registered query is compared with."""
