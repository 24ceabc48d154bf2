"""Every registered query with the SQL that gives the same rows on the same tables."""
